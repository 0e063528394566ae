"""High-water marks: the newest stamp a table already holds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def high_water_mark(df: DataFrame, column: str) -> datetime | None:
    return df.agg(F.max(column)).first()[0]


def recorded_mark(spark: SparkSession, table: str, name: str) -> datetime | None:
    """An instant kept as a property of a catalogued table; ``None`` without table or property."""
    if not spark.catalog.tableExists(table):
        return None
    row = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == name).first()
    return datetime.fromisoformat(row["value"]) if row else None


def record_mark(spark: SparkSession, table: str, name: str, mark: datetime) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{mark.isoformat()}')")


def latest_of(*marks: datetime | None) -> datetime | None:
    return max((m for m in marks if m is not None), default=None)


def layer_mark(spark: SparkSession, table: str, column: str, day: str | None = None) -> datetime | None:
    """The mark of a catalogued table; ``None`` if there is no such table.

    Any other failure surfaces. With the partition column ``day`` only the newest day's
    folder is scanned, the days being listed from the catalog.
    """
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.table(table)
    if day:
        days = spark.sql(f"SHOW PARTITIONS {table}").agg(F.max("partition")).first()[0]
        if days is None:
            return None
        rows = rows.where(F.col(day) == F.lit(days.split("=", 1)[1]).cast("date"))
    return high_water_mark(rows, column)
