"""Writing catalogued Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.staging import COMPRESSION, discard

# Spark's folder name for NULL as a partition value.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def append_table(
    df: DataFrame, table: str, path: str, partition_by: Sequence[str] = (), known_rows: bool = False
) -> bool:
    """Append to an external table, creating it at first. An empty batch leaves no trace.

    The rows are counted while they are written, so the frame is evaluated once.
    ``known_rows`` spares the look at the count.
    """
    spark, counted = df.sparkSession, Observation()
    exists = spark.catalog.tableExists(table)
    rows = df if known_rows else df.observe(counted, F.count("*").alias("rows"))
    writer = rows.write.mode("append").format("parquet").option("path", path).option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    if known_rows or counted.get["rows"]:
        return True
    if not exists:
        # External: dropping it forgets the name and keeps the folder.
        spark.sql(f"DROP TABLE {table}")
        discard(spark, path)
    return False


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location")
    return rows.first()["data_type"].rstrip("/")


def replace_table(df: DataFrame, table: str, path: str) -> None:
    """Replace a table's content, even by a query that reads the table itself.

    Two folders under ``path`` take turns. The new content is written to the idle one
    and the catalog is then pointed at it, so readers see the old or the new table, a
    failed write leaves the old one in place, and the next attempt overwrites its
    remains. The content before stays on disk until the next replacement.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    idle = f"{path}/{'b' if exists and _location(spark, table).endswith('/a') else 'a'}"
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(idle)
    if exists and spark.table(table).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{idle}'")
        spark.catalog.refreshTable(table)
        return
    # External: dropping it forgets the name and keeps the files.
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=idle, source="parquet", schema=df.schema)


def _balanced(df: DataFrame, partition_by: Sequence[str], derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Gather rows by table partition into files of even size.

    Columns that are ``derived`` from others of the row are not moved but made where the
    row arrives.

    Adaptive execution splits a partition that is too large for one task and joins the
    small ones, which a plain repartition by the same columns would not.
    """
    derived = dict(derived or {})
    return df.drop(*derived).hint("rebalance", *[F.col(c) for c in partition_by]).withColumns(derived).select(df.columns)


def append_partitions(
    df: DataFrame, table: str, path: str, partition_by: Sequence[str], known_rows: bool = False,
    derived: Mapping[str, Column] | None = None,
) -> bool:
    """:func:`append_table` with the rows gathered by partition."""
    return append_table(_balanced(df, partition_by, derived), table, path, partition_by, known_rows)


def partitions_of(df: DataFrame, partition_by: Sequence[str]) -> list[tuple]:
    """The table partitions ``df`` falls into: as many as the table's folders."""
    return [tuple(row) for row in df.select(*partition_by).distinct().collect()]


def in_partitions(df: DataFrame, partition_by: Sequence[str], values: Sequence[tuple]) -> DataFrame:
    """The rows of the given partitions, by a filter that prunes folders."""
    return df.where(_in_partitions(partition_by, values))


def _in_partitions(partition_by: Sequence[str], values: Sequence[tuple]) -> Column:
    """True for rows of the given partitions, false (never NULL) for others.

    One term per combination of all columns but the most varied, which is a value list.
    """
    places = range(len(partition_by))
    varied = max(places, key=lambda i: len({v[i] for v in values}))
    lists: dict[tuple, list] = {}
    for value in values:
        lists.setdefault(tuple(value[i] for i in places if i != varied), []).append(value[varied])
    others = [partition_by[i] for i in places if i != varied]
    chosen = F.lit(False)
    for fixed, members in lists.items():
        term = _one_of(partition_by[varied], members)
        for column, part in zip(others, fixed):
            term = term & _one_of(column, [part])
        chosen = chosen | term
    return chosen


def _one_of(column: str, members: Sequence) -> Column:
    named = [m for m in members if m is not None]
    term = F.col(column).isNotNull() & F.col(column).isin(named) if named else F.lit(False)
    return term | F.col(column).isNull() if None in members else term


def overwrite_partitions(
    df: DataFrame, table: str, path: str, partition_by: Sequence[str], touched: Sequence[tuple] = (),
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Replace exactly the partitions ``df`` has rows for, and empty the rest of ``touched``.

    ``df`` may read the table: the new files are moved in only when all are written.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        append_partitions(df, table, path, partition_by, known_rows=True, derived=derived)
        return
    columns = spark.table(table).columns
    emptied = set(touched) - set(partitions_of(df, partition_by)) if touched else set()
    # the option, not the session's setting, which other threads see too
    writer = _balanced(df, partition_by, derived).select(*columns).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
    writer.partitionBy(*partition_by).parquet(path)
    spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)
    if emptied:
        _empty_partitions(spark, table, path, partition_by, emptied)


def replace_rows(
    fresh: DataFrame,
    stale: DataFrame,
    key: Sequence[str],
    table: str,
    path: str,
    partition_by: Sequence[str],
    candidates: Sequence[tuple],
    by: Sequence[str] | None = None,
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Put ``fresh`` in the place of the rows whose key is in ``stale``.

    Stale rows can only lie in the partitions ``candidates`` (values of ``by``, or
    else of ``partition_by``). Of those, the ones that do hold stale rows are rewritten,
    and fresh rows for any other partition are appended, so that news alone rewrite
    nothing. After a broken attempt the same call completes the work, since it looks at
    what the table holds.
    """
    whole = fresh.sparkSession.table(table)
    present = in_partitions(whole, by or partition_by, candidates)
    holding = partitions_of(present.join(stale, list(key), "left_semi"), partition_by)
    if not holding:
        append_partitions(fresh, table, path, partition_by, derived=derived)
        return
    kept = in_partitions(whole, partition_by, holding).join(stale, list(key), "left_anti")
    inside = _in_partitions(partition_by, holding)
    overwrite_partitions(kept.unionByName(fresh.where(inside)), table, path, partition_by, holding, derived)
    append_partitions(fresh.where(~inside), table, path, partition_by, derived=derived)


def _empty_partitions(spark: SparkSession, table: str, path: str, partition_by: Sequence[str], values: set[tuple]) -> None:
    """Leave the partitions in place without rows.

    Written to their folders, as a partition clause in SQL cannot name a NULL.
    """
    schema = T.StructType([f for f in spark.table(table).schema if f.name not in partition_by])
    nothing = spark.createDataFrame([], schema)
    texts = {tuple(None if v is None else str(v) for v in value) for value in values}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        parts = [unquote(part.split("=", 1)[1]) for part in row["partition"].split("/")]
        if tuple(None if p == _NULL_FOLDER else p for p in parts) in texts:
            nothing.write.mode("overwrite").parquet(f"{path}/{row['partition']}")
    spark.catalog.refreshTable(table)
