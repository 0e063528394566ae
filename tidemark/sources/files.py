"""File and frame sources."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.columns import conform, instant
from tidemark.registry import Table

CREATED_DEFAULT = "2015-01-01 00:00:00"


def load_csv(
    spark: SparkSession,
    path: str,
    table: Table,
    defaults: Mapping[str, Column],
    null_token: str | None = "NULL",
) -> DataFrame:
    """CSV with a header line, the table's columns in order, and the rest defaulted.

    Malformed values stop the load. ``null_token=None`` reads no text as NULL but the
    empty field.
    """
    columns = [c for c in table.schema.names if c not in defaults]
    schema = T.StructType([table.schema[c] for c in columns])
    options = {"header": "true", "sep": ",", "mode": "FAILFAST"}
    if null_token is not None:
        options["nullValue"] = null_token
    rows = spark.read.schema(schema).options(**options).csv(path)
    return conform(rows.withColumns(dict(defaults)), table.schema, table.name)


@dataclass(frozen=True)
class CsvFolder:
    """``folder/<table>.csv`` files, loaded at ``load_time``."""

    folder: str
    load_time: str | datetime
    null_token: str | None = "NULL"

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        loaded = instant(self.load_time)
        # Stock rows count as created when loaded, all others at a fixed date.
        created = loaded if table.snapshot else instant(CREATED_DEFAULT)
        return load_csv(
            spark,
            f"{self.folder.rstrip('/')}/{table.name}.csv",
            table,
            {"created_at": created, "updated_at": loaded},
            self.null_token,
        )


@dataclass(frozen=True)
class Frames:
    """Tables that are at hand as frames, such as Parquet dumps or other catalogs."""

    tables: Mapping[str, DataFrame]

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        return self.tables[table.name]
