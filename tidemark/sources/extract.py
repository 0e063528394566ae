"""Taking a table, or what changed in it, out of a source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import conform, instant
from tidemark.registry import Table


def changed_since(mark: str | datetime) -> Column:
    return (F.col("created_at") > instant(mark)) | (F.col("updated_at") > instant(mark))


def extract(
    spark: SparkSession, source, table: Table, as_of: str | datetime, mark: str | datetime | None = None
) -> DataFrame:
    """The rows changed since ``mark`` (all without one), stamped ``raw_extraction_time``.

    The filter stands directly on the source's scan, so databases and Parquet evaluate
    it themselves.
    """
    rows = source.read(spark, table)
    if mark is not None:
        rows = rows.where(changed_since(mark))
    return conform(rows, table.schema, table.name).select("*", instant(as_of).alias("raw_extraction_time"))
