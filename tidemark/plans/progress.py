"""The silver tables as gold reads them, and how far each gold table has come."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.lake import Lake
from tidemark.operators import newest_of_runs
from tidemark.plans.bronze import DAY
from tidemark.plans.silver import STAMP as SILVER_STAMP
from tidemark.sources import latest_of, layer_mark, record_mark, recorded_mark
from tidemark.versions import VersionStore

_PROPERTY = "tidemark.mark"


class Silver:
    """Silver tables by name, as they are now."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark, self.lake = spark, lake

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.table(self.lake.table("silver", name))

    def has(self, *names: str) -> bool:
        return all(self.spark.catalog.tableExists(self.lake.table("silver", n)) for n in names)

    def newest_stamp(self, logs: Sequence[str], histories: Sequence[str]) -> datetime | None:
        """The newest silver run any of the tables has taken part in."""
        marks = [layer_mark(self.spark, self.lake.table("silver", n), SILVER_STAMP, DAY) for n in logs]
        return latest_of(*marks, *(self.history(name).run for name in histories))

    def history(self, name: str) -> VersionStore:
        return self.lake.history(self.spark, "silver", name)


def newest_log_rows(log: DataFrame, key: Sequence[str]) -> DataFrame:
    """The present rows of an appended silver table; each run appends a key once."""
    return newest_of_runs(log.drop(DAY), key, SILVER_STAMP)


def mark_of(spark: SparkSession, table: str) -> datetime | None:
    """How far silver had come when the table was last brought up to date."""
    return recorded_mark(spark, table, _PROPERTY)


def set_mark(spark: SparkSession, table: str, mark: datetime) -> None:
    record_mark(spark, table, _PROPERTY, mark)


def is_current(spark: SparkSession, table: str, reached: datetime | None) -> bool:
    """True if silver, having come as far as ``reached``, holds nothing new for the table."""
    mark = mark_of(spark, table)
    return reached is None or (mark is not None and reached <= mark)
