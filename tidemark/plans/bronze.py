"""Bronze: source tables as they are, appended per run."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import datetime
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.lake import Lake
from tidemark.plans.together import together
from tidemark.registry import TABLES, Table
from tidemark.sinks import append_table, create_database
from tidemark.sources import extract, latest_of, layer_mark, record_mark, recorded_mark

STAMP = "raw_extraction_time"
DAY = "extraction_day"
_WHOLE_LOAD = "tidemark.whole_load"


def load_table(
    spark: SparkSession, lake: Lake, source, table: Table, as_of: str | datetime, snapshot: bool | None = None
) -> bool:
    """Append one table's changes since the last load, or the whole table as a snapshot.

    False if there was nothing to append. Runs are kept apart in one folder per day, so
    later layers read only the days they have not seen. An ``as_of`` before the last
    load is refused: later layers would take its rows for old ones.

    The instant of the last whole load is recorded even if it brought no rows: what it
    and the loads after it lack is gone from the source.
    """
    name, path = lake.table("bronze", table.name), lake.path("bronze", table.name)
    mark = latest_of(layer_mark(spark, name, STAMP, DAY), whole_load_mark(spark, name))
    if mark is not None and datetime.fromisoformat(str(as_of)) < mark:
        raise ValueError(f"{name} was loaded as of {mark}, after {as_of}")
    whole = table.snapshot if snapshot is None else snapshot
    since = None if whole else mark
    rows = extract(spark, source, table, as_of, since).withColumn(DAY, F.col(STAMP).cast("date"))
    appended = append_table(rows, name, path, [DAY])
    if since is None and spark.catalog.tableExists(name):
        record_mark(spark, name, _WHOLE_LOAD, datetime.fromisoformat(str(as_of)))
    return appended


def whole_load_mark(spark: SparkSession, table: str) -> datetime | None:
    """When a bronze table was last loaded whole."""
    return recorded_mark(spark, table, _WHOLE_LOAD)


def load_all(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, object],
    as_of: str | datetime,
    whole: Collection[str] = (),
) -> dict[str, bool]:
    """Load every registered table from the source of its system, those in ``whole`` in full."""
    create_database(spark, lake.database)

    def load(table: Table) -> bool:
        return load_table(spark, lake, sources[table.system], table, as_of, table.snapshot or table.name in whole)

    return dict(zip(TABLES, together([partial(load, t) for t in TABLES.values()])))
