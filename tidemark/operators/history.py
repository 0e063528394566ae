"""Type 2 history: versions of a row, each with its validity interval.

A history frame holds the business columns plus

* ``start_date``, ``end_date``: the version is valid in ``[start_date, end_date)``;
* ``current_flag``: true on the open version, whose end is the far future;
* ``sk_<key>``: dense surrogate key of the version;
* ``extraction_closed``: the run that closed the version, NULL while it is open.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import FAR_FUTURE, fingerprint, instant
from tidemark.operators.keys import number_rows
from tidemark.operators.latest import latest_per_key
from tidemark.operators.staging import right_side, stored

_STAMPS = ("updated_at", "raw_extraction_time", "extraction_bronze")


def newest_of_batch(batch: DataFrame, key: str) -> DataFrame:
    """The batch reduced to the newest row per key."""
    return latest_per_key(batch, [key], [c for c in _STAMPS if c in batch.columns])


def first_versions(batch: DataFrame, key: str) -> DataFrame:
    """The history a first batch makes: one open version per key."""
    opened = _opened(newest_of_batch(batch, key), F.col("created_at"))
    return number_rows(opened, [key], f"sk_{key}")


def classify(history: DataFrame, batch: DataFrame, key: str, tracked: Sequence[str], separator: str | None = None) -> DataFrame:
    """``(key, action)`` for every key open in ``history`` or present in ``batch``.

    INSERT, DELETE, UPDATE or NOCHANGE, told apart by the fingerprint of the tracked
    columns.
    """
    mark = fingerprint(*tracked, separator=separator)
    old = history.where("current_flag").select(F.col(key).alias("old_key"), mark.alias("old_mark"))
    new = newest_of_batch(batch, key).select(F.col(key).alias("new_key"), mark.alias("new_mark"))
    action = (
        F.when(F.col("new_key").isNull(), "DELETE")
        .when(F.col("old_key").isNull(), "INSERT")
        .when(F.col("old_mark") == F.col("new_mark"), "NOCHANGE")
        .otherwise("UPDATE")
    )
    return old.join(new, F.col("old_key") == F.col("new_key"), "full_outer").select(
        F.coalesce("new_key", "old_key").alias(key), action.alias("action")
    )


def merge_versions(
    history: DataFrame,
    batch: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: str | datetime,
    batch_kind: str = "delta",
    version_start: str = "updated_at",
) -> DataFrame:
    """The history after ``batch``.

    Closed versions stay. An open version stays if the tracked columns agree with the
    batch (other columns are not looked at), and closes at the batch row's
    ``updated_at`` if they differ; the new version opens at that instant, or at its
    ``created_at`` for a new key. A key missing from the batch stays in a ``"delta"``
    and closes at ``as_of`` in a ``"snapshot"``. A key that was closed before reopens
    at its ``updated_at``, never before its last end. New surrogate keys follow the
    largest one: inserts first, then updates, each by key.

    ``version_start="created_at"`` starts every new version at ``created_at`` instead;
    intervals may then overlap.

    A small batch is broadcast to the open history, which is then not shuffled at all. A
    batch without news gives back ``history`` itself.
    """
    if batch_kind not in ("delta", "snapshot"):
        raise ValueError(f"unknown batch kind {batch_kind!r}")
    if version_start not in ("updated_at", "created_at"):
        raise ValueError(f"unknown version start {version_start!r}")
    current = history.where(F.col("current_flag"))
    closed = history.where(~F.col("current_flag"))
    highest = history.agg(F.max(f"sk_{key}")).first()[0] or 0
    merged = merge_open(current, closed, batch, key, tracked, as_of, batch_kind, version_start, highest)
    if merged is None:
        return history
    return closed.unionByName(merged.versions)


@dataclass(frozen=True)
class Merged:
    """The open versions after a merge, those among them that it closed, and the largest key."""

    versions: DataFrame
    highest: int


def merge_open(
    current: DataFrame,
    closed: DataFrame,
    batch: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: str | datetime,
    batch_kind: str = "delta",
    version_start: str = "updated_at",
    highest: int = 0,
) -> Merged | None:
    """:func:`merge_versions` of a history held in parts; None if the batch has no news.

    Of the ``closed`` versions only key and end are read, for keys that are not open.
    """
    surrogate = f"sk_{key}"
    batch = stored(newest_of_batch(batch, key), "batch")
    run = instant(as_of)
    rows = batch.count()
    kept = _close_changed(current, batch, key, tracked, run, batch_kind, rows)
    fresh = _new_versions(current, closed, batch, key, tracked, run, version_start, rows)
    fresh = number_rows(fresh, ["_rank", key], surrogate, start=highest, drop=["_rank"])
    added = fresh.count()
    if not added and (batch_kind == "delta" or kept.where(~F.col("current_flag")).isEmpty()):
        return None
    columns = current.columns
    return Merged(kept.select(columns).unionByName(fresh.select(columns)), highest + added)


def _opened(rows: DataFrame, start: Column) -> DataFrame:
    """Batch rows as open versions, still without a surrogate key."""
    business = [c for c in rows.columns if c not in ("created_at", "updated_at")]
    return rows.select(
        *business,
        start.alias("start_date"),
        instant(FAR_FUTURE).alias("end_date"),
        F.lit(True).alias("current_flag"),
        F.lit(None).cast("timestamp_ntz").alias("extraction_closed"),
    )


def _agree(tracked: Sequence[str], left: str, right: str) -> Column:
    pairs = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in tracked]
    return reduce(Column.__and__, pairs, F.lit(True))


def _change_instant(updated_at: Column, start: Column, run: Column) -> Column:
    """When a version gives way: never before it began."""
    return F.greatest(F.coalesce(updated_at, run), start)


def _close_changed(current, batch, key, tracked, run, batch_kind, rows) -> DataFrame:
    incoming = batch.select(
        F.col(key).alias("_key"), F.struct(F.lit(1), *tracked).alias("_new"), F.col("updated_at").alias("_updated_at")
    )
    held = current.withColumn("_old", F.struct(F.lit(1), *tracked))
    incoming = right_side(incoming, rows)
    joined = held.join(incoming, held[key] == incoming["_key"], "left")
    changed_end = _change_instant(F.col("_updated_at"), F.col("start_date"), run)
    end = F.when(F.col("_key").isNotNull() & ~_agree(tracked, "_old", "_new"), changed_end)
    if batch_kind == "snapshot":
        end = end.when(F.col("_key").isNull(), F.greatest(run, F.col("start_date")))
    return (
        joined.withColumn("_end", end)
        .withColumns(
            {
                "end_date": F.coalesce("_end", "end_date"),
                "current_flag": F.col("_end").isNull(),
                "extraction_closed": F.when(F.col("_end").isNotNull(), run),
            }
        )
        .drop("_key", "_old", "_new", "_updated_at", "_end")
    )


def _new_versions(current, closed, batch, key, tracked, run, version_start, rows_of_batch) -> DataFrame:
    # A key has one row in the batch and one open version, so none of the right sides below
    # has more rows than the batch.
    keys = right_side(batch.select(F.col(key).alias("_batch_key")), rows_of_batch)
    # Narrow the history to the batch's keys before anything wide is joined.
    open_now = current.join(keys, current[key] == keys["_batch_key"], "left_semi").select(
        F.col(key).alias("_key"), F.struct(F.lit(1), *tracked).alias("_old"), F.col("start_date").alias("_start")
    )
    ended = (
        closed.join(keys, closed[key] == keys["_batch_key"], "left_semi")
        .groupBy(F.col(key).alias("_ended_key"))
        .agg(F.max("end_date").alias("_last_end"))
    )
    open_now, ended = right_side(open_now, rows_of_batch), right_side(ended, rows_of_batch)
    rows = batch.withColumn("_new", F.struct(F.lit(1), *tracked))
    rows = (
        rows.join(open_now, rows[key] == open_now["_key"], "left")
        .where(F.col("_key").isNull() | ~_agree(tracked, "_old", "_new"))
        .join(ended, F.col(key) == F.col("_ended_key"), "left")
    )
    if version_start == "created_at":
        start = F.col("created_at")
    else:
        start = (
            F.when(F.col("_key").isNotNull(), _change_instant(F.col("updated_at"), F.col("_start"), run))
            .when(F.col("_last_end").isNotNull(), _change_instant(F.col("updated_at"), F.col("_last_end"), run))
            .otherwise(F.col("created_at"))
        )
    opened = _opened(rows, start).withColumn("_rank", F.when(F.col("_key").isNull(), 0).otherwise(1))
    return opened.drop("_new", "_key", "_old", "_start", "_ended_key", "_last_end")
