"""Picking the newest copy of each row, and the rows past a mark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import instant
from tidemark.operators.staging import right_side, stored


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties settled by the other columns.

    ``max`` over a struct combines on the map side, so a key with very many copies
    reaches the shuffle as one row per map task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    best = F.max(F.struct(*order, *rest))
    grouped = df.groupBy(*key).agg(best.alias("newest"))
    return grouped.select(*[F.col(c) if c in key else F.col(f"newest.{c}").alias(c) for c in df.columns])


def latest_of_few_repeats(df: DataFrame, key: Sequence[str], order: Sequence[str], most: float = 0.1) -> DataFrame:
    """:func:`latest_per_key` of a stored frame in which few keys come more than once.

    Only a hash of the keys moves; it tells which rows may have a rival. The others stay
    where they are, neither sorted nor shuffled. If more than ``most`` of the rows have a
    hash that repeats, all rows go the plain way. Equal hashes of unequal keys do no harm.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*key))
    twice = hashed.groupBy("_hash").agg(F.count("*").alias("_times")).where("_times > 1")
    twice = stored(twice, "repeated-keys")
    repeated, hashes = twice.agg(F.sum("_times"), F.count("*")).first()
    if not repeated:
        return df
    if repeated > most * df.count():
        return latest_per_key(df, key, order)
    twice = right_side(twice, hashes)
    single = hashed.join(twice, "_hash", "left_anti").select(df.columns)
    rivals = hashed.join(twice, "_hash", "left_semi").select(df.columns)
    return single.unionByName(latest_per_key(rivals, key, order))


def newest_of_runs(log: DataFrame, key: Sequence[str], run: str) -> DataFrame:
    """The newest row per key of a log in which a run has each key once at most.

    Nothing to do for a log of one run. Else the keys of the later runs, which are few,
    tell which rows are out of date: a hash aggregate of their stamps and one join, so
    the rows of the first run are neither sorted nor, beside few keys, moved.
    """
    first, last = log.agg(F.min(run), F.max(run)).first()
    if first == last:
        return log
    since = log.where(F.col(run) > F.lit(first))
    later = since.groupBy(*key).agg(F.max(run).alias("_newest"))
    later = right_side(later, since.count())
    kept = log.join(later, list(key), "left").where(F.col("_newest").isNull() | (F.col(run) == F.col("_newest")))
    return kept.select(log.columns)


def past_mark(df: DataFrame, column: str, mark: datetime | str | None, day: str | None = None) -> DataFrame:
    """The rows strictly past ``mark``; all rows if there is none.

    ``day``, a partition column holding the date of ``column``, lets the scan skip
    the folders of earlier days.
    """
    if mark is None:
        return df
    past = F.col(column) > instant(mark)
    if day:
        past = past & (F.col(day) >= instant(mark).cast("date"))
    return df.where(past)


def newer_than(df: DataFrame, column: str, mark: datetime | str | None, day: str | None = None) -> DataFrame:
    """:func:`past_mark` with fully equal rows taken once."""
    return past_mark(df, column, mark, day).dropDuplicates()
