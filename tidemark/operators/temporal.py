"""Point-in-time join of facts to a versioned dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import Shares, spread_left_join
from tidemark.operators.staging import stored


def long_histories(dimension: DataFrame, key: str, most_versions: int = 64) -> DataFrame | None:
    """The keys with more than ``most_versions`` versions, with the bins to hold their times
    in: as many as versions, from the first start to the last. None if there are none.

    For :func:`join_as_of`. One narrow aggregation of the dimension.
    """
    seconds = _seconds(F.col("start_date"))
    bins = (
        dimension.groupBy(F.col(key).alias("_long_key"))
        .agg(F.count("*").alias("_bins"), F.min(seconds).alias("_from"), F.max(seconds).alias("_to"))
        .where(F.col("_bins") > most_versions)
        .select("_long_key", "_bins", "_from", F.greatest((F.col("_to") - F.col("_from")) / F.col("_bins"), F.lit(1.0)).alias("_width"))
    )
    bins = stored(bins, "long-histories")
    return None if bins.isEmpty() else bins


def _seconds(time: Column) -> Column:
    """Whole seconds, in the order of the times whatever the session's time zone."""
    days = F.date_diff(F.to_date(time), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def _bin(time: Column) -> Column:
    """The bin of an instant, those before the first and after the last in one each; -1 for
    keys without bins."""
    place = F.floor((_seconds(time) - F.col("_from")) / F.col("_width"))
    return F.coalesce(F.least(F.greatest(place, F.lit(0)), F.col("_bins") + 1), F.lit(-1)).cast("long")


def join_as_of(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    at: str,
    take: Sequence[str],
    hot: Shares | None = None,
    inclusive: bool = False,
    long: DataFrame | None = None,
) -> DataFrame:
    """Each fact with the columns ``take`` of its key's version valid at ``at``.

    A version is valid in ``[start_date, end_date)``; ``inclusive`` counts the end too,
    which matches two versions at the instant they meet. Facts without a valid version
    stay, with NULLs. The key is an equality, so Spark hashes or merges on it and tests
    the interval on the pairs; a key's versions number at most one per merge that has
    been run, since a merge takes one row per key.

    ``long`` (:func:`long_histories`) names keys with very many versions. Their versions
    are copied to the time bins they touch, about two each, and a fact meets those of its
    own bin only.
    """
    # Own names for the dimension's columns: facts may carry the same ones.
    versions = dimension.select(
        F.col(key).alias("_key"),
        F.col("start_date").alias("_start"),
        F.col("end_date").alias("_end"),
        *[F.col(c).alias(f"_take_{c}") for c in take],
    )
    when = F.col(at).cast("timestamp_ntz")
    valid = (F.col("_start") <= when) & ((when <= F.col("_end")) if inclusive else (when < F.col("_end")))
    kept = [c for c in facts.columns if c not in take]
    if long is not None:
        bins = [c for c in long.columns if c != "_long_key"]
        versions = versions.join(long, F.col("_key") == F.col("_long_key"), "left")
        touched = F.sequence(_bin(F.col("_start")), _bin(F.greatest("_end", "_start")))
        versions = versions.withColumn("_version_bin", F.explode(touched)).drop("_long_key", *bins)
        facts = facts.join(long, F.col(key) == F.col("_long_key"), "left")
        facts = facts.withColumn("_fact_bin", _bin(when)).drop("_long_key", *bins)
        valid = valid & (F.col("_fact_bin") == F.col("_version_bin"))
    joined = spread_left_join(facts, versions, key, "_key", hot=hot, extra=valid)
    return joined.select(*kept, *[F.col(f"_take_{c}").alias(c) for c in take])
