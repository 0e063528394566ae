"""Left joins that stay balanced when a few keys hold much of the left side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Value (NULL included) to the share of the rows that have it.
Shares = Mapping[object, float]


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def frequent_values(
    df: DataFrame,
    columns: Sequence[str],
    share: float | None = None,
    least_share: float = 1e-4,
) -> dict[str, Shares]:
    """Per column, the values holding at least ``share`` of the rows, and how much.

    Without a ``share``, those that would fill a shuffle partition by themselves, but
    none below ``least_share``. One pass with a frequent-items sketch per column; its
    estimates only decide how a join is carried out, never what it returns. There are at
    most ``1 / share`` values per column, whatever the size of the frame.
    """
    share = share or max(1 / _shuffle_partitions(df.sparkSession), least_share)
    most = ceil(1 / share)
    # Eight times the values asked for, so that estimates are off by an eighth of a share.
    sketches = [F.expr(f"approx_top_k(`{c}`, {most}, {8 * most})").alias(c) for c in columns]
    counted = df.select(*columns).agg(F.count("*").alias("_rows"), *sketches).first()
    least = share * counted["_rows"]
    return {
        c: {item["item"]: item["count"] / counted["_rows"] for item in counted[c] if item["count"] >= least}
        for c in columns
    }


def _by_pieces(hot: Shares, partitions: int) -> dict[int, list]:
    """The hot values by the number of pieces to deal them into, a power of two.

    A value gets at least twice the pieces its share of the partitions comes to. Over
    all values that is at most a few copies of a right row per shuffle partition.
    """
    groups: dict[int, list] = {}
    for value, share in hot.items():
        pieces = 2 ** max(1, ceil(log2(2 * share * partitions)))
        groups.setdefault(pieces, []).append(value)
    return groups


def _piece_count(key: str, groups: Mapping[int, Sequence], with_null: bool) -> Column:
    """How many pieces the row's key is dealt into; one for keys that are not hot."""
    count = F.lit(1)
    for pieces, values in groups.items():
        named = [v for v in values if v is not None]
        if named:
            count = F.when(F.col(key).isin(named), pieces).otherwise(count)
        if with_null and None in values:
            count = F.when(F.col(key).isNull(), pieces).otherwise(count)
    return count


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    hot: Shares | None = None,
    extra: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on the keys (and ``extra``), without ``right_key``.

    Left rows of a hot key are dealt into pieces that go to different shuffle
    partitions, and the right rows of just that key are copied to each piece. NULL,
    which matches nothing, is dealt out too and needs no copies. The right side must
    hold few rows per key, as a lookup or a version history does, and share no column
    name with the left.
    """
    on = F.col(left_key) == F.col(right_key)
    if extra is not None:
        on = on & extra
    if not hot:
        return left.join(right, on, "left").drop(right_key)

    groups = _by_pieces(hot, partitions or _shuffle_partitions(left.sparkSession))
    # The partition number parts identical copies; it is the same on every retry.
    deal = F.xxhash64(*left.columns, F.spark_partition_id())
    dealt = left.withColumn("_piece", F.pmod(deal, _piece_count(left_key, groups, True)).cast("int"))
    copies = F.sequence(F.lit(0), _piece_count(right_key, groups, False) - 1)
    copied = right.withColumn("_copy", F.explode(copies))
    return dealt.join(copied, on & (F.col("_piece") == F.col("_copy")), "left").drop("_piece", "_copy", right_key)
