"""Dense surrogate keys without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.staging import stored

# monotonically_increasing_id() is the partition number above 33 bits of row position.
_POSITION_BITS = 33


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    start: int = 0,
    partitions: int | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Add ``name`` = start + 1, start + 2, ... in the order of the columns ``order``.

    The same numbers as a global ``row_number()`` (``order`` must be unique), from one
    range shuffle: each partition numbers its own rows by position, the result is
    written, and the sizes of the partitions before it give every partition its
    offset. Only those sizes, one number per partition, visit the driver.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    written = stored(ranged.drop(*drop), "numbered")
    part = F.shiftright("_position", _POSITION_BITS).cast("int")
    sizes = {
        row["part"]: row["size"]
        for row in written.groupBy(part.alias("part")).agg(F.count("*").alias("size")).collect()
    }
    if not sizes:
        return written.withColumn(name, F.lit(None).cast("long")).drop("_position")
    offsets = list(accumulate((sizes.get(p, 0) for p in range(max(sizes))), initial=start))
    local = F.col("_position").bitwiseAND((1 << _POSITION_BITS) - 1)
    return written.withColumn(
        name, F.element_at(F.lit(offsets).cast("array<bigint>"), part + 1) + local + 1
    ).drop("_position")
