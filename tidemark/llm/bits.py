"""A table of bits for 64-bit hashes: fixed in size, it never misses a hash it was made of.

Tasks take it along to leave out most of what a later join would drop. The more hashes it
holds, the less it leaves out; results never depend on it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import U64
from tidemark.operators.staging import shed_shuffles

#: Bits of a table as a power of two: 4 MB.
TABLE_BITS = 25


def bit_table(hashes: DataFrame, column: str) -> np.ndarray:
    """The table of the hashes in ``column``; the driver gets no more than the table itself."""
    shed_shuffles(hashes.sparkSession)
    place = F.shiftrightunsigned(column, 64 - TABLE_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - TABLE_BITS}) & 63 as int))")
    rows = (
        hashes.select(F.shiftright(place, 6).alias("at"), bit.alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return table.view(U64)


def held(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the table may have been made of."""
    place = hashes >> U64(64 - TABLE_BITS)
    return (table[(place >> U64(6)).astype(np.int64)] >> (place & U64(63))) & U64(1) == 1
