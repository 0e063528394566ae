"""Labelled rows to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(folds: int) -> Column:
    """The crc32 of the doc_id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``most`` documents outside the fold ``held_out``.

    The ids are those of the least hashes, the same ones at every run. Null labels teach
    nothing; of several labels of a document the least counts. Equal texts count once, as
    the document of the least id labels them.
    """
    chosen = (
        labels.where((fold(folds) != held_out) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    # at most ``most`` rows of two numbers: Spark broadcasts them by their size
    return (
        docs.select("doc_id", "text").where("text IS NOT NULL").join(chosen, "doc_id")
        .groupBy("text").agg(F.min(F.struct("doc_id", "label")).alias("row"))
        .select("row.doc_id", "text", "row.label")
    )
