"""A training corpus from raw documents: the stages in order, each written and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import benchmark_passages
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.operators.staging import discard, outlasting, scratch_path, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No stage of minhash, recompression, alignment or packing can be said in SQL.
ORACLE_SQL = None


def _among(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of documents with ids in a column ``id``; null equals null."""
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["id"]), how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the verdict depends on text and language.

    Null and empty texts have no words and are rejected. Equal rows share a verdict; ids,
    null or repeated, play no part. No documents give no documents.
    """
    key = F.struct(F.xxhash64("text", "lang").alias("a"), F.hash("lang", "text").alias("b"))
    with scratch_scope(spark):
        judged = quality_rules(docs.select(key.alias("doc_id"), "text", "lang"))
        rejected = outlasting(judged.where(~F.col("kept")).select("doc_id.*").distinct(), "rejected")
    same = (F.xxhash64(docs["text"], docs["lang"]) == rejected["a"]) & (
        F.hash(docs["lang"], docs["text"]) == rejected["b"]
    )
    return docs.join(rejected, same, "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5 words, 0.8) the document with the least doc_id stays.

    Of rows equal in doc_id and text one stays; rows that share a doc_id only are versions
    of one document and share its fate. Rows without a doc_id or without words stay.
    """
    with scratch_scope(spark):
        fates = outlasting(
            near_duplicates(docs, k=5, percent=80)
            .groupBy(F.col("doc_id").alias("id"))
            .agg(F.count("*").alias("n"), F.bool_and("kept").alias("kept")),
            "fates",
        )
    left = _among(docs, fates.where(~F.col("kept")).select("id"), "left_anti")
    repeated = fates.where("kept AND n > 1").select("id")
    once = _among(left, repeated, "left_anti")
    return once.unionByName(_among(left, repeated, "left_semi").dropDuplicates(["doc_id", "text"]))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages leave the texts; a text without any stays as it is, byte by byte.

    Null and empty texts stay as they are. Of equal rows each counts as a document, so their
    texts lose all words if they are as long as a window. No row goes.
    """
    cut = remove_repeats(docs)
    changed = F.col("kept_text").isNotNull()
    return cut.select(
        *(F.col("row")[c].alias(c) for c in docs.columns if c not in ("text", "n_chars")),
        F.coalesce("kept_text", F.col("row.text")).alias("text"),
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars"),
    ).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go.

    Null and empty texts hold no passage and stay, as do all documents where the benchmark
    is empty. A document is known by 64 bits of its doc_id and text, so equal rows share a
    fate, and null ids are ids like any other.
    """
    key = F.xxhash64("doc_id", "text")
    with scratch_scope(spark):
        found = benchmark_passages(
            docs.select(key.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
        )
        leaks = outlasting(found.select(F.col("doc_id").alias("leak")).distinct(), "leaks")
    return docs.join(leaks, F.xxhash64(docs["doc_id"], docs["text"]) == leaks["leak"], "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of all documents in sequences of at most 2048.

    Null and empty texts are the one token that closes a document. Each row is a document of
    its own, its doc_id null or repeated. Equal pieces share out places in any order.
    """
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and reread; what they wrote besides is deleted at their end."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
