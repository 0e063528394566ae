"""The operators over the whole test tables, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.chat_format import format_chats
from tidemark.llm.collocations import collocations
from tidemark.llm.decontamination import benchmark_passages
from tidemark.llm.jaccard_join import jaccard_groups
from tidemark.llm.lexical_search import ranked_search
from tidemark.llm.license_scan import scan_licenses, templates
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.quality_classifier import score_quality
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.toxicity import score_toxicity
from tidemark.llm.url_filters import judge_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"), templates(spark))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), folds=5, held_out=0)


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=80)


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, row=["doc_id"]).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


#: (verdict, host, path)
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(_table(spark, sf_dir, "conversations"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), folds=3, held_out=1)


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


@query
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"), k=3, percent=90)


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
