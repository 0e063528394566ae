"""Many rows of one text, and what a run of the pipeline leaves behind."""

import hashlib
from pathlib import Path

import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm.substring_dedup import remove_repeats
from tidemark.operators.staging import scratch_folder

SMALL = "/root/testdata/sf0.001"


def test_identical_rows_lose_all_words_and_so_do_their_passages_elsewhere(spark):
    text = " ".join(f"w{i}" for i in range(300))
    same = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    other = [(1, "before " + " ".join(f"w{i}" for i in range(100, 140)) + " after"), (2, "w1 w2 w3"), (3, text)]
    docs = same.union(spark.createDataFrame(other, "doc_id long, text string"))
    found = remove_repeats(docs, row=["doc_id"]).select("row.doc_id", "n_words", "n_removed", "kept_sha256")
    counted = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256): r["count"] for r in found.groupBy(*found.columns).count().collect()}

    def digest(kept):
        return hashlib.sha256(kept.encode()).hexdigest()

    assert counted == {
        (None, 300, 300, digest("")): 10_000, (3, 300, 300, digest("")): 1,
        (1, 42, 40, digest("before after")): 1, (2, 3, 0, digest("w1 w2 w3")): 1,
    }


def test_a_run_leaves_its_result_only(spark):
    folder = Path(scratch_folder(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()} if folder.exists() else set()
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    assert [name.rsplit("-", 1)[0] for name in {p.name for p in folder.iterdir()} - before] == ["best_fit_packing"]
