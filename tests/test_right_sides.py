"""Sides of joins that are small as files and large in memory."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import instant
from tidemark.operators import first_versions, latest_of_few_repeats, merge_versions, newest_of_runs, right_side, staging, stored

MANY = 300_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def batch(spark, rows, price):
    stamps = {c: instant("2020-01-01") for c in ("created_at", "updated_at")}
    return spark.range(rows).select(F.col("id").alias("k"), price.cast("decimal(12,2)").alias("price")).withColumns(stamps)


def test_rows_and_not_files_tell_whether_a_side_is_small(spark):
    keys = stored(spark.range(MANY).select(F.col("id").alias("k"), instant("2020-01-01").alias("since")), "keys")
    facts = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan(facts.join(keys, "k", "left_semi"))
    assert "BroadcastHashJoin" not in plan(facts.join(right_side(keys).select("k"), "k", "left_semi"))
    few = right_side(keys.where("k < 1000"))
    assert "BroadcastHashJoin" in plan(facts.join(few, "k", "left_semi"))
    assert facts.join(right_side(keys), "k", "left_semi").count() == facts.join(few, "k", "left_semi").count() == 10


def test_a_merge_broadcasts_no_large_batch(spark):
    history = stored(first_versions(batch(spark, MANY, F.lit(1)), "k"), "history")
    merged = merge_versions(history, batch(spark, MANY, F.col("id") % 2 + 1), "k", ["price"], "2020-02-01")
    assert "BroadcastHashJoin" not in plan(merged)
    assert merged.where("current_flag").count() == MANY and merged.count() == MANY + MANY // 2


def test_late_runs_are_not_broadcast_if_many(spark):
    log = spark.range(MANY).select(F.col("id").alias("k"), F.lit("2020-01-01").cast("timestamp_ntz").alias("run"))
    log = stored(log.union(log.withColumn("run", F.lit("2020-01-02").cast("timestamp_ntz"))), "log")
    newest = newest_of_runs(log, ["k"], "run")
    assert "BroadcastHashJoin" not in plan(newest) and newest.count() == MANY


@pytest.mark.parametrize("kind", ["delta", "snapshot"])
def test_marked_sides_give_the_same_rows(spark, monkeypatch, kind):
    def rows():
        history = stored(first_versions(batch(spark, 60, F.when(F.col("id") % 7 != 0, F.col("id"))), "k"), "history")
        price = F.when(F.col("id") % 5 != 0, F.col("id") + F.col("id") % 2)
        news = batch(spark, 80, price).where("k % 3 != 0").union(batch(spark, 1, F.lit(4)).withColumn("k", F.lit(None).cast("long")))
        merged = merge_versions(history, news, "k", ["price"], "2020-02-01", kind)
        log = history.select("k", "price", instant("2020-01-01").alias("run")).union(news.select("k", "price", instant("2020-01-02")))
        twice = latest_of_few_repeats(news.union(news.where("k = 7").withColumn("price", F.lit(99))), ["k"], ["price"])
        return [sorted(map(tuple, df.collect()), key=str) for df in (merged, newest_of_runs(log, ["k"], "run"), twice)]

    plain = rows()
    monkeypatch.setattr(staging, "MOST_BROADCAST", 0)
    assert rows() == plain
