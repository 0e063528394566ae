import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import latest_of_few_repeats, latest_per_key, newer_than, newest_of_runs, number_rows


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_number_rows_equals_global_row_number(spark, adaptive, partitions):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        rows = spark.range(5000).select((F.col("id") * 7919 % 100_003).alias("k"), F.lit("x").alias("v"))
        got = number_rows(rows, ["k"], "n", start=10, partitions=partitions)
        want = rows.select("*", (F.row_number().over(Window.orderBy("k")) + 10).cast("long").alias("n"))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_number_rows_of_nothing_and_fewer_rows_than_partitions(spark):
    assert number_rows(spark.range(0), ["id"], "n").count() == 0
    assert [r.n for r in number_rows(spark.range(3), ["id"], "n", partitions=20).orderBy("id").collect()] == [1, 2, 3]


def test_latest_per_key_against_brute_force(spark):
    rng = random.Random(3)
    # One key holds a third of the rows; stamps tie often and may be NULL.
    rows = [(rng.choice([0] * 5 + list(range(1, 11))), rng.choice([None, 1, 2, 3]), rng.choice("abc")) for _ in range(900)]
    best: dict = {}
    for k, at, v in rows:
        rank = (at is not None, at or 0, v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, at, v))
    df = spark.createDataFrame(rows, "k int, at int, v string").repartition(6)
    got = {tuple(r) for r in latest_per_key(df, ["k"], ["at"]).collect()}
    assert got == {row for _, row in best.values()}


def test_latest_per_key_combines_before_the_shuffle(spark):
    df = spark.range(10).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.lit("x").alias("v"))
    plan = latest_per_key(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan.split("Exchange")[-1]


def test_newer_than_is_strict_and_distinct(spark):
    rows = spark.sql(
        "SELECT id, CAST(at AS TIMESTAMP_NTZ) AS at FROM VALUES "
        "(1, '2020-01-01 00:00:00'), (2, '2020-01-01 00:00:01'), (2, '2020-01-01 00:00:01'), (3, NULL) AS t(id, at)"
    )
    assert [r.id for r in newer_than(rows, "at", "2020-01-01 00:00:00").collect()] == [2]
    assert newer_than(rows, "at", None).count() == 3


def test_newest_of_runs_neither_sorts_nor_touches_a_single_run(spark):
    first = spark.range(1000).select(F.col("id").alias("k"), F.lit("1").alias("v"), F.lit("2020-01-01").cast("timestamp_ntz").alias("run"))
    assert newest_of_runs(first, ["k"], "run") is first
    second = first.where("k < 30").withColumns({"v": F.lit("2"), "run": F.lit("2020-01-02").cast("timestamp_ntz")})
    third = second.where("k < 10").union(second.where("k = 20").withColumn("k", F.lit(5000))).withColumns(
        {"v": F.lit("3"), "run": F.lit("2020-01-03").cast("timestamp_ntz")}
    )
    newest = newest_of_runs(first.union(second).union(third), ["k"], "run")
    assert {r.k: r.v for r in newest.collect()} == {
        k: "3" if k < 10 or k == 5000 else "2" if k < 30 else "1" for k in [*range(1000), 5000]
    }
    assert newest.count() == 1001
    assert "SortAggregate" not in newest._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keys", [3000, 1450, 40])
def test_latest_of_few_repeats_equals_latest_per_key(spark, keys):
    """No key twice, a few, and nearly all; NULL is a key as well."""
    rows = spark.range(1500).select(
        F.when(F.col("id") % keys != 7, F.col("id") % keys).alias("k"), F.lit("a").alias("j"),
        (F.col("id") * 7 % 11).alias("at"), F.col("id").alias("v"),
    )
    got, want = latest_of_few_repeats(rows, ["k", "j"], ["at"]), latest_per_key(rows, ["k", "j"], ["at"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_rows_without_rivals_do_not_move(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("at"))
    assert "Exchange" not in latest_of_few_repeats(rows, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
