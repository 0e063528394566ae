import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import frequent_values, join_as_of, long_histories, spread_left_join

T0 = EPOCH = datetime(2020, 1, 1)
VERSIONS = "k long, start_date timestamp_ntz, end_date timestamp_ntz, sk long"


def day(n):
    return T0 + timedelta(days=n)


@pytest.fixture
def versions(spark):
    return spark.createDataFrame([(1, day(0), day(10), 1), (1, day(10), day(99), 2), (2, day(5), day(99), 3)], VERSIONS)


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, k long, at timestamp_ntz")


def test_boundary_matches_once_and_twice_if_inclusive(spark, versions):
    one = facts(spark, (1, 1, day(10)))
    assert [r.sk for r in join_as_of(one, versions, "k", "at", ["sk"]).collect()] == [2]
    both = join_as_of(one, versions, "k", "at", ["sk"], inclusive=True)
    assert sorted(r.sk for r in both.collect()) == [1, 2]


def test_facts_without_a_version_stay(spark, versions):
    lost = facts(spark, (1, 7, day(1)), (2, 2, day(1)), (3, None, day(1)), (4, 1, None))
    assert {(r.id, r.sk) for r in join_as_of(lost, versions, "k", "at", ["sk"]).collect()} == {(i, None) for i in (1, 2, 3, 4)}


def random_case(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        k = rng.choice([1, 1, 1, None, None] + list(range(2, 12)))
        rows.append((i, k, day(rng.randrange(-5, 60))))
    history, sk = [], 0
    for k in range(1, 10):
        at = rng.randrange(0, 10)
        while at < 40:
            to = at + rng.randrange(1, 15)
            sk += 1
            history.append((k, day(at), day(to), sk))
            at = to
    return rows, history


def brute(rows, history):
    found = Counter()
    for i, k, at in rows:
        hits = [sk for vk, a, b, sk in history if vk == k and a <= at < b] or [None]
        found.update((i, k, sk) for sk in hits)
    return found


@pytest.mark.parametrize("hot", [None, {1: 0.5}, {1: 0.4, None: 0.3}, {None: 0.3}, {1: 0.4, 2: 0.01, 999: 0.1}])
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_spreading_never_changes_the_result(spark, hot, threshold):
    rows, history = random_case(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        joined = join_as_of(facts(spark, *rows), spark.createDataFrame(history, VERSIONS), "k", "at", ["sk"], hot=hot)
        got = Counter((r.id, r.k, r.sk) for r in joined.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute(rows, history)


def test_hot_rows_are_dealt_over_partitions(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Identical copies, so that nothing in the rows tells them apart, and NULLs.
        left = spark.range(0, 8000, 1, 16).select(F.when(F.col("id") % 2 == 0, 1).alias("k"), F.lit("same").alias("v"))
        right = spark.createDataFrame([(1, "one")], "rk int, name string")
        plain = spread_left_join(left, right, "k", "rk").groupBy(F.spark_partition_id().alias("p")).count().collect()
        spread = spread_left_join(left, right, "k", "rk", hot={1: 0.5, None: 0.5}, partitions=64)
        dealt = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in plain) >= 4000
        assert max(r["count"] for r in dealt) < 4000 and len(dealt) == 4
        assert spread.where("k = 1 AND name = 'one'").count() == 4000
        assert spread.where("k IS NULL AND name IS NULL").count() == 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_frequent_values(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("a"),
        F.when(F.col("id") % 4 != 0, F.col("id")).alias("b"),
    )
    assert frequent_values(df, ["a", "b"], share=0.01) == {"a": {7: 667 / 2000}, "b": {None: 0.25}}
    assert frequent_values(df, ["a", "b"])["a"] == {7: 667 / 2000}
    assert frequent_values(df, ["a"], least_share=0.5) == {"a": {}}
    many = spark.range(200_000).select(F.when(F.col("id") % 9 < 3, F.lit("x")).otherwise(F.col("id").cast("string")).alias("a"))
    assert set(frequent_values(many, ["a"], share=0.001)["a"]) == {"x"}
    assert frequent_values(df.limit(0), ["a"]) == {"a": {}}


def test_copies_stay_few():
    from tidemark.operators.skew import _by_pieces

    shares = {i: 1 / 1000 for i in range(600)} | {"a third": 1 / 3}
    groups = _by_pieces(shares, 1000)
    assert sum(pieces * len(values) for pieces, values in groups.items()) <= 6 * 1000
    assert "a third" in groups[1024] and len(groups[2]) == 600


def test_adaptive_execution_splits_a_hot_key_by_itself(spark):
    """Where no spreading is asked for, Spark's own skew join takes over."""
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    }
    before = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 40_000, 1, 16).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.lit(day(1)).cast("timestamp_ntz").alias("at"),
            F.sha2(F.col("id").cast("string"), 512).alias("v"),
        )
        right = spark.range(40_000).selectExpr("id AS k", "timestamp_ntz'2020-01-01' AS start_date", "timestamp_ntz'2021-01-01' AS end_date", "id AS sk")
        joined = join_as_of(left, right, "k", "at", ["sk"])
        assert joined.where("sk = k").count() == 40_000
        counted = joined.groupBy().agg(F.sum("sk"), F.max("v"))
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_are_dealt_out_by_the_engine_itself(spark):
    from tidemark.catalogue import QUERIES

    plan = QUERIES["fact_sales_hot_keys"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "_piece" in plan


@pytest.mark.parametrize("inclusive", [False, True])
def test_long_histories_are_met_bin_by_bin(spark, inclusive):
    rng = random.Random(11)
    rows = []
    for key, n in ((1, 3000), (2, 500), (3, 3), (None, 2)):
        start = 0
        for i in range(n):
            end = start + rng.choice([1, 2, 60, 3600, 86_400, 400_000])
            # some versions overlap, one of each key stays open
            last = datetime(9999, 12, 31) if i == n - 1 else EPOCH + timedelta(seconds=end + rng.choice([0, 0, 0, 50_000]))
            rows.append((key, EPOCH + timedelta(seconds=start), last, i))
            start = end
    history = spark.createDataFrame(rows, "k long, start_date timestamp_ntz, end_date timestamp_ntz, version int")
    spread = 3000 * 80_000
    made = [(i, rng.choice([1, 1, 1, 2, 3, 4, None]), EPOCH + timedelta(seconds=rng.randrange(-10**6, spread))) for i in range(4000)]
    made += [(4000 + i, r[0], r[1], ) for i, r in enumerate(rows[:50])]
    facts = spark.createDataFrame(made, "id long, k long, at timestamp_ntz")
    long = long_histories(history, "k")
    assert {r._long_key for r in long.collect()} == {1, 2}
    plain = join_as_of(facts, history, "k", "at", ["version"], inclusive=inclusive)
    binned = join_as_of(facts, history, "k", "at", ["version"], inclusive=inclusive, long=long)
    spread_too = join_as_of(facts, history, "k", "at", ["version"], {1: 0.5, None: 0.1}, inclusive, long)
    wanted = Counter(map(tuple, plain.collect()))
    assert Counter(map(tuple, binned.collect())) == wanted and Counter(map(tuple, spread_too.collect())) == wanted
    assert long_histories(history.where("k = 3"), "k") is None
    plan = binned._jdf.queryExecution().optimizedPlan().toString()
    assert "_fact_bin" in plan and "_version_bin" in plan
