import pytest
from pyspark.sql import functions as F

from tidemark import sinks

PARTS = ("y", "m")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id long, y int, m string")


def content(spark, name):
    return {(r.id, r.y, r.m) for r in spark.table(name).collect()}


def test_empty_batch_is_not_written(spark, lake):
    name, path = lake.table("silver", "t"), lake.path("silver", "t")
    assert not sinks.append_table(spark.range(0), name, path)
    assert not spark.catalog.tableExists(name)
    assert sinks.append_table(spark.range(2), name, path)
    assert sinks.append_table(spark.range(1), name, path)
    assert spark.table(name).count() == 3


def test_append_of_another_shape_fails(spark, lake):
    name, path = lake.table("silver", "t"), lake.path("silver", "t")
    sinks.append_table(spark.range(2), name, path)
    with pytest.raises(Exception):
        sinks.append_table(spark.range(2).withColumn("x", F.lit(1)), name, path)


def test_replacement_may_read_the_table_itself(spark, lake):
    name, path = lake.table("silver", "t"), lake.path("silver", "t")
    sinks.replace_table(spark.range(3), name, path)
    for _ in range(3):
        sinks.replace_table(spark.table(name).withColumn("id", F.col("id") + 10), name, path)
    assert sorted(r.id for r in spark.table(name).collect()) == [30, 31, 32]


def test_failed_replacement_leaves_the_old_table(spark, lake):
    name, path = lake.table("silver", "t"), lake.path("silver", "t")
    sinks.replace_table(spark.range(3), name, path)
    broken = spark.table(name).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_table(broken, name, path)
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 3
    sinks.replace_table(spark.range(5), name, path)
    assert spark.table(name).count() == 5


def test_replacement_may_change_the_schema(spark, lake):
    name, path = lake.table("gold", "t"), lake.path("gold", "t")
    sinks.replace_table(spark.range(3), name, path)
    sinks.replace_table(spark.table(name).withColumn("x", F.lit("a")), name, path)
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 3


def test_partition_overwrite_touches_nothing_else(spark, lake):
    name, path = lake.table("gold", "t"), lake.path("gold", "t")
    sinks.append_partitions(rows(spark, (1, 2020, "a"), (2, 2020, "b"), (3, 2021, None), (4, None, None)), name, path, PARTS)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    sinks.overwrite_partitions(rows(spark, (5, 2020, "a")), name, path, PARTS)
    assert content(spark, name) == {(5, 2020, "a"), (2, 2020, "b"), (3, 2021, None), (4, None, None)}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_partitions_left_without_rows_are_emptied(spark, lake):
    name, path = lake.table("gold", "t"), lake.path("gold", "t")
    sinks.append_partitions(rows(spark, (1, 2020, "it's"), (2, None, None), (3, 2021, "c")), name, path, PARTS)
    sinks.overwrite_partitions(rows(spark, (9, 2022, "x")), name, path, PARTS, [(2020, "it's"), (None, None)])
    assert content(spark, name) == {(9, 2022, "x"), (3, 2021, "c")}


def test_replace_rows(spark, lake):
    name, path = lake.table("gold", "t"), lake.path("gold", "t")
    sinks.append_partitions(
        rows(spark, (1, 2020, "a"), (2, 2020, "a"), (3, 2020, "b"), (4, None, None), (5, 2021, "c")), name, path, PARTS
    )
    candidates = [(2020, "a"), (2020, "b"), (2021, "c"), (2022, "d"), (None, None)]
    stale = spark.createDataFrame([(1,), (3,), (4,), (6,)], "id long")
    fresh = rows(spark, (1, 2020, "b"), (3, 2021, "c"), (4, 2022, "d"), (6, 2022, "d"))
    wanted = {(1, 2020, "b"), (2, 2020, "a"), (3, 2021, "c"), (4, 2022, "d"), (5, 2021, "c"), (6, 2022, "d")}
    for _ in range(2):
        sinks.replace_rows(fresh, stale, ["id"], name, path, PARTS, candidates)
        assert content(spark, name) == wanted
        assert spark.table(name).count() == 6


def test_replace_rows_by_a_part_of_the_partition(spark, lake):
    name, path = lake.table("gold", "t"), lake.path("gold", "t")
    sinks.append_partitions(rows(spark, (1, 2020, "a"), (2, 2020, "b"), (3, 2021, "a")), name, path, PARTS)
    sinks.replace_rows(
        rows(spark, (1, 2020, "z")), spark.createDataFrame([(1,)], "id long"), ["id"], name, path, PARTS, [(2020,)], by=["y"]
    )
    assert content(spark, name) == {(1, 2020, "z"), (2, 2020, "b"), (3, 2021, "a")}


def test_partition_filter_prunes_folders(spark, lake):
    name, path = lake.table("gold", "t"), lake.path("gold", "t")
    sinks.append_partitions(rows(spark, (1, 2020, "a"), (2, 2020, "b"), (3, None, None)), name, path, PARTS)
    picked = sinks.in_partitions(spark.table(name), PARTS, [(2020, "a"), (None, None)])
    assert {r.id for r in picked.collect()} == {1, 3}
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
