import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import conform, fingerprint, line_total, or_label, strip_suffix, with_calendar, with_suffix


def test_fingerprint_parts_what_plain_joining_confuses(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("abc", None), ("abc", "")], "x string, y string")
    plain = rows.select(fingerprint("x", "y", separator="").alias("h")).distinct().count()
    strict = rows.select(fingerprint("x", "y").alias("h")).distinct().count()
    assert (plain, strict) == (1, 4)


def test_fingerprint_content_cannot_imitate_a_boundary(spark):
    rows = spark.createDataFrame([("a\x1f1:b", "c"), ("a", "1:b\x1f1:c"), ("-", None), (None, "-")], "x string, y string")
    assert rows.select(fingerprint("x", "y").alias("h")).distinct().count() == 4


def test_fingerprint_of_no_columns_is_one_constant(spark):
    assert spark.range(3).select(fingerprint().alias("h")).distinct().count() == 1


def test_suffix_is_taken_off_the_end_only(spark):
    df = spark.createDataFrame([(1, 2)], "a_x_b int, c int")
    assert strip_suffix(with_suffix(df, "_x"), "_x").columns == ["a_x_b", "c"]
    assert strip_suffix(df, "_x").columns == ["a_x_b", "c"]


def test_or_label_and_calendar_of_null(spark):
    row = with_calendar(spark.sql("SELECT CAST(NULL AS DATE) AS d"), "d").withColumn("l", or_label("d", "none")).first()
    assert (row.l, row.year, row.quarter, row.month, row.day) == ("none", None, None, None, None)


def test_line_total_is_exact(spark):
    rows = spark.sql("SELECT CAST(3 AS DECIMAL(12,2)) quantity, CAST(0.10 AS DECIMAL(12,2)) list_price, CAST(0.0725 AS DECIMAL(5,4)) discount")
    assert str(rows.select(line_total().alias("t")).first().t) == "0.27825000"


def test_conform_names_missing_columns(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    with pytest.raises(ValueError, match="orders: .*b"):
        conform(spark.range(1).withColumnRenamed("id", "a"), schema, "orders")
    narrow = spark.range(1).select(F.lit("x").alias("b"), F.col("id").cast("int").alias("a"))
    assert conform(narrow, schema).schema.simpleString() == schema.simpleString()


def test_conform_names_unknown_columns(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    with pytest.raises(ValueError, match="orders: .*not registered: c"):
        conform(spark.range(1).select(F.col("id").alias("a"), F.lit(1).alias("c")), schema, "orders")
