from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import instant
from tidemark.plans import bronze
from tidemark.registry import TABLES
from tidemark.sources import CsvFolder, Frames, JdbcDatabase, changed_since, extract, high_water_mark, layer_mark

AS_OF = "2020-01-10 00:00:00"


def brands(spark, *rows):
    return spark.createDataFrame(
        [(i, n, datetime.fromisoformat(c), datetime.fromisoformat(u)) for i, n, c, u in rows],
        "brand_id long, brand_name string, created_at timestamp_ntz, updated_at timestamp_ntz",
    )


def test_csv_header_null_token_and_defaults(spark, tmp_path):
    (tmp_path / "staffs.csv").write_text(
        "staff_id,first_name,last_name,email,phone,active,store_id,manager_id\n"
        '1,Ann,"Lee, Jr.",a@x,NULL,1,1,NULL\n2,Bo,Roe,b@x,5,1,1,1\n'
    )
    rows = {r.staff_id: r for r in CsvFolder(str(tmp_path), AS_OF).read(spark, TABLES["staffs"]).collect()}
    assert (rows[1].last_name, rows[1].phone, rows[1].manager_id) == ("Lee, Jr.", None, None)
    assert (rows[2].manager_id, rows[2].phone) == (1, "5")
    assert rows[1].created_at == datetime(2015, 1, 1) and rows[1].updated_at == datetime(2020, 1, 10)


def test_csv_without_a_null_token(spark, tmp_path):
    (tmp_path / "brands.csv").write_text("brand_id,brand_name\n1,NULL\n")
    assert CsvFolder(str(tmp_path), AS_OF, null_token=None).read(spark, TABLES["brands"]).first().brand_name == "NULL"


def test_csv_stock_rows_count_as_created_when_loaded(spark, tmp_path):
    (tmp_path / "stocks.csv").write_text("store_id,product_id,quantity\n1,1,5\n")
    assert CsvFolder(str(tmp_path), AS_OF).read(spark, TABLES["stocks"]).first().created_at == datetime(2020, 1, 10)


def test_malformed_csv_stops_the_load(spark, tmp_path):
    (tmp_path / "brands.csv").write_text("brand_id,brand_name\nx,y\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
        CsvFolder(str(tmp_path), AS_OF).read(spark, TABLES["brands"]).collect()


def test_change_filter_is_strict_and_looks_at_both_dates(spark):
    source = brands(
        spark,
        (1, "old", "2019-01-01", "2019-01-01"),
        (2, "tie", "2019-01-01", "2020-01-01"),
        (3, "updated", "2019-01-01", "2020-01-02"),
        (4, "created", "2020-01-02", "2019-01-01"),
    )
    got = extract(spark, Frames({"brands": source}), TABLES["brands"], AS_OF, mark="2020-01-01 00:00:00")
    assert {r.brand_id for r in got.collect()} == {3, 4}
    assert {r.raw_extraction_time for r in got.collect()} == {datetime(2020, 1, 10)}


def test_change_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "brands")
    brands(spark, (1, "a", "2019-01-01", "2019-01-01")).write.parquet(path)
    source = Frames({"brands": spark.read.parquet(path)})
    plan = extract(spark, source, TABLES["brands"], AS_OF, mark="2020-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThan(created_at" in plan


def test_jdbc_options_split_the_read_by_key():
    database = JdbcDatabase("jdbc:postgresql://db/shop", "reader", "secret", "org.postgresql.Driver", connections=6)
    options = database.table_options(TABLES["orders"], (1, 900))
    assert options["partitionColumn"] == "order_id" and options["numPartitions"] == "6"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "901")
    assert "partitionColumn" not in database.table_options(TABLES["orders"], (None, None))
    assert database.bounds_options(TABLES["orders"])["query"] == "SELECT min(order_id) AS low, max(order_id) AS high FROM orders"
    assert "secret" not in repr(database)


def test_marks(spark, lake):
    name = lake.table("bronze", "brands")
    assert layer_mark(spark, name, "raw_extraction_time") is None
    source = brands(spark, (1, "a", "2019-01-01", "2019-01-01"))
    for at in ("2020-01-01 05:00:00", "2020-01-02 05:00:00", "2020-01-02 06:00:00"):
        assert bronze.load_table(spark, lake, Frames({"brands": source}), TABLES["brands"], at, snapshot=True)
    assert layer_mark(spark, name, "raw_extraction_time") == datetime(2020, 1, 2, 6)
    assert layer_mark(spark, name, "raw_extraction_time", "extraction_day") == datetime(2020, 1, 2, 6)
    assert high_water_mark(spark.table(name).limit(0), "raw_extraction_time") is None


def test_incremental_load_takes_changes_once(spark, lake):
    name = lake.table("bronze", "brands")

    def load(as_of, *rows):
        return bronze.load_table(spark, lake, Frames({"brands": brands(spark, *rows)}), TABLES["brands"], as_of)

    first = (1, "a", "2019-01-01", "2019-01-01")
    assert load("2020-01-01 00:00:00", first)
    assert not load("2020-01-02 00:00:00", first)
    assert load("2020-01-03 00:00:00", first, (2, "b", "2020-01-02", "2020-01-02"))
    assert sorted(r.brand_id for r in spark.table(name).collect()) == [1, 2]


def test_runs_cannot_go_back_in_time(spark, lake):
    source = Frames({"brands": brands(spark, (1, "a", "2019-01-01", "2019-01-01"))})
    bronze.load_table(spark, lake, source, TABLES["brands"], "2020-01-02 00:00:00")
    with pytest.raises(ValueError, match="loaded as of"):
        bronze.load_table(spark, lake, source, TABLES["brands"], "2020-01-01 00:00:00", snapshot=True)


def test_days_already_read_are_pruned(spark, lake):
    from tidemark.operators import past_mark

    source = brands(spark, (1, "a", "2019-01-01", "2019-01-01"))
    for at in ("2020-01-01 05:00:00", "2020-01-02 05:00:00"):
        bronze.load_table(spark, lake, Frames({"brands": source}), TABLES["brands"], at, snapshot=True)
    rows = past_mark(spark.table(lake.table("bronze", "brands")), "raw_extraction_time", "2020-01-01 07:00:00", "extraction_day")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extraction_day" in plan and "GreaterThan(raw_extraction_time" in plan
    assert rows.count() == 1


def test_changed_since_is_a_column(spark):
    df = brands(spark, (1, "a", "2019-01-01", "2019-01-01"))
    assert df.where(changed_since("2018-12-31")).count() == 1
    assert df.withColumn("x", instant("2018-12-31")).where(F.col("created_at") > F.col("x")).count() == 1
