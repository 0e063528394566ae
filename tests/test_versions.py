"""Histories in parts, their publication, and the index of orders: which files are touched."""

import os
from datetime import date, datetime

import pytest

from test_lake import Shop, at, change_everything, content, go, rebuilt_sales, refine
from tidemark.functions import instant
from tidemark.plans import gold, marts, silver
from tidemark.plans.orders import OrderIndex, of_days
from tidemark.sinks import replace_table



def batch(spark, *rows):
    stamped = [(*row, datetime(2020, 1, 1), datetime.fromisoformat(changed)) for *row, changed in rows]
    return spark.createDataFrame(stamped, "customer_id long, street string, created_at timestamp_ntz, updated_at timestamp_ntz").selectExpr(
        "customer_id", "'e' email", "street", "'c' city", "'s' state", "'z' zip_code", "created_at", "updated_at"
    )


def files(store):
    return {
        f"{folder}/{name}": os.stat(f"{folder}/{name}").st_mtime_ns
        for folder, _, names in os.walk(store.path) for name in names if name.endswith(".parquet")
    }


def versions(store):
    rows = store.spark.table(store.view).select("customer_id", "street", "current_flag", "sk_customer_id").collect()
    return sorted(tuple(row) for row in rows)


def test_a_merge_leaves_closed_files_alone(spark, lake):
    store = lake.history(spark, "silver", "customers")
    silver.save_history(spark, lake, "customers", batch(spark, (1, "a", "2020-01-01"), (2, "b", "2020-01-01")), "2020-01-02")
    silver.save_history(spark, lake, "customers", batch(spark, (1, "c", "2020-02-01")), "2020-02-02")
    before = {f: t for f, t in files(store).items() if "closed-" in f}
    assert len(before) == 1
    silver.save_history(spark, lake, "customers", batch(spark, (2, "d", "2020-03-01")), "2020-03-02")
    after = files(store)
    assert {f: after[f] for f in before} == before and sum("closed-" in f for f in after) == 2
    wanted = [(1, "a", False, 1), (1, "c", True, 3), (2, "b", False, 2), (2, "d", True, 4)]
    assert versions(store) == wanted and store.highest == 4 and store.run == at("2020-03-02")
    # the same batch again changes nothing, not a file
    silver.save_history(spark, lake, "customers", batch(spark, (2, "d", "2020-03-01")), "2020-03-02")
    assert files(store) == after and versions(store) == wanted
    # nor does a snapshot without news
    same = batch(spark, (1, "c", "2020-02-01"), (2, "d", "2020-03-01"))
    silver.save_history(spark, lake, "customers", same, "2020-03-03", "snapshot")
    assert files(store) == after
    # more news in a run of the same instant
    silver.save_history(spark, lake, "customers", batch(spark, (1, "f", "2020-03-01")), "2020-03-02")
    assert [v for v in versions(store) if v[0] == 1] == [(1, "a", False, 1), (1, "c", False, 3), (1, "f", True, 5)]
    assert store.since(at("2020-02-15")).count() == 4 and store.since(at("2020-01-15")).count() == 5


def test_an_attempt_that_breaks_is_in_no_view(spark, lake, monkeypatch):
    store = lake.history(spark, "silver", "customers")
    silver.save_history(spark, lake, "customers", batch(spark, (1, "a", "2020-01-01")), "2020-01-02")
    keep = spark.sql

    def broken(text, *args, **options):
        if text.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("lost the driver")
        return keep(text, *args, **options)

    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **o: broken(text, *a, **o))
    with pytest.raises(RuntimeError):
        silver.save_history(spark, lake, "customers", batch(spark, (1, "b", "2020-02-01")), "2020-02-02")
    monkeypatch.undo()
    assert versions(store) == [(1, "a", True, 1)]
    # a later run, with other news
    silver.save_history(spark, lake, "customers", batch(spark, (1, "c", "2020-02-15")), "2020-02-20")
    assert versions(store) == [(1, "a", False, 1), (1, "c", True, 2)]
    assert not any("20200202" in f for f in files(store))


def test_publication_copies_new_folders_only(spark, lake):
    history, dimension = (lake.history(spark, layer, "customers") for layer in ("silver", "gold"))
    for street, day in (("a", "2020-01-01"), ("b", "2020-02-01"), ("c", "2020-03-01")):
        silver.save_history(spark, lake, "customers", batch(spark, (1, street, day), (2, "same", "2020-01-01")), day)
        kept = {f: t for f, t in files(dimension).items() if "closed-" in f}
        gold.publish_dimensions(spark, lake)
        after = files(dimension)
        assert {f: after[f] for f in kept} == kept
        assert versions(dimension) == versions(history)
    before = files(dimension)
    gold.publish_dimensions(spark, lake)
    assert files(dimension) == before


def rebuilt_marts(spark, lake):
    def table(name):
        return spark.table(lake.table("silver", name))

    items = marts.newest_log_rows(table("order_items"), ["order_id", "item_id"])
    orders = marts.newest_log_rows(table("orders"), ["order_id"])
    stores = marts.newest_log_rows(table("stores"), ["store_id"])
    rebuilt = {
        "sales_by_category": marts.sales_by_category(items, table("products")),
        "most_sold_products": marts.most_sold_products(items, table("products")),
        "sales_by_store": marts.sales_by_store(items, orders, stores),
        "sales_by_state": marts.sales_by_state(items, orders, table("customers")),
    }
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in rebuilt.items()}


def kept_marts(spark, lake):
    return {n: sorted(map(tuple, spark.table(lake.table("gold", n)).collect()), key=str) for n in marts.MARTS}


def test_sums_follow_changed_orders_and_read_no_others(spark, lake, monkeypatch):
    shop = Shop()
    go(spark, lake, shop, "2016-02-10 00:00:00")
    assert kept_marts(spark, lake) == rebuilt_marts(spark, lake)
    change_everything(shop)
    shop.order(2, 3, "2016-02-05", store=2, updated_at=at("2016-02-15"))  # another customer and store
    read = []
    keep = marts._lines
    monkeypatch.setattr(marts, "_lines", lambda items, orders: read.append(items) or keep(items, orders))
    refine(spark, lake, shop, "2016-08-01 00:00:00")
    sums = marts.Sums(spark, lake, marts.Silver(spark, lake))
    assert sums.mark() == at("2016-02-10")
    marts.build_marts(spark, lake)
    assert {r.order_id for df in read for r in df.collect()} == {1, 2, 50, 60}
    assert kept_marts(spark, lake) == rebuilt_marts(spark, lake)
    assert sums.mark() == at("2016-08-01")
    # one table of sums fell behind: all are made anew
    spark.table(sums.tables["store_id"]).withColumn("reached", instant("2016-07-01")).write.parquet(f"{lake.root}/behind")
    replace_table(spark.read.parquet(f"{lake.root}/behind"), sums.tables["store_id"], lake.path("gold", "sums/store_id"))
    shop.item(60, 2, 2, 5, updated_at=at("2016-08-02"))
    refine(spark, lake, shop, "2016-08-03 00:00:00")
    marts.build_marts(spark, lake)
    assert kept_marts(spark, lake) == rebuilt_marts(spark, lake)


def test_a_run_reads_the_days_of_changed_orders_only(spark, lake):
    shop = Shop()
    for n in (10, 12, 15):
        shop.order(n, 1, f"2016-02-{n}", created_at=at(f"2016-02-{n}"), updated_at=at(f"2016-02-{n}"))
        shop.item(n, 1, 1, 1, created_at=at(f"2016-02-{n}"), updated_at=at(f"2016-02-{n}"))
        go(spark, lake, shop, f"2016-02-{n} 12:00:00")
    index = OrderIndex(spark, lake)
    mark = at("2016-02-15 12:00:00")
    changed = spark.createDataFrame([(12,)], "order_id long")
    assert index.days_of(changed, mark) == [date(2016, 2, 12), date(2016, 2, 15)]
    log = of_days(spark.table(lake.table("silver", "order_items")), index.days_of(changed, mark))
    assert {r.order_id for r in log.select("order_id").collect()} == {12, 15}
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    # without a change of a dimension the index isn't asked for keys
    silver_tables = gold.Silver(spark, lake)
    plan = gold._changed_orders(silver_tables, index, mark)._jdf.queryExecution().optimizedPlan().toString()
    assert "order_index" not in plan
    shop.put("customers", customer_id=1, street="Oak 1", updated_at=at("2016-02-13"))
    shop.put("products", product_id=1, list_price=11.0, updated_at=at("2016-02-14"))
    refine(spark, lake, shop, "2016-02-16 00:00:00")
    found = gold._changed_orders(silver_tables, index, mark).orderBy("order_id").collect()
    assert [r.order_id for r in found] == [4, 15]
    gold.load_sales(spark, lake, "2016-02-16 00:00:00")
    assert content(spark, lake.table("gold", "fact_sales")) == rebuilt_sales(spark, lake)
    rows = spark.table(index.table).where("order_id IN (4, 50)").orderBy("order_id").collect()
    assert [(r.order_id, sorted(r.product_ids), r.customer_id) for r in rows] == [(4, [1, 2], 1), (50, [3], None)]
    assert spark.table(index.table).count() == spark.table(index.table).select("order_id").distinct().count() == 8
