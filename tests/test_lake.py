"""Several runs of the whole lake over small sources that change in between."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans import bronze, gold, marts, run, silver
from tidemark.registry import TABLES
from tidemark.sources import Frames

OLD = datetime(2015, 1, 1)


def at(text):
    return datetime.fromisoformat(text)


class Shop:
    """Source tables as dictionaries of rows by key."""

    def __init__(self):
        self.rows = {name: {} for name in TABLES}
        self.put("brands", brand_id=1, brand_name="Acme")
        self.put("categories", category_id=1, category_name="Bikes")
        for p in (1, 2, 3):
            self.put("products", product_id=p, product_name=f"P{p}", brand_id=1, category_id=1 if p < 3 else 9,
                     model_year=2016, list_price=10.0 * p)
        for s in (1, 2):
            self.put("stores", store_id=s, store_name=f"Store {s}", state="CA")
        self.put("staffs", staff_id=1, first_name="Ann", last_name="Lee", active=1, store_id=1, manager_id=None)
        self.put("staffs", staff_id=2, first_name="Bo", last_name="Roe", active=1, store_id=2, manager_id=1)
        for c in (1, 2, 3):
            self.put("customers", customer_id=c, first_name=" ann ", last_name="LEE", email=None if c == 1 else f"C{c}@X",
                     phone=None, street=f"Main {c}", city="X", state="CA" if c < 3 else "NY", zip_code="1")
        for o, (c, day) in {1: (1, "2016-01-05"), 2: (2, "2016-02-05"), 3: (3, "2016-02-06"), 4: (1, "2016-03-01")}.items():
            self.order(o, c, day)
            self.item(o, 1, 1, 2)
            self.item(o, 2, 2, 1)
        self.item(50, 1, 3, 4)  # its header comes later
        for s in (1, 2):
            for p in (1, 2):
                self.put("stocks", store_id=s, product_id=p, quantity=5.0 * s)

    def put(self, table, created_at=OLD, updated_at=OLD, **values):
        key = tuple(values[k] for k in TABLES[table].key)
        row = {name: None for name in TABLES[table].schema.names}
        row.update(self.rows[table].get(key, {}))
        row.update(values, updated_at=updated_at)
        row["created_at"] = row.get("created_at") or created_at
        self.rows[table][key] = row

    def order(self, key, customer, day, store=1, staff=1, **stamps):
        self.put("orders", order_id=key, customer_id=customer, order_status=4, order_date=date.fromisoformat(day),
                 store_id=store, staff_id=staff, **stamps)

    def item(self, order, item, product, quantity, **stamps):
        self.put("order_items", order_id=order, item_id=item, product_id=product, quantity=float(quantity),
                 list_price=10.0, discount=None if item == 1 else 0.1, **stamps)

    def frames(self, spark):
        made = {}
        for name, table in TABLES.items():
            ddl = ", ".join(
                f"{f.name} {'double' if f.dataType.typeName() == 'decimal' else f.dataType.simpleString()}" for f in table.schema
            )
            rows = [tuple(r[c] for c in table.schema.names) for r in self.rows[name].values()]
            made[name] = spark.createDataFrame(rows, ddl)
        return Frames(made)


def go(spark, lake, shop, as_of, **options):
    source = shop.frames(spark)
    run.run_lake(spark, lake, {"mysql": source, "postgres": source}, as_of, **options)


def content(spark, name, drop=("extraction_silver",)):
    df = spark.table(name).drop(*drop)
    return Counter(tuple(row[c] for c in sorted(df.columns)) for row in df.collect())


GOLD = ["fact_sales", "fact_stocks", "dim_customers", "dim_products", "dim_staffs", "dim_stores",
        "sales_by_category", "most_sold_products", "sales_by_store", "sales_by_state"]


def rebuilt_sales(spark, lake):
    def silver(name):
        return spark.table(lake.table("silver", name))

    facts = gold.sales_facts(
        gold.newest_log_rows(silver("order_items"), ["order_id", "item_id"]),
        gold.newest_log_rows(silver("orders"), ["order_id"]),
        silver("customers"), silver("products"), silver("staffs"),
    )
    return Counter(tuple(row[c] for c in sorted(facts.columns)) for row in facts.collect())


def rebuilt_stocks(spark, lake):
    def silver(name):
        return spark.table(lake.table("silver", name))

    facts = gold.stock_facts(silver("stocks"), silver("products"), gold.newest_log_rows(silver("stores"), ["store_id"]))
    return Counter(tuple(row[c] for c in sorted(facts.columns)) for row in facts.collect())


def change_everything(shop):
    then = {"updated_at": at("2016-02-15")}
    shop.put("customers", customer_id=1, street="Oak 1", **then)  # before order 4, long known
    shop.put("customers", customer_id=2, phone="555", **then)  # not tracked
    shop.put("customers", customer_id=9, first_name="z", last_name="z", email="z", street="z", city="z", state="WA",
             zip_code="9", created_at=at("2016-02-15"), **then)
    shop.put("products", product_id=2, list_price=25.0, **then)
    shop.put("stores", store_id=2, store_name="Store Two", **then)  # also staff 2's store
    shop.order(1, 1, "2016-06-01", **then)  # the only order of January
    shop.order(50, 9, "2016-04-01", **then)
    shop.item(2, 1, 1, 7, **then)
    shop.order(60, 3, "2016-07-01", staff=2, **then)
    shop.item(60, 1, 2, 1, **then)


def test_runs_with_changes(spark, lake):
    shop = Shop()
    go(spark, lake, shop, "2016-02-10 00:00:00")
    sales = lake.table("gold", "fact_sales")
    assert content(spark, sales) == rebuilt_sales(spark, lake)
    assert spark.table(sales).count() == 9
    orphan = spark.table(sales).where("order_id = 50").first()
    assert orphan.year is None and orphan.sk_customer_id is None
    customer = spark.table(lake.table("gold", "dim_customers")).where("customer_id = 1").first()
    assert (customer.first_name, customer.last_name, customer.email, customer.phone) == ("Ann", "Lee", "unknown", "unknown")
    assert spark.table(lake.table("gold", "dim_products")).where("product_id = 3").first().category_name is None

    # Nothing changed but the stocks, of which each run takes a snapshot. Other tables
    # are not even written.
    kept = [lake.table("gold", n) for n in GOLD if n != "fact_stocks"] + [
        lake.table("silver", n) for n in ("customers", "products", "staffs")
    ]
    files = {n: set(spark.table(n).inputFiles()) for n in kept}
    before = {n: content(spark, lake.table("gold", n)) for n in GOLD}
    go(spark, lake, shop, "2016-02-11 00:00:00")
    after = {n: content(spark, lake.table("gold", n)) for n in GOLD}
    assert {n for n in GOLD if before[n] != after[n]} == {"fact_stocks"}
    assert {n: set(spark.table(n).inputFiles()) for n in kept} == files
    assert sum(after["fact_stocks"].values()) == 2 * sum(before["fact_stocks"].values())

    change_everything(shop)
    go(spark, lake, shop, "2016-08-01 00:00:00")
    assert content(spark, sales) == rebuilt_sales(spark, lake)
    assert spark.table(sales).count() == 10
    assert spark.table(sales).where("month = 1").isEmpty() and spark.table(sales).where("year IS NULL").isEmpty()
    moved = spark.table(sales).where("order_id = 4").select("sk_customer_id").distinct().collect()
    dim = spark.table(lake.table("gold", "dim_customers"))
    assert moved[0][0] == dim.where("customer_id = 1 AND current_flag").first().sk_customer_id
    assert dim.where("customer_id = 2").count() == 1
    staffs = spark.table(lake.table("gold", "dim_staffs"))
    assert [r.store_name for r in staffs.where("staff_id = 2").orderBy("start_date").collect()] == ["Store 2", "Store Two"]

    stocks = lake.table("gold", "fact_stocks")
    assert content(spark, stocks) == rebuilt_stocks(spark, lake)
    assert spark.table(stocks).where("store_name = 'Store 2'").isEmpty()
    assert spark.table(stocks).count() == 12

    by_state = {r.state: r.total for r in spark.table(lake.table("gold", "sales_by_state")).collect()}
    assert by_state == {"CA": 29 + 79 + 29, "NY": 29 + 10, "WA": 40}

    # The same instant again, as after a broken run.
    before = {n: content(spark, lake.table("gold", n)) for n in GOLD}
    go(spark, lake, shop, "2016-08-01 00:00:00")
    assert {n: content(spark, lake.table("gold", n)) for n in GOLD if n != "fact_stocks"} == {
        n: before[n] for n in GOLD if n != "fact_stocks"
    }
    assert content(spark, stocks) == before["fact_stocks"]


def test_load_that_breaks_before_its_mark_is_repeated(spark, lake, monkeypatch):
    shop = Shop()

    def broken(*args):
        raise RuntimeError("lost the driver")

    keep = gold.set_mark
    for as_of in ("2016-02-10 00:00:00", "2016-08-01 00:00:00"):
        source = shop.frames(spark)
        bronze.load_all(spark, lake, {"mysql": source, "postgres": source}, as_of)
        silver.refine_all(spark, lake, as_of)
        monkeypatch.setattr(gold, "set_mark", broken)
        for load in (gold.load_sales, gold.load_stocks):
            with pytest.raises(RuntimeError):
                load(spark, lake, as_of)
        monkeypatch.setattr(gold, "set_mark", keep)
        gold.load_sales(spark, lake, as_of)
        gold.load_stocks(spark, lake, as_of)
        assert content(spark, lake.table("gold", "fact_sales")) == rebuilt_sales(spark, lake)
        assert content(spark, lake.table("gold", "fact_stocks")) == rebuilt_stocks(spark, lake)
        change_everything(shop)


def test_snapshot_loads_close_missing_keys(spark, lake):
    shop, kinds = Shop(), {"customers": "snapshot"}
    go(spark, lake, shop, "2016-02-10 00:00:00", batch_kinds=kinds)
    del shop.rows["customers"][(3,)]
    go(spark, lake, shop, "2016-02-20 00:00:00", batch_kinds=kinds)
    gone = spark.table(lake.table("silver", "customers")).where("customer_id = 3").first()
    assert gone.end_date == at("2016-02-20") and not gone.current_flag
    states = {r.state for r in spark.table(lake.table("gold", "sales_by_state")).collect()}
    assert states == {"CA", None}


def test_two_snapshots_between_refinements_keep_to_the_last(spark, lake):
    shop, kinds = Shop(), {"customers": "snapshot"}
    go(spark, lake, shop, "2016-02-10 00:00:00", batch_kinds=kinds)
    for as_of, drop in (("2016-02-11 00:00:00", None), ("2016-02-12 00:00:00", (2,))):
        shop.rows["customers"].pop(drop, None)
        source = shop.frames(spark)
        bronze.load_all(spark, lake, {"mysql": source, "postgres": source}, as_of, ["customers"])
    silver.refine_all(spark, lake, "2016-02-12 00:00:00", kinds)
    closed = spark.table(lake.table("silver", "customers")).where("NOT current_flag").collect()
    assert [r.customer_id for r in closed] == [2]


def refine(spark, lake, shop, as_of, kinds=None):
    source = shop.frames(spark)
    whole = [name for name, kind in (kinds or {}).items() if kind == "snapshot"]
    bronze.load_all(spark, lake, {"mysql": source, "postgres": source}, as_of, whole)
    silver.refine_all(spark, lake, as_of, kinds)


def versions(spark, lake, name, key):
    rows = spark.table(lake.table("silver", name)).select(key, "start_date", "end_date", "current_flag").collect()
    return sorted(tuple(row) for row in rows)


def test_delta_runs_after_a_snapshot_leave_deleted_keys_closed(spark, lake):
    shop = Shop()
    whole = {"customers": "snapshot", "products": "snapshot", "staffs": "snapshot"}
    refine(spark, lake, shop, "2016-02-10 00:00:00")
    then = {"updated_at": at("2016-02-15")}
    shop.put("customers", customer_id=3, phone="555", **then)  # not tracked: no new version
    refine(spark, lake, shop, "2016-02-16 00:00:00")
    for name, key in (("customers", 3), ("products", 3), ("staffs", 2)):
        del shop.rows[name][(key,)]
    refine(spark, lake, shop, "2016-02-20 00:00:00", whole)
    keys = {"customers": ("customer_id", 3), "products": ("product_id", 3), "staffs": ("staff_id", 2)}
    closed = {n: versions(spark, lake, n, k) for n, (k, _) in keys.items()}
    for name, (_, gone) in keys.items():
        assert [v[2:] for v in closed[name] if v[0] == gone] == [(at("2016-02-20"), False)]
        assert all(v[3] for v in closed[name] if v[0] != gone)
    for as_of in ("2016-02-21 00:00:00", "2016-02-22 00:00:00"):
        refine(spark, lake, shop, as_of)
        assert {n: versions(spark, lake, n, k) for n, (k, _) in keys.items()} == closed
    # back in the source: open again, from its new change on
    shop.put("customers", customer_id=3, first_name="ann", last_name="lee", state="NY", updated_at=at("2016-02-23"))
    refine(spark, lake, shop, "2016-02-24 00:00:00")
    again = [v for v in versions(spark, lake, "customers", "customer_id") if v[0] == 3]
    assert [v[1] for v in again if v[3]] == [at("2016-02-23")] and len(again) == 2


def test_snapshot_without_rows_closes_every_key(spark, lake):
    shop = Shop()
    refine(spark, lake, shop, "2016-02-10 00:00:00")
    shop.rows["staffs"].clear()
    refine(spark, lake, shop, "2016-02-20 00:00:00", {"staffs": "snapshot"})
    refine(spark, lake, shop, "2016-02-21 00:00:00")
    assert [v[2:] for v in versions(spark, lake, "staffs", "staff_id")] == [(at("2016-02-20"), False)] * 2


@pytest.mark.parametrize("names", [(None, "Store One"), ("Store 1", None)])
def test_store_named_or_unnamed_moves_its_stock_rows(spark, lake, names):
    shop = Shop()
    shop.put("stores", store_id=1, store_name=names[0])
    refine(spark, lake, shop, "2016-02-10 00:00:00")
    gold.load_stocks(spark, lake, "2016-02-10 00:00:00")
    shop.put("stores", store_id=1, store_name=names[1], updated_at=at("2016-02-15"))
    refine(spark, lake, shop, "2016-02-20 00:00:00")
    gold.load_stocks(spark, lake, "2016-02-20 00:00:00")
    assert content(spark, lake.table("gold", "fact_stocks")) == rebuilt_stocks(spark, lake)


def test_marts_count_every_version_on_request(spark):
    items = spark.createDataFrame([(1, 1, 5.0)], "order_id long, product_id long, total double")
    products = spark.createDataFrame(
        [(1, "p", "c", True), (1, "p", "c", False)], "product_id long, product_name string, category_name string, current_flag boolean"
    )
    assert marts.sales_by_category(items, products).first().total == 5
    assert marts.sales_by_category(items, products, current_only=False).first().total == 10
    assert [r.product_name for r in marts.most_sold_products(items, products, top=1).collect()] == ["p"]


def test_top_products_break_ties_by_name(spark):
    items = spark.createDataFrame([(1, p, 5.0) for p in range(15)], "order_id long, product_id long, total double")
    products = spark.range(15).select(
        F.col("id").alias("product_id"), F.concat(F.lit("p"), F.lpad(F.col("id").cast("string"), 2, "0")).alias("product_name"),
        F.lit("c").alias("category_name"), F.lit(True).alias("current_flag"),
    )
    top = [r.product_name for r in marts.most_sold_products(items, products).collect()]
    assert top == [f"p{i:02d}" for i in range(10)]
