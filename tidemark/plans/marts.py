"""Summary tables over silver."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import instant
from tidemark.lake import Lake
from tidemark.operators import right_side, stored
from tidemark.plans.bronze import DAY
from tidemark.plans.orders import OrderIndex, changed_orders, of_days
from tidemark.plans.progress import Silver, is_current, mark_of, newest_log_rows, set_mark
from tidemark.plans.together import together
from tidemark.sinks import replace_table
from tidemark.sources import high_water_mark

# Every mart first adds the items up by the key it is about to join on. Those sums
# combine on the map side, so a key holding much of the table is one row per map task
# when it reaches a shuffle, and the joins see one row per key.


def _by(items: DataFrame, key: str) -> DataFrame:
    return items.groupBy(key).agg(F.sum("total").alias("total"))


def _ranked(sums: DataFrame, name: str) -> DataFrame:
    total = F.ceil(F.sum("total")).cast("bigint").alias("total")
    return sums.groupBy(name).agg(total).orderBy(F.desc_nulls_last("total"), F.asc_nulls_last(name))


def _versions(dimension: DataFrame, current_only: bool) -> DataFrame:
    return dimension.where("current_flag") if current_only else dimension


def sales_by_category(items: DataFrame, products: DataFrame, current_only: bool = True) -> DataFrame:
    """Sales per category. ``current_only=False`` counts a sale once per product version."""
    names = _versions(products, current_only).select("product_id", "category_name")
    return _ranked(_by(items, "product_id").join(names, "product_id", "left"), "category_name")


def most_sold_products(items: DataFrame, products: DataFrame, current_only: bool = True, top: int = 10) -> DataFrame:
    names = _versions(products, current_only).select("product_id", "product_name")
    return _ranked(_by(items, "product_id").join(names, "product_id", "left"), "product_name").limit(top)


def _order_totals(items: DataFrame, orders: DataFrame, key: str) -> DataFrame:
    """Sales per ``key`` of the order header."""
    headers = orders.select("order_id", key)
    return _by(_by(items, "order_id").join(headers, "order_id", "left"), key)


def _by_store(sums: DataFrame, stores: DataFrame) -> DataFrame:
    return _ranked(sums.join(stores.select("store_id", "store_name"), "store_id", "left"), "store_name")


def _by_state(sums: DataFrame, customers: DataFrame, current_only: bool) -> DataFrame:
    states = _versions(customers, current_only).select("customer_id", "state")
    return _ranked(sums.join(states, "customer_id", "left"), "state")


def sales_by_store(items: DataFrame, orders: DataFrame, stores: DataFrame) -> DataFrame:
    return _by_store(_order_totals(items, orders, "store_id"), stores)


def sales_by_state(items: DataFrame, orders: DataFrame, customers: DataFrame, current_only: bool = True) -> DataFrame:
    return _by_state(_order_totals(items, orders, "customer_id"), customers, current_only)


# --- sums kept from run to run --------------------------------------------------------

#: What the marts add up by: columns of the items, and of the order headers.
SUMS = ("product_id", "store_id", "customer_id")
_REACHED = "reached"


def _lines(items_log: DataFrame, orders_log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The present items, ``total`` and number of ``lines``: per order, with the keys of its
    header, and one by one, with their product.

    An order's items combine on the map side and meet the header where they are added up, so
    only a row per order moves for the header's keys.
    """
    items = newest_log_rows(items_log, ["order_id", "item_id"])
    orders = newest_log_rows(orders_log, ["order_id"]).select("order_id", "store_id", "customer_id")
    orders = right_side(orders, orders_log.count())
    sums = items.groupBy("order_id").agg(F.sum("total").alias("total"), F.count("*").alias("lines"))
    return sums.join(orders, "order_id", "left").drop("order_id"), items.select("product_id", "total", F.lit(1).alias("lines"))


class Sums:
    """Sales and number of items per value of each of ``SUMS``, in one table each.

    A run takes away what the orders changed since the last one came to, and adds what they
    come to now. How far a table has come is a column of it, so that content and mark change
    in one step; sums that disagree on it are made anew.
    """

    def __init__(self, spark: SparkSession, lake: Lake, silver: Silver):
        self.spark, self.lake, self.silver = spark, lake, silver
        self.tables = {key: lake.table("gold", f"sums_by_{key}") for key in SUMS}

    def __getitem__(self, key: str) -> DataFrame:
        return self.spark.table(self.tables[key]).select(key, "total")

    def mark(self) -> datetime | None:
        """How far all the sums have come; None if they have to be made anew."""
        if not all(self.spark.catalog.tableExists(t) for t in self.tables.values()):
            return None
        marks = {high_water_mark(self.spark.table(t), _REACHED) for t in self.tables.values()}
        return marks.pop() if len(marks) == 1 else None

    def logs(self) -> tuple[DataFrame, DataFrame]:
        stamps = ["raw_extraction_time", "extraction_bronze", DAY]
        return (
            self.silver["order_items"].select("order_id", "item_id", "product_id", "total", *stamps),
            self.silver["orders"].select("order_id", "store_id", "customer_id", *stamps),
        )

    def bring_up_to(self, reached: datetime) -> None:
        mark, index = self.mark(), OrderIndex(self.spark, self.lake)
        items, orders = self.logs()
        sales = mark_of(self.spark, self.lake.table("gold", "fact_sales"))
        if mark is None or not index.exists() or sales is None or sales < mark:
            # the index knows no orders after the last sales
            per_order, per_item = _lines(items, orders)
            per_order = stored(per_order, "order-sums")
            self._save({key: self._added(per_item if key == "product_id" else per_order, key) for key in SUMS}, reached)
            return
        changed = right_side(stored(changed_orders(items, orders, mark), "changed-orders"))
        days = index.days_of(changed, mark)
        items = stored(of_days(items, days).join(changed, "order_id", "left_semi"), "changed-items")
        orders = stored(of_days(orders, days).join(changed, "order_id", "left_semi"), "changed-headers")
        seen = F.col("extraction_bronze") <= instant(mark)

        def change(now: DataFrame, then: DataFrame) -> DataFrame:
            then = then.withColumns({"total": -F.col("total"), "lines": -F.col("lines")})
            return stored(now.unionByName(then), "changed-sums")

        per_order, per_item = map(change, _lines(items, orders), _lines(items.where(seen), orders.where(seen)))
        changes = {key: per_item if key == "product_id" else per_order for key in SUMS}
        columns = ["total", "lines"]
        self._save(
            {
                key: self._added(self.spark.table(self.tables[key]).select(key, *columns).union(changes[key].select(key, *columns)), key)
                for key in SUMS
            },
            reached,
        )

    @staticmethod
    def _added(lines: DataFrame, key: str) -> DataFrame:
        total = F.sum("total").cast("decimal(38,6)").alias("total")
        return lines.groupBy(key).agg(total, F.sum("lines").alias("lines")).where("lines > 0")

    def _save(self, sums: dict[str, DataFrame], reached: datetime) -> None:
        def save(key: str) -> None:
            rows = sums[key].withColumn(_REACHED, instant(reached))
            replace_table(rows, self.tables[key], self.lake.path("gold", f"sums/{key}"))

        together([partial(save, key) for key in SUMS])


MARTS = ("sales_by_category", "most_sold_products", "sales_by_store", "sales_by_state")


def build_marts(spark: SparkSession, lake: Lake) -> None:
    """Recreate the four marts from sums over the present silver rows, if any have changed."""
    silver = Silver(spark, lake)
    if not silver.has("order_items", "orders", "products", "customers", "stores"):
        return
    reached = silver.newest_stamp(["order_items", "orders", "stores"], ["products", "customers"])
    if all(is_current(spark, lake.table("gold", name), reached) for name in MARTS):
        return
    sums = Sums(spark, lake, silver)
    sums.bring_up_to(reached)
    products, customers = right_side(silver["products"]), right_side(silver["customers"])
    rows = {
        "sales_by_category": sales_by_category(sums["product_id"], products),
        "most_sold_products": most_sold_products(sums["product_id"], products),
        "sales_by_store": _by_store(sums["store_id"], newest_log_rows(silver["stores"], ["store_id"])),
        "sales_by_state": _by_state(sums["customer_id"], customers, True),
    }

    def build(name: str) -> None:
        table = lake.table("gold", name)
        replace_table(rows[name], table, lake.path("gold", f"marts/{name}"))
        set_mark(spark, table, reached)

    together([partial(build, name) for name in MARTS])
