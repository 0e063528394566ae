"""Gold: dimensions and the two fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import instant, line_total, with_calendar
from tidemark.lake import Lake
from tidemark.operators import frequent_values, join_as_of, latest_per_key, past_mark, right_side, spread_left_join, stored
from tidemark.operators.skew import Shares
from tidemark.plans.bronze import DAY
from tidemark.plans.orders import SALES_PARTITIONS, OrderIndex, changed_orders, of_days
from tidemark.plans.progress import Silver, is_current, mark_of, newest_log_rows, set_mark
from tidemark.plans.silver import STAMP as SILVER_STAMP
from tidemark.plans.together import together
from tidemark.sinks import overwrite_partitions, partitions_of, replace_rows, replace_table

STAMP = "extraction_silver"
STOCK_PARTITIONS = ("store_name", "year", "month")

Hot = Mapping[str, Shares]


# --- fact frames ----------------------------------------------------------------------


def sales_facts(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    staffs: DataFrame,
    hot: Hot | None = None,
    inclusive: bool = False,
    most_headers: int = 0,
) -> DataFrame:
    """One row per order item, with the dimension versions valid on the order date.

    Customer and staff hang on the order, so they are joined to the order headers, which
    are few and narrow; the items then move once by order and once by product.
    ``most_headers``, if known, is what the headers number at most.
    """
    hot = hot or {}
    headers = orders.select("order_id", "customer_id", "staff_id", "store_id", "order_date")
    headers = join_as_of(
        headers, customers, "customer_id", "order_date", ["sk_customer_id"], hot.get("customer_id"), inclusive
    )
    headers = join_as_of(headers, staffs, "staff_id", "order_date", ["sk_staff_id"], hot.get("staff_id"), inclusive)
    headers = headers.select(
        F.col("order_id").alias("_order_id"), "sk_customer_id", "store_id", "sk_staff_id", "order_date"
    )
    lines = items.select("order_id", "product_id", "quantity", "list_price", "discount")
    lines = spread_left_join(lines, right_side(headers, most_headers), "order_id", "_order_id", hot.get("order_id"))
    lines = join_as_of(
        lines, products, "product_id", "order_date", ["sk_product_id"], hot.get("product_id"), inclusive
    )
    lines = lines.select(
        "order_id", "sk_customer_id", "store_id", "sk_staff_id", "order_date", "sk_product_id",
        "quantity", "list_price", "discount", line_total().alias("total"),
    )
    return with_calendar(lines, "order_date")


def stock_facts(
    stocks: DataFrame, products: DataFrame, stores: DataFrame, hot: Hot | None = None, inclusive: bool = False
) -> DataFrame:
    """One row per stock snapshot row, valued at the price of its time."""
    hot = hot or {}
    rows = stocks.select("store_id", "product_id", "quantity", "snapshot_time")
    rows = join_as_of(
        rows, products, "product_id", "snapshot_time", ["sk_product_id", "list_price"], hot.get("product_id"), inclusive
    )
    names = stores.select(F.col("store_id").alias("_store_id"), "store_name")
    rows = rows.join(names, F.col("store_id") == F.col("_store_id"), "left").drop("_store_id")
    rows = rows.select(
        "store_id", "sk_product_id", "store_name", "quantity", "list_price",
        _value_stocked().alias("value_stocked"), "snapshot_time",
    )
    return with_calendar(rows, "snapshot_time", quarter=False)


def _value_stocked() -> Column:
    return F.col("quantity") * F.col("list_price")


def _sales_derived() -> dict[str, Column]:
    return {"total": line_total(), "day": F.dayofmonth("order_date")}


def _stock_derived() -> dict[str, Column]:
    return {"value_stocked": _value_stocked(), "day": F.dayofmonth("snapshot_time")}


def changed_keys(history: DataFrame, key: str, mark: datetime) -> DataFrame:
    """Keys whose versions changed after ``mark``, and from which instant on."""
    opened = F.when(F.col(SILVER_STAMP) > instant(mark), F.col("start_date"))
    ended = F.when(F.col("extraction_closed") > instant(mark), F.col("end_date"))
    since = F.least(opened, ended)
    changes = history.where(since.isNotNull()).groupBy(F.col(key).alias("_changed_key")).agg(F.min(since).alias("_changed_from"))
    # Written out, so that a join to it shuffles both sides and adaptive execution can
    # split a key that is frequent in the facts.
    return right_side(stored(changes, "changed-keys"))


# --- jobs -----------------------------------------------------------------------------


def publish_dimensions(spark: SparkSession, lake: Lake) -> None:
    """Copy the dimensions that changed to gold.

    A history's versions are distinct by construction. Of a history only the open part and
    the folders of runs that gold has not seen are copied.
    """
    silver = Silver(spark, lake)

    def publish(name: str) -> None:
        if not silver.has(name):
            return
        history, dimension = silver.history(name), lake.history(spark, "gold", name)
        if dimension.run != history.run or dimension.parts() != history.parts():
            dimension.take_over(history)

    def publish_stores() -> None:
        if not silver.has("stores"):
            return
        table, reached = lake.table("gold", "dim_stores"), silver.newest_stamp(["stores"], [])
        if not is_current(spark, table, reached):
            replace_table(newest_log_rows(silver["stores"], ["store_id"]), table, lake.path("gold", "dim_stores"))
            set_mark(spark, table, reached)

    together([*(partial(publish, name) for name in ("products", "customers", "staffs")), publish_stores])


def load_sales(spark: SparkSession, lake: Lake, as_of: str | datetime) -> None:
    """Bring ``fact_sales`` up to date; running it again changes nothing.

    Only orders touched since the last load are recomputed: those with a new header, a
    new item, or a date past a change of one of their dimension rows. Their old rows
    are replaced in the months they are in; no other month is rewritten.
    """
    silver = Silver(spark, lake)
    table, path = lake.table("gold", "fact_sales"), lake.path("gold", "fact_sales")
    if not silver.has("order_items", "orders", "customers", "products", "staffs"):
        return
    reached = silver.newest_stamp(["order_items", "orders"], ["customers", "products", "staffs"])
    if is_current(spark, table, reached):
        return
    mark, index = mark_of(spark, table), OrderIndex(spark, lake)
    if not index.exists():
        mark = None
    items_log, orders_log = silver["order_items"], silver["orders"]
    if mark is not None:
        changed = right_side(stored(_changed_orders(silver, index, mark), "changed-orders"))
        days, stamps = index.days_of(changed, mark), [SILVER_STAMP, DAY]
        # what the facts and the index take; nothing else has to move
        items_log = items_log.select("order_id", "item_id", "product_id", "quantity", "list_price", "discount", *stamps)
        orders_log = orders_log.select("order_id", "customer_id", "staff_id", "store_id", "order_date", *stamps)
        items_log = stored(of_days(items_log, days).join(changed, "order_id", "left_semi"), "changed-items")
        orders_log = stored(of_days(orders_log, days).join(changed, "order_id", "left_semi"), "changed-headers")
    hot = {
        **frequent_values(items_log, ["order_id", "product_id"]),
        **frequent_values(orders_log, ["customer_id", "staff_id"]),
    }
    facts = sales_facts(
        newest_log_rows(items_log, ["order_id", "item_id"]), newest_log_rows(orders_log, ["order_id"]),
        *(right_side(silver[name]) for name in ("customers", "products", "staffs")), hot, most_headers=orders_log.count(),
    ).withColumn(STAMP, instant(as_of))
    if mark is None:
        # A table without a mark is the remains of a first load that broke off.
        present = _all_partitions(spark, table, SALES_PARTITIONS)
        overwrite_partitions(facts, table, path, SALES_PARTITIONS, present, _sales_derived())
        index.rebuild(items_log, orders_log)
    else:
        # Every header an order ever had tells a month its rows may lie in; without a
        # header they lie in the month NULL.
        dated = with_calendar(orders_log.select("order_date"), "order_date")
        months = sorted({*partitions_of(dated, SALES_PARTITIONS), (None,) * len(SALES_PARTITIONS)}, key=str)
        fresh = stored(facts, "sales")
        replace_rows(fresh, changed, ["order_id"], table, path, SALES_PARTITIONS, months, derived=_sales_derived())
        index.replace(changed, items_log, orders_log, months)
    set_mark(spark, table, reached)


def _all_partitions(spark: SparkSession, table: str, partition_by: Sequence[str]) -> list[tuple]:
    """The folders a table has rows in."""
    return partitions_of(spark.table(table), partition_by) if spark.catalog.tableExists(table) else []


def _changed_orders(silver: Silver, index: OrderIndex, mark: datetime) -> DataFrame:
    """Orders with rows past ``mark``, and those whose dimension rows changed.

    Of the logs only the days past the mark are read; the index tells the other orders, and
    is not read either unless a dimension has changed.
    """
    found = [changed_orders(silver["order_items"], silver["orders"], mark)]
    for name, key in (("customers", "customer_id"), ("staffs", "staff_id"), ("products", "product_id")):
        if (silver.history(name).run or mark) > mark:
            found.append(index.sold(changed_keys(silver.history(name).since(mark), key, mark), key))
    return reduce(DataFrame.union, found).distinct()


def load_stocks(spark: SparkSession, lake: Lake, as_of: str | datetime) -> None:
    """Bring ``fact_stocks`` up to date; running it again changes nothing.

    New snapshots are added. Where a product version or a store name changed for earlier
    snapshots, those stores' rows of those snapshots are replaced.
    """
    silver = Silver(spark, lake)
    table, path = lake.table("gold", "fact_stocks"), lake.path("gold", "fact_stocks")
    if not silver.has("stocks", "products", "stores"):
        return
    reached = silver.newest_stamp(["stocks", "stores"], ["products"])
    if is_current(spark, table, reached):
        return
    mark = mark_of(spark, table)
    log, key = silver["stocks"], ["store_id", "snapshot_time"]
    if mark is not None:
        changed = right_side(stored(_changed_snapshots(silver, mark), "changed-snapshots"))
        log = stored(log.join(changed, key, "left_semi"), "changed-stocks")
    hot = frequent_values(log, ["product_id"])
    rows = log.select(*key, "product_id", "quantity", SILVER_STAMP)
    # A run has a key once at most, so only snapshots that came by several runs can repeat one.
    several = F.countDistinct(SILVER_STAMP) > 1
    if not log.groupBy("snapshot_time").agg(several.alias("several")).where("several").isEmpty():
        rows = latest_per_key(rows, [*key, "product_id"], [SILVER_STAMP])
    stores = newest_log_rows(silver["stores"], ["store_id"])
    facts = stock_facts(rows, right_side(silver["products"]), stores, hot).withColumn(STAMP, instant(as_of))
    if mark is None:
        present = _all_partitions(spark, table, STOCK_PARTITIONS)
        overwrite_partitions(facts, table, path, STOCK_PARTITIONS, present, _stock_derived())
    else:
        months = partitions_of(with_calendar(changed, "snapshot_time", quarter=False), ["year", "month"])
        if months:
            replace_rows(
                stored(facts, "stock-facts"), changed, key, table, path, STOCK_PARTITIONS, months, by=["year", "month"],
                derived=_stock_derived(),
            )
    set_mark(spark, table, reached)


def _changed_snapshots(silver: Silver, mark: datetime) -> DataFrame:
    """Store and snapshot of stock rows that are new or whose fact would differ now."""
    stocks, key = silver["stocks"], ["store_id", "snapshot_time"]
    new = past_mark(stocks, SILVER_STAMP, mark, DAY).select(key)
    changes = changed_keys(silver.history("products").since(mark), "product_id", mark)
    first = changes.agg(F.min("_changed_from")).first()[0]
    late = F.col("snapshot_time") >= F.col("_changed_from")
    # Rows past the mark are new anyhow, and earlier snapshots keep their prices.
    held = stocks.where((F.col(SILVER_STAMP) <= instant(mark)) & (F.col(DAY) <= instant(mark).cast("date")))
    held = held.where(F.lit(False) if first is None else F.col("snapshot_time") >= instant(first))
    repriced = held.join(changes, (F.col("product_id") == F.col("_changed_key")) & late, "left_semi")
    seen = silver["stores"].groupBy(F.col("store_id").alias("_store_id")).agg(
        F.max(SILVER_STAMP).alias("last"),
        F.min(SILVER_STAMP).alias("first"),
        # structs, as a minimum of plain names would pass over NULL
        (F.min(F.struct("store_name")) == F.max(F.struct("store_name"))).alias("one_name"),
    )
    renamed = seen.where((F.col("last") > instant(mark)) & (~F.col("one_name") | (F.col("first") > instant(mark))))
    renamed = stored(renamed.select("_store_id"), "renamed")
    moved = stocks.join(renamed, F.col("store_id") == F.col("_store_id"), "left_semi")
    return new.union(repriced.select(key)).union(moved.select(key)).distinct()
