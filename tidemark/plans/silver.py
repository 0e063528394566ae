"""Silver: cleansed and denormalised tables, three of them with version history."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import instant, line_total, or_label, proper_name
from tidemark.lake import Lake
from tidemark.operators import (
    first_versions,
    latest_of_few_repeats,
    merge_open,
    past_mark,
    right_side,
    stored,
)
from tidemark.plans.bronze import DAY, whole_load_mark
from tidemark.plans.bronze import STAMP as RAW_STAMP
from tidemark.plans.together import together
from tidemark.registry import TABLES
from tidemark.sinks import append_table
from tidemark.sources import latest_of, layer_mark, record_mark, recorded_mark

STAMP = "extraction_bronze"
_SEEN = "tidemark.seen"
_AUDIT = ("created_at", "updated_at")


# --- refinements: frame in, frame out -------------------------------------------------


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.fillna("unknown", subset=["email", "phone"]).withColumns(
        {
            "first_name": proper_name("first_name"),
            "last_name": proper_name("last_name"),
            "email": F.lower("email"),
        }
    )


def _stamps(df: DataFrame) -> list[str]:
    return [c for c in (*_AUDIT, RAW_STAMP, STAMP) if c in df.columns]


def _lookup(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, take: Mapping[str, str]) -> DataFrame:
    """Left join of ``take`` (column: new name) from a table with one row per key.

    Spark broadcasts a small lookup by its size and splits hot keys of a large one.
    """
    picked = lookup.select(F.col(lookup_key).alias("_lookup_key"), *[F.col(c).alias(n) for c, n in take.items()])
    return df.join(picked, F.col(key) == F.col("_lookup_key"), "left").drop("_lookup_key")


def denormalise_products(products: DataFrame, brands: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with the names of their brand and category in place of the ids."""
    named = _lookup(products, brands, "brand_id", "brand_id", {"brand_name": "brand_name"})
    named = _lookup(named, categories, "category_id", "category_id", {"category_name": "category_name"})
    return named.select(
        "product_id", "product_name", "model_year", "list_price", "brand_name", "category_name", *_stamps(products)
    )


def denormalise_staffs(staffs: DataFrame, stores: DataFrame) -> DataFrame:
    """Staffs with their store's and manager's names.

    A renamed store or manager changes the staff row as well, so its ``updated_at`` is
    the newest of the three.
    """
    managers = {"first_name": "manager_first_name", "last_name": "manager_last_name", "updated_at": "_manager_at"}
    named = _lookup(staffs, right_side(staffs), "manager_id", "staff_id", managers)
    named = _lookup(named, stores, "store_id", "store_id", {"store_name": "store_name", "updated_at": "_store_at"})
    return (
        named.withColumn("updated_at", F.greatest("updated_at", "_manager_at", "_store_at"))
        .withColumn("manager_label", or_label("manager_id", "without manager"))
        .select(
            "staff_id", "first_name", "last_name", "email", "phone", "active", "store_name",
            "manager_first_name", "manager_last_name", "manager_label", *_stamps(staffs),
        )
    )


def refine_orders(orders: DataFrame) -> DataFrame:
    """``shipped_date`` stays a date; ``shipped_label`` spells its absence out."""
    return orders.drop(*_AUDIT).withColumn("shipped_label", or_label("shipped_date", "not shipped"))


def refine_order_items(items: DataFrame) -> DataFrame:
    filled = F.coalesce("discount", F.lit(0).cast(items.schema["discount"].dataType))
    return items.drop(*_AUDIT).withColumn("discount", filled).withColumn("total", line_total())


def refine_stores(stores: DataFrame) -> DataFrame:
    return stores.drop(*_AUDIT)


def refine_stocks(stocks: DataFrame) -> DataFrame:
    return stocks.drop(*_AUDIT).withColumnRenamed(RAW_STAMP, "snapshot_time")


# --- jobs: bronze tables in, silver tables out ----------------------------------------


class _Bronze:
    """The bronze tables as a run at ``as_of`` sees them.

    The present state of a table is the newest row per key from its last whole load on;
    keys that only older rows have are gone from the source.
    """

    def __init__(self, spark: SparkSession, lake: Lake, as_of: str | datetime):
        self.spark, self.lake, self.as_of = spark, lake, as_of

    def log_batch(self, name: str, mark_column: str = RAW_STAMP) -> DataFrame | None:
        """Rows the silver log has not seen, newest per key; None if there are none."""
        return self._newest(name, layer_mark(self.spark, self.lake.table("silver", name), mark_column, DAY))

    def changes(self, name: str) -> DataFrame | None:
        """Rows the silver history has not seen, newest per key; None if there are none.

        Rows from before the last whole load do not count.
        """
        seen = recorded_mark(self.spark, self.lake.history(self.spark, "silver", name).table, _SEEN)
        return self._newest(name, seen, whole_load_mark(self.spark, self.lake.table("bronze", name)))

    def reached(self, name: str) -> datetime | None:
        """The newest load of the table, with or without rows."""
        raw = self.lake.table("bronze", name)
        return latest_of(layer_mark(self.spark, raw, RAW_STAMP, DAY), whole_load_mark(self.spark, raw))

    def whole(self, name: str, if_empty: bool = False) -> DataFrame | None:
        """The present state of the table; None if it has no rows, unless ``if_empty``."""
        return self._newest(name, None, whole_load_mark(self.spark, self.lake.table("bronze", name)), if_empty)

    def lookup(self, name: str) -> DataFrame:
        """:meth:`whole`, or no rows."""
        rows = self.whole(name)
        return rows if rows is not None else self.spark.createDataFrame([], TABLES[name].schema)

    def _newest(
        self, name: str, mark: datetime | None, first: datetime | None = None, if_empty: bool = False
    ) -> DataFrame | None:
        """The newest rows per key past ``mark`` and not before ``first``."""
        raw = self.lake.table("bronze", name)
        if not self.spark.catalog.tableExists(raw):
            return None
        rows = past_mark(self.spark.table(raw), RAW_STAMP, mark, DAY)
        if first is not None:
            rows = rows.where((F.col(RAW_STAMP) >= instant(first)) & (F.col(DAY) >= instant(first).cast("date")))
        rows = rows.drop(DAY)
        if not if_empty and rows.isEmpty():
            return None
        table = TABLES[name]
        # Every snapshot of a snapshot table counts, not just the last one.
        key = [*table.key, RAW_STAMP] if table.snapshot else list(table.key)
        order = [c for c in ("updated_at", RAW_STAMP) if c not in key]
        return latest_of_few_repeats(rows, key, order).withColumn(STAMP, instant(self.as_of))


def save_history(
    spark: SparkSession, lake: Lake, name: str, rows: DataFrame, as_of: str | datetime, batch_kind: str = "delta"
) -> None:
    store, (key,) = lake.history(spark, "silver", name), TABLES[name].key
    if not store.exists():
        opened = first_versions(rows, key)
        store.replace_open(opened, as_of, opened.count())
        return
    merged = merge_open(
        store.open(), store.closed(), rows, key, TABLES[name].tracked, as_of, batch_kind, highest=store.highest
    )
    if merged is not None:
        store.replace_open(merged.versions, as_of, merged.highest)


def refine_all(
    spark: SparkSession, lake: Lake, as_of: str | datetime, batch_kinds: Mapping[str, str] | None = None
) -> None:
    """Bring every silver table up to date with bronze.

    ``batch_kinds`` may call a history table's batch a ``"snapshot"``, if bronze was
    loaded with the whole table, so that missing keys close.
    """
    kinds = {name: "delta" for name in ("customers", "products", "staffs")} | dict(batch_kinds or {})
    bronze = _Bronze(spark, lake, as_of)

    def history(name: str, save: Callable[[DataFrame], None], every_row: bool = False) -> None:
        store, reached = lake.history(spark, "silver", name), bronze.reached(name)
        # A snapshot without rows closes all keys, if there are any.
        closing = kinds[name] == "snapshot" and store.exists()
        whole = every_row or kinds[name] == "snapshot"
        batch = bronze.whole(name, if_empty=closing) if whole else bronze.changes(name)
        if batch is not None:
            save(batch)
        # Batches without news move the mark too: their rows are never read again.
        if store.exists() and recorded_mark(spark, store.table, _SEEN) != reached:
            record_mark(spark, store.table, _SEEN, reached)

    def customers() -> None:
        def save(batch: DataFrame) -> None:
            save_history(spark, lake, "customers", clean_customers(batch), as_of, kinds["customers"])

        history("customers", save)

    def products() -> None:
        def save(batch: DataFrame) -> None:
            named = denormalise_products(batch, bronze.lookup("brands"), bronze.lookup("categories"))
            save_history(spark, lake, "products", named, as_of, kinds["products"])

        history("products", save)

    def staffs() -> None:
        def save(batch: DataFrame) -> None:
            named = denormalise_staffs(stored(batch, "staffs"), bronze.lookup("stores"))
            save_history(spark, lake, "staffs", named, as_of, kinds["staffs"])

        # A renamed store or manager versions staffs that did not change themselves, so
        # the batch is every present staff; unchanged ones fall out in the merge.
        history("staffs", save, every_row=True)

    def log(name: str, refine: Callable[[DataFrame], DataFrame], mark_column: str = RAW_STAMP) -> None:
        batch = bronze.log_batch(name, mark_column)
        if batch is not None:
            rows = refine(batch).withColumn(DAY, F.col(STAMP).cast("date"))
            append_table(rows, lake.table("silver", name), lake.path("silver", name), [DAY], known_rows=True)

    together(
        [
            customers,
            products,
            staffs,
            lambda: log("orders", refine_orders),
            lambda: log("order_items", refine_order_items),
            lambda: log("stores", refine_stores),
            lambda: log("stocks", refine_stocks, "snapshot_time"),
        ]
    )
