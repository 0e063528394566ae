"""The nine source tables derived from a TPC-H shaped data set.

Two states of the sources: round 1, and round 2 after a day of changes dated
``CHANGED_AT`` (moved and new customers, dearer products, re-dated orders, corrected
items, staff of other stores, renamed stores, brands and categories). Customers with
``id % 10 = 1`` are gone in round 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import instant
from tidemark.registry import TABLES

FIRST_AT = "1990-01-01 00:00:00"
CHANGED_AT = "1998-06-01 00:00:00"


class Retail:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def tables(self, round_: int) -> dict[str, DataFrame]:
        return {name: getattr(self, name)(round_) for name in TABLES}

    def brands(self, round_: int = 1) -> DataFrame:
        """In round 2 brands whose name starts with Brand#1 have another one."""
        rows = self.raw("part").select(_brand_id().alias("brand_id"), F.col("p_brand").alias("brand_name")).distinct()
        return self._renamed(rows, "brand_name", F.startswith("brand_name", F.lit("Brand#1")), round_)

    def categories(self, round_: int = 1) -> DataFrame:
        """In round 2 categories whose name starts with S have another one."""
        types = self.raw("part").select("p_type").distinct()
        rows = types.select(_category_id().alias("category_id"), F.col("p_type").alias("category_name"))
        return self._renamed(rows, "category_name", F.startswith("category_name", F.lit("S")), round_)

    def products(self, round_: int = 1) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(12,2)")
        changed = F.col("p_partkey") % 4 == 0
        if round_ == 2:
            price = F.when(changed, price + 10).otherwise(price)
        rows = self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            _brand_id().alias("brand_id"),
            _category_id().alias("category_id"),
            (2010 + F.col("p_size") % 10).alias("model_year"),
            price.cast("decimal(12,2)").alias("list_price"),
        )
        return self._dated(rows, (F.col("product_id") % 4 == 0) if round_ == 2 else None)

    def customers(self, round_: int = 1) -> DataFrame:
        key = F.col("c_custkey")
        nation = self.raw("nation").select(F.col("n_nationkey"), F.col("n_name"))
        rows = self.raw("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            key.alias("customer_id"),
            F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("first_name"),
            F.concat(F.lit(" "), F.upper("c_name")).alias("last_name"),
            F.when(key % 5 != 0, F.concat(F.lit("555-"), key.cast("string"))).alias("phone"),
            F.when(key % 7 != 0, F.concat(F.upper("c_name"), F.lit("@Mail.EXAMPLE"))).alias("email"),
            F.concat(F.lit("Street "), (key % 100).cast("string")).alias("street"),
            F.col("n_name").alias("city"),
            F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state"),
            (10000 + key).cast("string").alias("zip_code"),
        )
        if round_ == 1:
            return self._dated(rows)
        known = F.col("customer_id")
        moved = rows.where(known % 10 != 1).withColumn(
            "street", F.when(known % 10 == 0, F.concat("street", F.lit(" moved"))).otherwise(F.col("street"))
        )
        joined = rows.where(known % 20 == 2).withColumn("customer_id", known + 1_000_000)
        stamp = instant(CHANGED_AT)
        return self._dated(moved, known % 10 == 0).union(joined.select("*", stamp.alias("created_at"), stamp.alias("updated_at")))

    def stores(self, round_: int = 1) -> DataFrame:
        """In round 2 stores with ``id % 5 = 0`` have another name."""
        region = self.raw("region")
        rows = self.raw("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            F.col("n_nationkey").cast("long").alias("store_id"),
            F.concat(F.lit("Store "), F.col("n_name")).alias("store_name"),
            *[F.lit(None).cast("string").alias(c) for c in ("phone", "email", "street", "city")],
            F.col("r_name").alias("state"),
            F.lit(None).cast("string").alias("zip_code"),
        )
        return self._renamed(rows, "store_name", F.col("store_id") % 5 == 0, round_)

    def outlets(self) -> DataFrame:
        """Stores as above, one per supplier, so that they grow with the data."""
        nation, region = self.raw("nation"), self.raw("region")
        places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        rows = self.raw("supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("s_suppkey").alias("store_id"),
            F.concat(F.lit("Outlet "), F.col("s_name")).alias("store_name"),
            *[F.lit(None).cast("string").alias(c) for c in ("phone", "email", "street")],
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lit(None).cast("string").alias("zip_code"),
        )
        return self._dated(rows)

    def staffs(self, round_: int = 1) -> DataFrame:
        """In round 2 staff with ``id % 10 = 5`` are in the next store."""
        key = F.col("s_suppkey")
        store, moved = F.col("s_nationkey").cast("long"), key % 10 == 5
        if round_ == 2:
            store = F.when(moved, (store + 1) % 25).otherwise(store)
        rows = self.raw("supplier").select(
            key.alias("staff_id"),
            F.lower("s_name").alias("first_name"),
            F.concat(F.lit("L"), key.cast("string")).alias("last_name"),
            F.lit(None).cast("string").alias("email"),
            F.lit(None).cast("string").alias("phone"),
            F.lit(1).alias("active"),
            store.alias("store_id"),
            F.when(key % 10 != 0, key - key % 10).alias("manager_id"),
        )
        return self._dated(rows, (F.col("staff_id") % 10 == 5) if round_ == 2 else None)

    def orders(self, round_: int = 1) -> DataFrame:
        """In round 2 orders with ``id % 50 = 0`` are 40 days later and in the next store."""
        key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
        store = key % 25
        changed = key % 50 == 0
        if round_ == 2:
            date = F.when(changed, F.date_add(date, 40)).otherwise(date)
            store = F.when(changed, (key + 1) % 25).otherwise(store)
        rows = self.raw("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).alias("order_status"),
            date.alias("order_date"),
            F.date_add(date, 7).alias("required_date"),
            F.when(F.col("o_orderstatus") != "P", date).alias("shipped_date"),
            store.alias("store_id"),
            (key % 10).alias("staff_id"),
        )
        return self._dated(rows, (F.col("order_id") % 50 == 0) if round_ == 2 else None)

    def order_items(self, round_: int = 1) -> DataFrame:
        """In round 2 items of orders with ``id % 30 = 0`` count one piece more."""
        raw = self.raw("lineitem")
        quantity = F.col("l_quantity").cast("decimal(12,2)")
        changed = F.col("l_orderkey") % 30 == 0
        if round_ == 2:
            quantity = F.when(changed, quantity + 1).otherwise(quantity)
        rows = raw.select(
            F.col("l_orderkey").alias("order_id"),
            # Line numbers repeat within an order here; whole rows do not.
            F.xxhash64(*raw.columns).alias("item_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.cast("decimal(12,2)").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("list_price"),
            F.when(F.col("l_linenumber") % 6 != 0, F.col("l_discount").cast("decimal(5,4)")).alias("discount"),
            F.col("l_shipdate").alias("shipped_at"),
        )
        return self._dated(rows, (F.col("order_id") % 30 == 0) if round_ == 2 else None)

    def stocks(self, round_: int = 1) -> DataFrame:
        supplier = self.raw("supplier").select("s_suppkey", "s_nationkey")
        # A supplier seldom delivers a product twice, so lines are added up per store only.
        rows = (
            self.raw("lineitem").select("l_suppkey", "l_partkey", F.col("l_quantity").cast("decimal(12,2)").alias("pieces"))
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .groupBy(F.col("s_nationkey").cast("long").alias("store_id"), F.col("l_partkey").alias("product_id"))
            .agg(F.sum("pieces").cast("decimal(12,2)").alias("quantity"))
        )
        return self._dated(rows)

    def _renamed(self, rows: DataFrame, name: str, changed: Column, round_: int) -> DataFrame:
        if round_ == 1:
            return self._dated(rows)
        dated = self._dated(rows, changed)
        return dated.withColumn(name, F.when(changed, F.concat(name, F.lit(" new"))).otherwise(F.col(name)))

    @staticmethod
    def _dated(rows: DataFrame, changed: Column | None = None) -> DataFrame:
        first = instant(FIRST_AT)
        updated = first if changed is None else F.when(changed, instant(CHANGED_AT)).otherwise(first)
        return rows.select("*", first.alias("created_at"), updated.alias("updated_at"))


def _brand_id() -> Column:
    return F.regexp_replace("p_brand", "Brand#", "").cast("long")


def _category_id() -> Column:
    return F.crc32(F.col("p_type").cast("binary"))
