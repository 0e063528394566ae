"""An index of the orders: their keys by month, and the days whose folders hold their rows.

One narrow row per order. A change of a dimension row looks its orders up here, from the
month of the change on, and the rows of a few orders are read from the few days of the logs
that have them, so that no run but the first scans a log as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import with_calendar
from tidemark.lake import Lake
from tidemark.operators import past_mark, right_side, stored
from tidemark.plans.bronze import DAY
from tidemark.plans.progress import newest_log_rows
from tidemark.sinks import overwrite_partitions, partitions_of, replace_rows

SALES_PARTITIONS = ("year", "quarter", "month")


def of_days(log: DataFrame, days: Sequence[date]) -> DataFrame:
    """The rows of a log in the folders of the given days."""
    return log.where(F.col(DAY).isin(list(days)))


def changed_orders(items_log: DataFrame, orders_log: DataFrame, mark: datetime) -> DataFrame:
    """``order_id`` of the orders with rows past ``mark``; older days are not read."""
    found = [past_mark(log, "extraction_bronze", mark, DAY).select("order_id") for log in (items_log, orders_log)]
    return found[0].union(found[1]).distinct()


class OrderIndex:
    """``order_id, customer_id, staff_id, order_date, product_ids, days`` by month of the order."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark = spark
        self.table, self.path = lake.table("gold", "order_index"), lake.path("gold", "order_index")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def rows(self, items_log: DataFrame, orders_log: DataFrame) -> DataFrame:
        """The index of all orders in the logs. What is gathered per order is bounded by it."""
        headers = newest_log_rows(orders_log, ["order_id"]).select("order_id", "customer_id", "staff_id", "order_date")
        days = orders_log.select("order_id", F.lit(None).cast("long").alias("product_id"), DAY).union(
            items_log.select("order_id", "product_id", DAY)
        )
        # rows move as they are, which is less than sets begun on the map side
        held = days.repartition("order_id").groupBy("order_id").agg(
            F.collect_set("product_id").alias("product_ids"), F.collect_set(DAY).alias("days")
        )
        headers = right_side(headers, orders_log.count())
        return with_calendar(held.join(headers, "order_id", "left"), "order_date")

    def rebuild(self, items_log: DataFrame, orders_log: DataFrame) -> None:
        old = partitions_of(self.spark.table(self.table), SALES_PARTITIONS) if self.exists() else []
        overwrite_partitions(self.rows(items_log, orders_log), self.table, self.path, SALES_PARTITIONS, old)

    def replace(self, changed: DataFrame, items_log: DataFrame, orders_log: DataFrame, months: Sequence[tuple]) -> None:
        """Put the rows of the ``changed`` orders, found in ``months``, in order again."""
        rows = stored(self.rows(items_log, orders_log), "index")
        replace_rows(rows, changed, ["order_id"], self.table, self.path, SALES_PARTITIONS, months)

    def days_of(self, changed: DataFrame, mark: datetime) -> list[date]:
        """The days that hold rows of the ``changed`` orders: those past ``mark``, and those
        the index names."""
        held = self.spark.table(self.table).select("order_id", "days").join(changed, "order_id", "left_semi")
        known = {row["day"] for row in held.select(F.explode("days").alias("day")).distinct().collect()}
        logs = [self.table.rsplit(".", 1)[0] + f".silver_{name}" for name in ("order_items", "orders")]
        listed = {
            date.fromisoformat(row["partition"].split("=", 1)[1])
            for log in logs for row in self.spark.sql(f"SHOW PARTITIONS {log}").collect()
        }
        return sorted(known | {day for day in listed if day >= mark.date()})

    def sold(self, changes: DataFrame, key: str) -> DataFrame:
        """``order_id`` of the orders that have a changed key from its change on."""
        first = changes.agg(F.min("_changed_from")).first()[0]
        index = self.spark.table(self.table)
        if first is None:
            return index.select("order_id").limit(0)
        month = F.col("year") * 12 + F.col("month") >= first.year * 12 + first.month
        index = index.where((F.col("year") >= first.year) & month)
        if key == "product_id":
            index = index.withColumn(key, F.explode("product_ids"))
        late = F.col("order_date").cast("timestamp_ntz") >= F.col("_changed_from")
        return index.join(changes, (F.col(key) == F.col("_changed_key")) & late, "left_semi").select("order_id")
