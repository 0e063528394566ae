"""Every operator as a query over the given tables, for checking and timing.

``QUERIES`` maps a name to a function of (session, data folder). Decimals come out as
doubles and dates and times as text, so that any engine's client can compare them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import sinks
from tidemark.functions import fingerprint, instant, strip_suffix, with_calendar, with_suffix
from tidemark.lake import Lake
from tidemark.operators import (
    classify,
    first_versions,
    frequent_values,
    join_as_of,
    latest_per_key,
    long_histories,
    merge_versions,
    newer_than,
    newest_of_runs,
    number_rows,
)
from tidemark.operators.staging import scratch_path, stored
from tidemark.plans import bronze, gold, marts, silver
from tidemark.plans.run import run_lake
from tidemark.plans.together import together
from tidemark.registry import TABLES
from tidemark.retail import Retail
from tidemark.sources import Frames, extract, load_csv
from tidemark.sources import marks as marks_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

MERGED_AT = "1999-06-01 00:00:00"
STOCKED_AT = "1999-01-01 00:00:00"
FIRST_RUN, SECOND_RUN = "1998-01-01 00:00:00", MERGED_AT


def plain(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            value = value.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("bigint")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            value = value.cast("string")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def gaps(df: DataFrame, *columns: str) -> DataFrame:
    """Whole-number columns that may be NULL as doubles, the form clients agree on for them."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def query(build: Callable[[SparkSession, Retail], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(spark, Retail(spark, folder)))

    QUERIES[build.__name__] = run
    return run


def new_lake(spark: SparkSession) -> Lake:
    """An empty lake of its own for one query, on the cluster's scratch folder."""
    lake = Lake(scratch_path(spark, "lake"), f"tidemark_{uuid4().hex[:12]}")
    sinks.create_database(spark, lake.database, lake.path("catalog", lake.database))
    return lake


# --- frames the queries share ---------------------------------------------------------


def _customers(retail: Retail, round_: int) -> DataFrame:
    return silver.clean_customers(retail.customers(round_))


_CUSTOMER_TRACKED = TABLES["customers"].tracked


def _customer_history(retail: Retail, batch_kind: str = "snapshot", **options) -> DataFrame:
    first = first_versions(_customers(retail, 1), "customer_id")
    return merge_versions(
        first, _customers(retail, 2), "customer_id", _CUSTOMER_TRACKED, MERGED_AT, batch_kind, **options
    )


def _products(retail: Retail, round_: int) -> DataFrame:
    return silver.denormalise_products(retail.products(round_), retail.brands(round_), retail.categories(round_))


def _product_history(retail: Retail) -> DataFrame:
    first = first_versions(_products(retail, 1), "product_id")
    return merge_versions(first, _products(retail, 2), "product_id", TABLES["products"].tracked, MERGED_AT)


def _staffs(retail: Retail, round_: int = 1) -> DataFrame:
    return silver.denormalise_staffs(retail.staffs(round_), retail.stores(round_))


def _dimensions(spark: SparkSession, lake: Lake) -> DataFrame:
    """The rows of all four dimensions in one form."""
    shown = [
        spark.table(lake.table("gold", f"dim_{name}")).select(
            F.lit(name).alias("dimension"), F.col(key).alias("key"), F.col(label).cast("string").alias("label"),
            "start_date", "end_date", "current_flag", F.col(f"sk_{key}").alias("sk"),
        )
        for name, key, label in (
            ("customers", "customer_id", "street"), ("products", "product_id", "list_price"), ("staffs", "staff_id", "store_name"),
        )
    ]
    kept = spark.table(lake.table("gold", "dim_stores")).select(
        F.lit("stores").alias("dimension"), F.col("store_id").alias("key"), F.col("store_name").alias("label"),
        *(F.lit(None).cast(t).alias(c) for c, t in
          (("start_date", "timestamp_ntz"), ("end_date", "timestamp_ntz"), ("current_flag", "boolean"), ("sk", "long"))),
    )
    return gaps(reduce(DataFrame.union, [*shown, kept]), "sk")


def _items(retail: Retail) -> DataFrame:
    return silver.refine_order_items(retail.order_items())


def _stocks(retail: Retail) -> DataFrame:
    return silver.refine_stocks(retail.stocks().withColumn("raw_extraction_time", instant(STOCKED_AT)))


def _sources(retail: Retail, round_: int) -> Frames:
    """All source tables with just the registered columns; queries take more from some."""
    return Frames({name: df.select(TABLES[name].schema.names) for name, df in retail.tables(round_).items()})


# --- sources --------------------------------------------------------------------------


@query
def scan_parquet(spark, retail):
    return retail.orders().select("order_id", "customer_id", "order_status", "order_date", "store_id", "staff_id")


@query
def extract_full(spark, retail):
    source = Frames({"customers": retail.customers(1)})
    return extract(spark, source, TABLES["customers"], FIRST_RUN)


@query
def extract_since(spark, retail):
    source = Frames({"customers": retail.customers(2)})
    return extract(spark, source, TABLES["customers"], SECOND_RUN, mark=FIRST_RUN)


@query
def extract_snapshot(spark, retail):
    lake, source = new_lake(spark), Frames({"stocks": retail.stocks()})
    for as_of in (FIRST_RUN, SECOND_RUN):
        bronze.load_table(spark, lake, source, TABLES["stocks"], as_of)
    return spark.table(lake.table("bronze", "stocks")).select("store_id", "product_id", "quantity", "raw_extraction_time")


@query
def extract_incremental(spark, retail):
    lake = new_lake(spark)
    for round_, as_of in ((1, FIRST_RUN), (2, SECOND_RUN)):
        bronze.load_table(spark, lake, Frames({"orders": retail.orders(round_)}), TABLES["orders"], as_of)
    return spark.table(lake.table("bronze", "orders")).select(
        "order_id", "order_date", "store_id", "updated_at", "raw_extraction_time"
    )


@query
def extract_all(spark, retail):
    """All nine tables, whole and then by their changes; rows per table and load."""
    lake = new_lake(spark)
    for round_, as_of in ((1, FIRST_RUN), (2, SECOND_RUN)):
        source = _sources(retail, round_)
        bronze.load_all(spark, lake, {"mysql": source, "postgres": source}, as_of)
    counts = [
        spark.table(lake.table("bronze", name))
        .groupBy("raw_extraction_time")
        .agg(F.lit(name).alias("name"), F.count("*").alias("row_count"), F.max("updated_at").alias("newest"))
        for name in TABLES
    ]
    return reduce(DataFrame.union, counts)


@query
def csv_load(spark, retail):
    table, path = TABLES["customers"], scratch_path(spark, "customers-csv")
    retail.customers().select(table.csv_columns).write.csv(path, header=True, nullValue="NULL", quoteAll=False,
                                                           ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    defaults = {"created_at": instant("2015-01-01 00:00:00"), "updated_at": instant(FIRST_RUN)}
    return load_csv(spark, path, table, defaults)


@query
def high_water_mark(spark, retail):
    items = retail.order_items()
    kind, mark = items.schema["shipped_at"].dataType, marks_of.high_water_mark(items, "shipped_at")
    return spark.range(1).select((F.lit(None) if mark is None else F.lit(str(mark))).cast(kind).alias("mark"))


@query
def incremental_read(spark, retail):
    rows = retail.order_items().select("order_id", "product_id", "quantity", "list_price", "discount", "shipped_at")
    return newer_than(rows, "shipped_at", FIRST_RUN)


# --- sinks ----------------------------------------------------------------------------


@query
def append_table(spark, retail):
    lake = new_lake(spark)
    name, path = lake.table("silver", "orders"), lake.path("silver", "orders")
    orders = retail.orders()
    early = F.coalesce(F.col("order_date") < "1998-01-01", F.lit(False))
    for batch in (orders.where(early), orders.where(~early), orders.where("order_id IS NULL")):
        sinks.append_table(batch, name, path)
    return spark.table(name).select("order_id", "customer_id", "order_date")


@query
def overwrite_table(spark, retail):
    lake = new_lake(spark)
    name, path = lake.table("gold", "orders"), lake.path("gold", "orders")
    sinks.replace_table(retail.orders().select("order_id", "store_id"), name, path)
    doubled = spark.table(name).select("order_id", (F.col("store_id") * 2).alias("store_id"))
    sinks.replace_table(doubled, name, path)
    return spark.table(name)


@query
def partitioned_append(spark, retail):
    lake = new_lake(spark)
    name, path = lake.table("gold", "orders"), lake.path("gold", "orders")
    rows = with_calendar(retail.orders().select("order_id", "order_date"), "order_date")
    sinks.append_partitions(rows, name, path, gold.SALES_PARTITIONS)
    return spark.table(name)


@query
def partition_overwrite(spark, retail):
    """Re-dated orders replace their old rows; months without orders are left as they are."""
    lake = new_lake(spark)
    name, path = lake.table("gold", "orders"), lake.path("gold", "orders")
    before, after = (with_calendar(retail.orders(r).select("order_id", "order_date"), "order_date") for r in (1, 2))
    sinks.append_partitions(before, name, path, gold.SALES_PARTITIONS)
    sinks.overwrite_partitions(after, name, path, gold.SALES_PARTITIONS, sinks.partitions_of(before, gold.SALES_PARTITIONS))
    return spark.table(name)


@query
def ctas_replace(spark, retail):
    lake = new_lake(spark)
    name, path = lake.table("gold", "sales_by_store"), lake.path("gold", "marts/sales_by_store")
    for _ in range(2):
        sinks.replace_table(marts.sales_by_store(_items(retail), retail.orders(), retail.stores()), name, path)
    return spark.table(name)


@query
def empty_batch_guard(spark, retail):
    lake = new_lake(spark)
    name, path = lake.table("silver", "customers"), lake.path("silver", "customers")
    customers = retail.customers().select("customer_id", "city", "state")
    sinks.append_table(customers, name, path)
    written = sinks.append_table(customers.where("customer_id IS NULL"), name, path)
    return spark.table(name).withColumn("second_batch_written", F.lit(written))


# --- columns --------------------------------------------------------------------------


@query
def suffix_rename(spark, retail):
    named = with_suffix(retail.customers().select("customer_id", "city", "state"), "_current")
    return strip_suffix(named.withColumnRenamed("city_current", "town_current_name"), "_current")


@query
def cleanse_customers(spark, retail):
    return _customers(retail, 1)


@query
def fingerprint_plain(spark, retail):
    return _customers(retail, 1).select("customer_id", fingerprint(*_CUSTOMER_TRACKED, separator="").alias("hash_md5"))


@query
def fingerprint_strict(spark, retail):
    return retail.customers().select(
        "customer_id", fingerprint(*_CUSTOMER_TRACKED).alias("hash_md5"), fingerprint().alias("no_columns")
    )


@query
def calendar_columns(spark, retail):
    return with_calendar(retail.orders().select("order_id", "order_date"), "order_date")


# --- keys and history -----------------------------------------------------------------


@query
def surrogate_keys(spark, retail):
    orders = retail.orders().select("order_id", "order_date")
    return number_rows(orders, ["order_date", "order_id"], "sk_order_id", start=100)


@query
def newest_per_key(spark, retail):
    both = retail.orders(1).unionByName(retail.orders(2))
    return latest_per_key(both, ["order_id"], ["updated_at"]).select("order_id", "order_date", "store_id", "updated_at")


@query
def newest_rows_of_log(spark, retail):
    """A log of three runs: all orders, those changed since, and some of these once more."""
    changed = retail.orders(2).where("order_id % 50 = 0")
    runs = [(retail.orders(1), FIRST_RUN), (changed, "1999-01-01 00:00:00"), (changed.where("order_id % 100 = 0"), SECOND_RUN)]
    log = reduce(DataFrame.union, [df.withColumn("run", instant(at)) for df, at in runs])
    return newest_of_runs(log, ["order_id"], "run").select("order_id", "order_date", "store_id", "run")


@query
def scd2_initial(spark, retail):
    return first_versions(_customers(retail, 1), "customer_id").drop("extraction_closed")


@query
def scd2_actions(spark, retail):
    history = first_versions(_customers(retail, 1), "customer_id")
    return classify(history, _customers(retail, 2), "customer_id", _CUSTOMER_TRACKED, separator="")


_HISTORY_COLUMNS = ["customer_id", "street", "start_date", "end_date", "current_flag", "sk_customer_id"]


@query
def scd2_merge(spark, retail):
    return _customer_history(retail).select(_HISTORY_COLUMNS)


@query
def scd2_merge_delta(spark, retail):
    return _customer_history(retail, "delta").select(_HISTORY_COLUMNS)


@query
def scd2_merge_from_creation(spark, retail):
    return _customer_history(retail, version_start="created_at").select(_HISTORY_COLUMNS)


# --- silver ---------------------------------------------------------------------------


@query
def products_denorm(spark, retail):
    return _products(retail, 1)


@query
def products_history(spark, retail):
    return _product_history(retail).select(
        "product_id", "list_price", "start_date", "end_date", "current_flag", "sk_product_id"
    )


@query
def staffs_denorm(spark, retail):
    return _staffs(retail).drop("email", "phone")


@query
def staffs_history(spark, retail):
    """Staff that moved, and those whose store has another name."""
    history = first_versions(_staffs(retail, 1), "staff_id")
    history = merge_versions(history, _staffs(retail, 2), "staff_id", TABLES["staffs"].tracked, MERGED_AT)
    return history.select(
        "staff_id", "first_name", "store_name", "manager_first_name", "start_date", "end_date", "current_flag", "sk_staff_id"
    )


@query
def orders_refine(spark, retail):
    return silver.refine_orders(retail.orders())


@query
def order_items_refine(spark, retail):
    return _items(retail).drop("item_id", "shipped_at")


@query
def stores_refine(spark, retail):
    return silver.refine_stores(retail.outlets()).select("store_id", "store_name", "city", "state")


@query
def stock_snapshots(spark, retail):
    return _stocks(retail)


# --- gold -----------------------------------------------------------------------------


@query
def dim_publish(spark, retail):
    """All four dimensions over two runs, published after each; rows by dimension and key."""
    lake = new_lake(spark)
    stores = retail.stores().withColumn(silver.STAMP, instant(FIRST_RUN)).withColumn("raw_extraction_time", instant(FIRST_RUN))
    stores = silver.refine_stores(stores).withColumn(bronze.DAY, F.col(silver.STAMP).cast("date"))
    sinks.append_table(stores, lake.table("silver", "stores"), lake.path("silver", "stores"), [bronze.DAY], known_rows=True)

    def batches(round_: int) -> dict[str, DataFrame]:
        return {"customers": _customers(retail, round_), "products": _products(retail, round_), "staffs": _staffs(retail, round_)}

    kinds = {"customers": "snapshot", "products": "delta", "staffs": "delta"}
    for round_, at in ((1, FIRST_RUN), (2, MERGED_AT)):
        rows = {name: df.withColumn(silver.STAMP, instant(at)) for name, df in batches(round_).items()}
        together([partial(silver.save_history, spark, lake, name, df, at, kinds[name]) for name, df in rows.items()])
        gold.publish_dimensions(spark, lake)
    return _dimensions(spark, lake)


@query
def pit_join_customers(spark, retail):
    orders = retail.orders().select("order_id", "customer_id", "order_date")
    hot = frequent_values(orders, ["customer_id"])["customer_id"]
    joined = join_as_of(orders, _customer_history(retail), "customer_id", "order_date", ["sk_customer_id", "street"], hot)
    return gaps(joined, "sk_customer_id")


@query
def pit_join_inclusive(spark, retail):
    orders = retail.orders().select("order_id", "customer_id", "order_date")
    joined = join_as_of(
        orders, _customer_history(retail), "customer_id", "order_date", ["sk_customer_id"], inclusive=True
    )
    return gaps(joined, "sk_customer_id")


@query
def pit_join_long_history(spark, retail):
    """Items of three keys whose price has a version for every order date."""
    dates = retail.orders().select((F.col("order_id") % 3).alias("price_id"), F.col("order_date").cast("timestamp_ntz").alias("start_date"))
    following = F.lead("start_date").over(Window.partitionBy("price_id").orderBy("start_date"))
    end = F.coalesce(following, instant("9999-12-31")).alias("end_date")
    prices = dates.distinct().select("*", end, F.dayofyear("start_date").alias("price"))
    items = retail.order_items().select("order_id", (F.col("order_id") % 3).alias("price_id"), "shipped_at")
    hot = frequent_values(items, ["price_id"])["price_id"]
    prices = stored(prices, "prices")
    joined = join_as_of(items, prices, "price_id", "shipped_at", ["price"], hot, long=long_histories(prices, "price_id"))
    return gaps(joined, "price")


def _sales_facts(retail: Retail, items: DataFrame) -> DataFrame:
    orders = retail.orders()
    hot = {
        **frequent_values(items, ["order_id", "product_id"]),
        **frequent_values(orders, ["customer_id", "staff_id"]),
    }
    customers, products, staffs = together(
        [
            lambda: _customer_history(retail),
            lambda: _product_history(retail),
            lambda: first_versions(_staffs(retail), "staff_id"),
        ]
    )
    facts = gold.sales_facts(items, orders, customers, products, staffs, hot)
    return gaps(facts, "sk_customer_id", "sk_staff_id", "sk_product_id")


@query
def fact_sales(spark, retail):
    return _sales_facts(retail, _items(retail))


@query
def fact_sales_hot_keys(spark, retail):
    """One product on a third of the items and none on another third."""
    product = F.expr("CASE order_id % 3 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE product_id END")
    return _sales_facts(retail, _items(retail).withColumn("product_id", product))


@query
def fact_stocks(spark, retail):
    stocks = _stocks(retail)
    hot = frequent_values(stocks, ["product_id"])
    return gaps(gold.stock_facts(stocks, _product_history(retail), retail.stores(), hot), "sk_product_id")


# --- marts ----------------------------------------------------------------------------


@query
def sales_by_category(spark, retail):
    return marts.sales_by_category(_items(retail), _product_history(retail))


@query
def most_sold_products(spark, retail):
    return marts.most_sold_products(_items(retail), _product_history(retail))


@query
def sales_by_store(spark, retail):
    return marts.sales_by_store(_items(retail), retail.orders(), retail.stores())


@query
def sales_by_state(spark, retail):
    return marts.sales_by_state(_items(retail), retail.orders(), _customer_history(retail))


@query
def sales_by_category_all_versions(spark, retail):
    return marts.sales_by_category(_items(retail), _product_history(retail), current_only=False)


# --- the whole lake, two runs with changes between them -------------------------------


def two_runs(spark: SparkSession, retail: Retail) -> Lake:
    lake = new_lake(spark)
    for round_, as_of in ((1, FIRST_RUN), (2, SECOND_RUN)):
        source = _sources(retail, round_)
        run_lake(spark, lake, {"mysql": source, "postgres": source}, as_of)
    return lake


def _slice(kind: str, df: DataFrame, by: list[str]) -> DataFrame:
    """A table summed up by ``by``, in the form all tables share."""
    have = dict(df.dtypes)

    def total(column: str, type_: str):
        value = F.sum(column).cast(type_) if column in have else F.lit(None).cast(type_)
        return value.alias(f"sum_{column}")

    label = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in by]).alias("part")
    return df.groupBy(label).agg(
        F.lit(kind).alias("kind"),
        F.count("*").alias("facts"),
        total("quantity", "double"),
        total("total", "double"),
        total("value_stocked", "double"),
        *[total(c, "double") for c in ("sk_customer_id", "sk_product_id", "sk_staff_id", "store_id")],
    )


@query
def medallion_run(spark, retail):
    """Facts by partition, the marts' rows and the dimensions by state of their flag."""
    lake = two_runs(spark, retail)

    def table(name: str) -> DataFrame:
        return spark.table(lake.table("gold", name))

    slices = [
        _slice("fact_sales", table("fact_sales"), ["year", "quarter", "month"]),
        _slice("fact_stocks", table("fact_stocks"), ["store_name", "year", "month"]),
        _slice("sales_by_state", table("sales_by_state"), ["state"]),
        _slice("sales_by_store", table("sales_by_store"), ["store_name"]),
        _slice("sales_by_category", table("sales_by_category"), ["category_name"]),
        _slice("most_sold_products", table("most_sold_products"), ["product_name"]),
        *[_slice(f"dim_{n}", table(f"dim_{n}"), ["current_flag"]) for n in ("customers", "products", "staffs")],
        _slice("dim_stores", table("dim_stores"), ["store_name"]),
    ]
    return reduce(DataFrame.union, slices)


@query
def medallion_run_snapshots(spark, retail):
    """Four runs, two of them with all customers, some of whom are gone; all dimension rows."""
    lake = new_lake(spark)
    runs = [(1, FIRST_RUN, "delta"), (2, SECOND_RUN, "snapshot"), (2, "1999-06-02 00:00:00", "delta"), (2, "1999-06-03 00:00:00", "snapshot")]
    for round_, as_of, kind in runs:
        source = _sources(retail, round_)
        run_lake(spark, lake, {"mysql": source, "postgres": source}, as_of, {"customers": kind})
    return _dimensions(spark, lake)
