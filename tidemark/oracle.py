"""The answers of :mod:`tidemark.catalogue` in plain SQL over the given tables.

``VIEWS`` are named building blocks; an answer gets those it refers to as CTEs.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}
ANSWERS: dict[str, str] = {}

_FIRST = "TIMESTAMP '1990-01-01 00:00:00'"
_CHANGED = "TIMESTAMP '1998-06-01 00:00:00'"
_FIRST_RUN = "TIMESTAMP '1998-01-01 00:00:00'"
_MERGED = "TIMESTAMP '1999-06-01 00:00:00'"
_OPEN = "TIMESTAMP '9999-12-31 00:00:00'"


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


# --- source tables --------------------------------------------------------------------

VIEWS["v_products_1"] = f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand_name, p_type AS category_name,
       CAST(2010 + p_size % 10 AS BIGINT) AS model_year, CAST(p_retailprice AS DECIMAL(12,2)) AS list_price,
       {_FIRST} AS created_at, {_FIRST} AS updated_at
FROM part"""

VIEWS["v_products_2"] = f"""
SELECT product_id, product_name,
       CASE WHEN starts_with(brand_name, 'Brand#1') THEN concat(brand_name, ' new') ELSE brand_name END AS brand_name,
       CASE WHEN starts_with(category_name, 'S') THEN concat(category_name, ' new') ELSE category_name END AS category_name,
       model_year,
       CASE WHEN product_id % 4 = 0 THEN CAST(list_price + 10 AS DECIMAL(12,2)) ELSE list_price END AS list_price,
       created_at, CASE WHEN product_id % 4 = 0 THEN {_CHANGED} ELSE updated_at END AS updated_at
FROM v_products_1"""

VIEWS["v_customers_1"] = f"""
SELECT c_custkey AS customer_id,
       concat('  ', lower(c_mktsegment), ' ') AS first_name, concat(' ', upper(c_name)) AS last_name,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('555-', CAST(c_custkey AS VARCHAR)) END AS phone,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat(upper(c_name), '@Mail.EXAMPLE') END AS email,
       concat('Street ', CAST(c_custkey % 100 AS VARCHAR)) AS street,
       n_name AS city, concat('S', CAST(c_nationkey AS VARCHAR)) AS state,
       CAST(10000 + c_custkey AS VARCHAR) AS zip_code, {_FIRST} AS created_at, {_FIRST} AS updated_at
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

VIEWS["v_customers_2"] = f"""
SELECT customer_id, first_name, last_name, phone, email,
       CASE WHEN customer_id % 10 = 0 THEN concat(street, ' moved') ELSE street END AS street,
       city, state, zip_code, created_at,
       CASE WHEN customer_id % 10 = 0 THEN {_CHANGED} ELSE updated_at END AS updated_at
FROM v_customers_1 WHERE customer_id % 10 <> 1
UNION ALL
SELECT customer_id + 1000000, first_name, last_name, phone, email, street, city, state, zip_code, {_CHANGED}, {_CHANGED}
FROM v_customers_1 WHERE customer_id % 20 = 2"""

VIEWS["v_stores"] = f"""
SELECT CAST(n_nationkey AS BIGINT) AS store_id, concat('Store ', n_name) AS store_name, r_name AS state,
       {_FIRST} AS updated_at
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

VIEWS["v_stores_2"] = f"""
SELECT store_id, CASE WHEN store_id % 5 = 0 THEN concat(store_name, ' new') ELSE store_name END AS store_name, state,
       CASE WHEN store_id % 5 = 0 THEN {_CHANGED} ELSE updated_at END AS updated_at FROM v_stores"""

VIEWS["v_staffs"] = f"""
SELECT s_suppkey AS staff_id, lower(s_name) AS first_name, concat('L', CAST(s_suppkey AS VARCHAR)) AS last_name,
       CAST(s_nationkey AS BIGINT) AS store_id,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_suppkey - s_suppkey % 10 END AS manager_id,
       {_FIRST} AS created_at, {_FIRST} AS updated_at
FROM supplier"""

VIEWS["v_staffs_2"] = f"""
SELECT * REPLACE (CASE WHEN staff_id % 10 = 5 THEN (store_id + 1) % 25 ELSE store_id END AS store_id,
                  CASE WHEN staff_id % 10 = 5 THEN {_CHANGED} ELSE updated_at END AS updated_at) FROM v_staffs"""

_ORDERS = """
SELECT order_id, customer_id, order_status, order_date, order_date + 7 AS required_date,
       CASE WHEN order_status = 3 THEN NULL ELSE order_date END AS shipped_date, store_id, order_id % 10 AS staff_id
FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
             CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS order_status,
             {date} AS order_date, {store} AS store_id
      FROM orders) o"""
VIEWS["v_orders_1"] = _ORDERS.format(date="CAST(o_orderdate AS DATE)", store="o_orderkey % 25")
VIEWS["v_orders_2"] = _ORDERS.format(
    date="CASE WHEN o_orderkey % 50 = 0 THEN CAST(o_orderdate AS DATE) + 40 ELSE CAST(o_orderdate AS DATE) END",
    store="CASE WHEN o_orderkey % 50 = 0 THEN (o_orderkey + 1) % 25 ELSE o_orderkey % 25 END",
)

_ITEMS = """
SELECT order_id, product_id, quantity, list_price, discount, quantity * list_price * (1 - discount) AS total, shipped_at
FROM (SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST({quantity} AS DECIMAL(12,2)) AS quantity,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS list_price,
             CASE WHEN l_linenumber % 6 = 0 THEN CAST(0 AS DECIMAL(4,2)) ELSE CAST(l_discount AS DECIMAL(4,2)) END AS discount,
             l_shipdate AS shipped_at
      FROM lineitem) i"""
VIEWS["v_items_1"] = _ITEMS.format(quantity="l_quantity")
VIEWS["v_items_2"] = _ITEMS.format(quantity="CASE WHEN l_orderkey % 30 = 0 THEN l_quantity + 1 ELSE l_quantity END")

VIEWS["v_stocks"] = """
SELECT CAST(s_nationkey AS BIGINT) AS store_id, l_partkey AS product_id,
       CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS quantity
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey, l_partkey"""

# --- refined tables -------------------------------------------------------------------

for _round in (1, 2):
    VIEWS[f"clean_customers_{_round}"] = f"""
SELECT customer_id, concat(upper(substr(trim(first_name), 1, 1)), lower(substr(trim(first_name), 2))) AS first_name,
       concat(upper(substr(trim(last_name), 1, 1)), lower(substr(trim(last_name), 2))) AS last_name,
       coalesce(phone, 'unknown') AS phone, lower(coalesce(email, 'unknown')) AS email,
       street, city, state, zip_code, created_at, updated_at
FROM v_customers_{_round}"""

VIEWS["first_customers"] = f"""
SELECT customer_id, first_name, last_name, phone, email, street, city, state, zip_code, created_at AS start_date,
       {_OPEN} AS end_date, true AS current_flag, row_number() OVER (ORDER BY customer_id) AS sk_customer_id
FROM clean_customers_1"""

VIEWS["customer_actions"] = """
SELECT coalesce(c.customer_id, h.customer_id) AS customer_id,
       CASE WHEN c.customer_id IS NULL THEN 'DELETE' WHEN h.customer_id IS NULL THEN 'INSERT'
            WHEN c.email = h.email AND c.street = h.street AND c.city = h.city
             AND c.state = h.state AND c.zip_code = h.zip_code THEN 'NOCHANGE' ELSE 'UPDATE' END AS action
FROM first_customers h FULL OUTER JOIN clean_customers_2 c ON c.customer_id = h.customer_id"""

_MERGE = """
SELECT h.customer_id, h.street, h.state, h.start_date,
       CASE a.action WHEN 'UPDATE' THEN c.updated_at WHEN 'DELETE' THEN {deleted_end} ELSE h.end_date END AS end_date,
       a.action IN ({staying}) AS current_flag, h.sk_customer_id
FROM first_customers h JOIN customer_actions a ON a.customer_id = h.customer_id
LEFT JOIN clean_customers_2 c ON c.customer_id = h.customer_id
UNION ALL
SELECT c.customer_id, c.street, c.state,
       CASE WHEN a.action = 'INSERT' THEN c.created_at ELSE c.{start} END, TIMESTAMP '9999-12-31 00:00:00', true,
       row_number() OVER (ORDER BY CASE WHEN a.action = 'INSERT' THEN 0 ELSE 1 END, c.customer_id)
         + (SELECT max(sk_customer_id) FROM first_customers)
FROM clean_customers_2 c JOIN customer_actions a ON a.customer_id = c.customer_id
WHERE a.action IN ('INSERT', 'UPDATE')"""
VIEWS["customer_history"] = _MERGE.format(deleted_end=_MERGED, staying="'NOCHANGE'", start="updated_at")
VIEWS["customer_history_delta"] = _MERGE.format(deleted_end="h.end_date", staying="'NOCHANGE', 'DELETE'", start="updated_at")
VIEWS["customer_history_created"] = _MERGE.format(deleted_end=_MERGED, staying="'NOCHANGE'", start="created_at")

VIEWS["product_history"] = f"""
SELECT o.product_id, o.product_name, o.category_name, o.list_price, o.created_at AS start_date,
       CASE WHEN n.list_price = o.list_price THEN {_OPEN} ELSE n.updated_at END AS end_date,
       n.list_price = o.list_price AS current_flag,
       CAST(row_number() OVER (ORDER BY n.product_id) AS BIGINT) AS sk_product_id
FROM v_products_1 o JOIN v_products_2 n ON o.product_id = n.product_id
UNION ALL
SELECT n.product_id, n.product_name, n.category_name, n.list_price, n.updated_at, {_OPEN}, true,
       row_number() OVER (ORDER BY n.product_id) + (SELECT count(*) FROM v_products_1)
FROM v_products_1 o JOIN v_products_2 n ON o.product_id = n.product_id WHERE n.list_price <> o.list_price"""

_NAMED_STAFFS = """
SELECT s.staff_id, s.first_name, s.last_name, CAST(1 AS BIGINT) AS active, st.store_name,
       m.first_name AS manager_first_name, m.last_name AS manager_last_name,
       coalesce(CAST(s.manager_id AS VARCHAR), 'without manager') AS manager_label, s.created_at,
       greatest(s.updated_at, m.updated_at, st.updated_at) AS updated_at
FROM {staffs} s LEFT JOIN {staffs} m ON s.manager_id = m.staff_id LEFT JOIN {stores} st ON s.store_id = st.store_id"""
VIEWS["named_staffs"] = _NAMED_STAFFS.format(staffs="v_staffs", stores="v_stores")
VIEWS["named_staffs_2"] = _NAMED_STAFFS.format(staffs="v_staffs_2", stores="v_stores_2")

VIEWS["staff_history"] = f"""
SELECT staff_id, first_name, store_name, manager_first_name, created_at AS start_date, {_OPEN} AS end_date,
       true AS current_flag, CAST(row_number() OVER (ORDER BY staff_id) AS BIGINT) AS sk_staff_id
FROM named_staffs"""

VIEWS["staff_history_2"] = f"""
SELECT o.staff_id, o.first_name, o.store_name, o.manager_first_name, o.start_date,
       CASE WHEN o.store_name = n.store_name THEN {_OPEN} ELSE n.updated_at END AS end_date,
       o.store_name = n.store_name AS current_flag, o.sk_staff_id
FROM staff_history o JOIN named_staffs_2 n ON o.staff_id = n.staff_id
UNION ALL
SELECT n.staff_id, n.first_name, n.store_name, n.manager_first_name, n.updated_at, {_OPEN}, true,
       row_number() OVER (ORDER BY n.staff_id) + (SELECT count(*) FROM staff_history)
FROM staff_history o JOIN named_staffs_2 n ON o.staff_id = n.staff_id WHERE o.store_name <> n.store_name"""

_SALES = """
SELECT i.order_id, CAST(c.sk_customer_id AS BIGINT) AS sk_customer_id, o.store_id, s.sk_staff_id, o.order_date, p.sk_product_id,
       i.quantity, i.list_price, i.discount, i.total,
       CAST(year(o.order_date) AS BIGINT) AS year, CAST(quarter(o.order_date) AS BIGINT) AS quarter,
       CAST(month(o.order_date) AS BIGINT) AS month, CAST(dayofmonth(o.order_date) AS BIGINT) AS day
FROM v_items_{r} i LEFT JOIN v_orders_{r} o ON i.order_id = o.order_id
LEFT JOIN {customers} c ON o.customer_id = c.customer_id AND o.order_date >= c.start_date AND o.order_date < c.end_date
LEFT JOIN product_history p ON i.product_id = p.product_id AND o.order_date >= p.start_date AND o.order_date < p.end_date
LEFT JOIN {staffs} s ON o.staff_id = s.staff_id AND o.order_date >= s.start_date AND o.order_date < s.end_date"""
VIEWS["sales_facts"] = _SALES.format(r=1, customers="customer_history", staffs="staff_history")
VIEWS["hot_items"] = """SELECT * REPLACE (CASE order_id % 3 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE product_id END AS product_id)
FROM v_items_1"""
VIEWS["sales_facts_hot"] = VIEWS["sales_facts"].replace("v_items_1 i", "hot_items i")
VIEWS["sales_facts_two_runs"] = _SALES.format(r=2, customers="customer_history_delta", staffs="staff_history_2")

_STOCKS = """
SELECT k.store_id, p.sk_product_id, s.store_name, k.quantity, p.list_price,
       CAST(k.quantity * p.list_price AS DECIMAL(30,4)) AS value_stocked, k.snapshot_time,
       CAST(year(k.snapshot_time) AS BIGINT) AS year, CAST(month(k.snapshot_time) AS BIGINT) AS month,
       CAST(dayofmonth(k.snapshot_time) AS BIGINT) AS day
FROM (SELECT v.*, t.snapshot_time FROM v_stocks v CROSS JOIN (VALUES {times}) t(snapshot_time)) k
LEFT JOIN product_history p ON k.product_id = p.product_id
      AND k.snapshot_time >= p.start_date AND k.snapshot_time < p.end_date
LEFT JOIN {stores} s ON k.store_id = s.store_id"""
VIEWS["stock_facts"] = _STOCKS.format(times="(TIMESTAMP '1999-01-01 00:00:00')", stores="v_stores")
VIEWS["stock_facts_two_runs"] = _STOCKS.format(times=f"({_FIRST_RUN}), ({_MERGED})", stores="v_stores_2")

# --- answers --------------------------------------------------------------------------

_CUSTOMER = "customer_id, first_name, last_name, phone, email, street, city, state, zip_code"
_AUDIT = f"{_time('created_at')} AS created_at, {_time('updated_at')} AS updated_at"
_DATES = "CAST({0} AS VARCHAR) AS {0}"

ANSWERS["scan_parquet"] = f"SELECT order_id, customer_id, order_status, {_DATES.format('order_date')}, store_id, staff_id FROM v_orders_1"
ANSWERS["extract_full"] = f"SELECT {_CUSTOMER}, {_AUDIT}, '1998-01-01 00:00:00' AS raw_extraction_time FROM v_customers_1"
ANSWERS["extract_since"] = f"""SELECT {_CUSTOMER}, {_AUDIT}, '1999-06-01 00:00:00' AS raw_extraction_time FROM v_customers_2
WHERE created_at > {_FIRST_RUN} OR updated_at > {_FIRST_RUN}"""
ANSWERS["extract_snapshot"] = """SELECT store_id, product_id, CAST(quantity AS DOUBLE) AS quantity, raw_extraction_time
FROM v_stocks CROSS JOIN (VALUES ('1998-01-01 00:00:00'), ('1999-06-01 00:00:00')) t(raw_extraction_time)"""
ANSWERS["extract_incremental"] = """
SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, store_id, '1990-01-01 00:00:00' AS updated_at,
       '1998-01-01 00:00:00' AS raw_extraction_time FROM v_orders_1
UNION ALL
SELECT order_id, CAST(order_date AS VARCHAR), store_id, '1998-06-01 00:00:00', '1999-06-01 00:00:00'
FROM v_orders_2 WHERE order_id % 50 = 0"""
_FIRST_LOADS = {
    "categories": "(SELECT DISTINCT p_type FROM part) t", "brands": "(SELECT DISTINCT p_brand FROM part) t", "products": "part",
    "customers": "customer", "stores": "nation", "staffs": "supplier", "orders": "orders", "order_items": "lineitem",
    "stocks": "v_stocks",
}
_SECOND_LOADS = {
    "categories": "(SELECT DISTINCT p_type FROM part WHERE starts_with(p_type, 'S')) t",
    "brands": "(SELECT DISTINCT p_brand FROM part WHERE starts_with(p_brand, 'Brand#1')) t",
    "products": "v_products_2 WHERE product_id % 4 = 0", "stores": "nation WHERE n_nationkey % 5 = 0",
    "staffs": "supplier WHERE s_suppkey % 10 = 5",
    "customers": "v_customers_2 WHERE updated_at > TIMESTAMP '1998-01-01 00:00:00'",
    "orders": "orders WHERE o_orderkey % 50 = 0", "order_items": "lineitem WHERE l_orderkey % 30 = 0",
    "stocks": "v_stocks",
}
_LOADED = """SELECT '{name}' AS name, '{run}' AS raw_extraction_time, count(*) AS row_count, '{newest}' AS newest
FROM {source} HAVING count(*) > 0"""
ANSWERS["extract_all"] = "\nUNION ALL\n".join(
    [
        _LOADED.format(name=n, run="1998-01-01 00:00:00", newest="1990-01-01 00:00:00", source=t)
        for n, t in _FIRST_LOADS.items()
    ]
    + [
        _LOADED.format(
            name=n, run="1999-06-01 00:00:00", source=t,
            newest="1990-01-01 00:00:00" if n == "stocks" else "1998-06-01 00:00:00",
        )
        for n, t in _SECOND_LOADS.items()
    ]
)
ANSWERS["csv_load"] = f"""SELECT {_CUSTOMER}, '2015-01-01 00:00:00' AS created_at, '1998-01-01 00:00:00' AS updated_at
FROM v_customers_1"""
ANSWERS["high_water_mark"] = f"SELECT {_time('max(shipped_at)')} AS mark FROM v_items_1"
ANSWERS["incremental_read"] = f"""
SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity, l_extendedprice AS list_price,
       CASE WHEN l_linenumber % 6 = 0 THEN NULL ELSE l_discount + 0.0 END AS discount, {_time('l_shipdate')} AS shipped_at
FROM lineitem WHERE l_shipdate > {_FIRST_RUN}"""
ANSWERS["append_table"] = "SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date FROM v_orders_1"
ANSWERS["overwrite_table"] = "SELECT order_id, store_id * 2 AS store_id FROM v_orders_1"
_CALENDAR = """SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(year(order_date) AS BIGINT) AS year,
       CAST(quarter(order_date) AS BIGINT) AS quarter, CAST(month(order_date) AS BIGINT) AS month,
       CAST(dayofmonth(order_date) AS BIGINT) AS day FROM """
ANSWERS["partitioned_append"] = _CALENDAR + "v_orders_1"
ANSWERS["partition_overwrite"] = _CALENDAR + "v_orders_2"
ANSWERS["calendar_columns"] = _CALENDAR + "v_orders_1"
ANSWERS["empty_batch_guard"] = "SELECT customer_id, city, state, false AS second_batch_written FROM v_customers_1"
ANSWERS["suffix_rename"] = "SELECT customer_id, city AS town_current_name, state FROM v_customers_1"
ANSWERS["cleanse_customers"] = f"SELECT {_CUSTOMER}, {_AUDIT} FROM clean_customers_1"
ANSWERS["fingerprint_plain"] = """SELECT customer_id, md5(concat_ws('', email, street, city, state, zip_code)) AS hash_md5
FROM clean_customers_1"""
_MARKED = ", ".join(
    f"coalesce(CAST(length({c}) AS VARCHAR) || ':' || {c}, '-')" for c in ("email", "street", "city", "state", "zip_code")
)
ANSWERS["fingerprint_strict"] = f"""SELECT customer_id, md5(concat_ws(chr(31), {_MARKED})) AS hash_md5, md5('1') AS no_columns
FROM v_customers_1"""
ANSWERS["surrogate_keys"] = """SELECT order_id, CAST(order_date AS VARCHAR) AS order_date,
       100 + row_number() OVER (ORDER BY order_date, order_id) AS sk_order_id FROM v_orders_1"""
ANSWERS["newest_per_key"] = """SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, store_id,
       CASE WHEN order_id % 50 = 0 THEN '1998-06-01 00:00:00' ELSE '1990-01-01 00:00:00' END AS updated_at FROM v_orders_2"""
ANSWERS["newest_rows_of_log"] = """SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, store_id,
       CASE WHEN order_id % 100 = 0 THEN '1999-06-01 00:00:00' WHEN order_id % 50 = 0 THEN '1999-01-01 00:00:00'
            ELSE '1998-01-01 00:00:00' END AS run FROM v_orders_2"""
_INTERVAL = f"{_time('start_date')} AS start_date, {_time('end_date')} AS end_date, current_flag"
ANSWERS["scd2_initial"] = f"SELECT {_CUSTOMER}, {_INTERVAL}, sk_customer_id FROM first_customers"
ANSWERS["scd2_actions"] = "SELECT customer_id, action FROM customer_actions"
_HISTORY = f"SELECT customer_id, street, {_INTERVAL}, CAST(sk_customer_id AS BIGINT) AS sk_customer_id FROM "
ANSWERS["scd2_merge"] = _HISTORY + "customer_history"
ANSWERS["scd2_merge_delta"] = _HISTORY + "customer_history_delta"
ANSWERS["scd2_merge_from_creation"] = _HISTORY + "customer_history_created"
_DIMENSION = """SELECT '{name}' AS dimension, {key} AS key, {label} AS label, {interval}, CAST({sk} AS DOUBLE) AS sk FROM {history}"""


def _dimensions(customers: str, stores: str) -> str:
    """The rows of all four dimensions after two rounds."""
    return "\nUNION ALL\n".join(
        [
            _DIMENSION.format(name="customers", key="customer_id", label="street", sk="sk_customer_id", interval=_INTERVAL, history=customers),
            _DIMENSION.format(name="products", key="product_id", label="CAST(list_price AS VARCHAR)", sk="sk_product_id",
                              interval=_INTERVAL, history="product_history"),
            _DIMENSION.format(name="staffs", key="staff_id", label="store_name", sk="sk_staff_id", interval=_INTERVAL,
                              history="staff_history_2"),
            _DIMENSION.format(name="stores", key="store_id", label="store_name", sk="NULL", history=stores,
                              interval="NULL AS start_date, NULL AS end_date, NULL AS current_flag"),
        ]
    )


ANSWERS["dim_publish"] = _dimensions("customer_history", "v_stores")
ANSWERS["medallion_run_snapshots"] = _dimensions("customer_history", "v_stores_2")
ANSWERS["products_denorm"] = f"""SELECT product_id, product_name, model_year, CAST(list_price AS DOUBLE) AS list_price,
       brand_name, category_name, {_AUDIT} FROM v_products_1"""
ANSWERS["products_history"] = f"""SELECT product_id, CAST(list_price AS DOUBLE) AS list_price, {_INTERVAL}, sk_product_id
FROM product_history"""
ANSWERS["staffs_denorm"] = f"""SELECT staff_id, first_name, last_name, active, store_name, manager_first_name,
       manager_last_name, manager_label, {_AUDIT} FROM named_staffs"""
ANSWERS["staffs_history"] = f"""SELECT staff_id, first_name, store_name, manager_first_name, {_INTERVAL}, sk_staff_id
FROM staff_history_2"""
ANSWERS["orders_refine"] = """SELECT order_id, customer_id, order_status, CAST(order_date AS VARCHAR) AS order_date,
       CAST(required_date AS VARCHAR) AS required_date, CAST(shipped_date AS VARCHAR) AS shipped_date, store_id, staff_id,
       coalesce(CAST(shipped_date AS VARCHAR), 'not shipped') AS shipped_label FROM v_orders_1"""
_MONEY = "CAST(quantity AS DOUBLE) AS quantity, CAST(list_price AS DOUBLE) AS list_price"
ANSWERS["order_items_refine"] = f"""SELECT order_id, product_id, {_MONEY}, CAST(discount AS DOUBLE) AS discount,
       CAST(total AS DOUBLE) AS total FROM v_items_1"""
ANSWERS["stores_refine"] = """SELECT s_suppkey AS store_id, concat('Outlet ', s_name) AS store_name, n_name AS city, r_name AS state
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
ANSWERS["stock_snapshots"] = """SELECT store_id, product_id, CAST(quantity AS DOUBLE) AS quantity,
       '1999-01-01 00:00:00' AS snapshot_time FROM v_stocks"""
ANSWERS["pit_join_customers"] = """
SELECT o.order_id, o.customer_id, CAST(o.order_date AS VARCHAR) AS order_date,
       CAST(c.sk_customer_id AS DOUBLE) AS sk_customer_id, c.street
FROM v_orders_1 o LEFT JOIN customer_history c
  ON o.customer_id = c.customer_id AND o.order_date >= c.start_date AND o.order_date < c.end_date"""
ANSWERS["pit_join_inclusive"] = """
SELECT o.order_id, o.customer_id, CAST(o.order_date AS VARCHAR) AS order_date,
       CAST(c.sk_customer_id AS DOUBLE) AS sk_customer_id
FROM v_orders_1 o LEFT JOIN customer_history c
  ON o.customer_id = c.customer_id AND o.order_date BETWEEN c.start_date AND c.end_date"""
ANSWERS["pit_join_long_history"] = f"""
SELECT i.order_id, i.order_id % 3 AS price_id, {_time('i.shipped_at')} AS shipped_at, CAST(p.price AS DOUBLE) AS price
FROM v_items_1 i LEFT JOIN (
  SELECT price_id, start_date, dayofyear(start_date) AS price,
         coalesce(lead(start_date) OVER (PARTITION BY price_id ORDER BY start_date), DATE '9999-12-31') AS end_date
  FROM (SELECT DISTINCT order_id % 3 AS price_id, order_date AS start_date FROM v_orders_1)) p
  ON i.order_id % 3 = p.price_id AND i.shipped_at >= p.start_date AND i.shipped_at < p.end_date"""
ANSWERS["fact_sales"] = f"""SELECT order_id, CAST(sk_customer_id AS DOUBLE) AS sk_customer_id, store_id,
       CAST(sk_staff_id AS DOUBLE) AS sk_staff_id, CAST(order_date AS VARCHAR) AS order_date,
       CAST(sk_product_id AS DOUBLE) AS sk_product_id, {_MONEY}, CAST(discount AS DOUBLE) AS discount, CAST(total AS DOUBLE) AS total, year, quarter, month, day
FROM sales_facts"""
ANSWERS["fact_sales_hot_keys"] = ANSWERS["fact_sales"].replace("FROM sales_facts", "FROM sales_facts_hot")
ANSWERS["fact_stocks"] = f"""SELECT store_id, CAST(sk_product_id AS DOUBLE) AS sk_product_id, store_name, {_MONEY}, CAST(value_stocked AS DOUBLE) AS value_stocked,
       {_time('snapshot_time')} AS snapshot_time, year, month, day FROM stock_facts"""
_TOTAL = "CAST(ceiling(SUM(i.total)) AS BIGINT) AS total"
ANSWERS["sales_by_category"] = f"""SELECT p.category_name, {_TOTAL}
FROM v_items_1 i LEFT JOIN product_history p ON i.product_id = p.product_id AND p.current_flag GROUP BY p.category_name"""
ANSWERS["sales_by_category_all_versions"] = f"""SELECT p.category_name, {_TOTAL}
FROM v_items_1 i LEFT JOIN product_history p ON i.product_id = p.product_id GROUP BY p.category_name"""
ANSWERS["most_sold_products"] = f"""SELECT p.product_name, {_TOTAL}
FROM v_items_1 i LEFT JOIN product_history p ON i.product_id = p.product_id AND p.current_flag
GROUP BY p.product_name ORDER BY total DESC, product_name LIMIT 10"""
ANSWERS["sales_by_store"] = f"""SELECT s.store_name, {_TOTAL}
FROM v_items_1 i LEFT JOIN v_orders_1 o ON i.order_id = o.order_id
LEFT JOIN v_stores s ON o.store_id = s.store_id GROUP BY s.store_name"""
ANSWERS["ctas_replace"] = ANSWERS["sales_by_store"]
_STATES = f"""SELECT c.state, {_TOTAL}
FROM v_items_{{r}} i LEFT JOIN v_orders_{{r}} o ON i.order_id = o.order_id
LEFT JOIN {{customers}} c ON o.customer_id = c.customer_id AND c.current_flag GROUP BY c.state"""
ANSWERS["sales_by_state"] = _STATES.format(r=1, customers="customer_history")
_MEASURES = ("quantity", "total", "value_stocked", "sk_customer_id", "sk_product_id", "sk_staff_id", "store_id")


def _slice(kind: str, source: str, by: list[str], measures: list[str]) -> str:
    part = " || '/' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in by)
    sums = ", ".join(
        f"CAST({f'sum({m})' if m in measures else 'NULL'} AS DOUBLE) AS sum_{m}" for m in _MEASURES
    )
    return f"SELECT '{kind}' AS kind, {part} AS part, count(*) AS facts, {sums} FROM {source} GROUP BY {', '.join(by)}"


_state = _STATES.format(r=2, customers="customer_history_delta")
_by_product = f"""SELECT p.{{0}}, {_TOTAL}
FROM v_items_2 i LEFT JOIN product_history p ON i.product_id = p.product_id AND p.current_flag GROUP BY p.{{0}}"""
_store = f"""SELECT s.store_name, {_TOTAL}
FROM v_items_2 i LEFT JOIN v_orders_2 o ON i.order_id = o.order_id LEFT JOIN v_stores_2 s ON o.store_id = s.store_id GROUP BY s.store_name"""
_top = _by_product.format("product_name") + " ORDER BY total DESC, product_name LIMIT 10"
ANSWERS["medallion_run"] = "\nUNION ALL\n".join(
    [
        _slice("fact_sales", "sales_facts_two_runs", ["year", "quarter", "month"],
               ["quantity", "total", "sk_customer_id", "sk_product_id", "sk_staff_id", "store_id"]),
        _slice("fact_stocks", "stock_facts_two_runs", ["store_name", "year", "month"],
               ["quantity", "value_stocked", "sk_product_id", "store_id"]),
        _slice("sales_by_state", f"({_state}) t", ["state"], ["total"]),
        _slice("sales_by_store", f"({_store}) t", ["store_name"], ["total"]),
        _slice("sales_by_category", f"({_by_product.format('category_name')}) t", ["category_name"], ["total"]),
        _slice("most_sold_products", f"({_top}) t", ["product_name"], ["total"]),
        _slice("dim_customers", "customer_history_delta", ["current_flag"], ["sk_customer_id"]),
        _slice("dim_products", "product_history", ["current_flag"], ["sk_product_id"]),
        _slice("dim_staffs", "staff_history_2", ["current_flag"], ["sk_staff_id"]),
        _slice("dim_stores", "v_stores_2", ["store_name"], ["store_id"]),
    ]
)


def _referred(text: str) -> list[str]:
    """The views ``text`` needs, each after those it needs itself."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(VIEWS[name])
                needed.append(name)

    visit(text)
    return needed


def oracle_text(name: str) -> str:
    views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in _referred(ANSWERS[name]))
    return f"WITH {views}\n{ANSWERS[name]}" if views else ANSWERS[name]
