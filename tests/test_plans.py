"""The physical plans hold at scale: what is shuffled, pruned and joined how."""

import re

import pytest

from tidemark import catalogue
from tidemark.operators import first_versions, merge_versions, stored
from tidemark.plans import gold, marts
from tidemark.retail import Retail

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def retail(spark):
    return Retail(spark, FOLDER)


@pytest.fixture(scope="module")
def dims(spark, retail):
    return {
        "customers": stored(first_versions(catalogue._customers(retail, 1), "customer_id")),
        "products": stored(first_versions(catalogue._products(retail, 1), "product_id")),
        "staffs": stored(first_versions(catalogue._staffs(retail), "staff_id")),
    }


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def sales(retail, dims, hot=None):
    return gold.sales_facts(
        catalogue._items(retail), retail.orders(), dims["customers"], dims["products"], dims["staffs"], hot
    )


def test_facts_use_equality_joins_only(retail, dims, no_broadcast):
    plan = plan_of(sales(retail, dims))
    assert plan.count("SortMergeJoin") == 4
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan


def test_items_are_shuffled_once_per_join_of_their_own(retail, dims, no_broadcast):
    """Customers and staffs are joined to the order headers, not to the items."""
    plan = plan_of(sales(retail, dims))
    before_items = re.split(r"FileScan parquet \[l_orderkey", plan)[0]
    assert before_items.count("Exchange hashpartitioning") == 2


def test_small_dimensions_are_broadcast_by_size_alone(retail, dims):
    assert "BroadcastHashJoin" in plan_of(sales(retail, dims))


def test_facts_read_only_the_columns_they_need(retail, dims):
    plan = plan_of(sales(retail, dims))
    assert "l_tax" not in plan and "l_shipdate" not in plan and "o_totalprice" not in plan


def test_spread_facts_equal_plain_facts(retail, dims, no_broadcast):
    hot = {"order_id": {7: 0.3}, "product_id": {3: 0.4, 5: 0.01}, "customer_id": {1: 0.2}, "staff_id": {0: 0.1, None: 0.1}}
    plain, spread = sales(retail, dims), sales(retail, dims, hot)
    assert "_piece" in plan_of(spread)
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()


def test_marts_add_up_before_they_join(retail, dims, no_broadcast):
    for mart in (
        marts.sales_by_category(catalogue._items(retail), dims["products"]),
        marts.sales_by_store(catalogue._items(retail), retail.orders(), retail.stores()),
    ):
        plan = plan_of(mart)
        deepest = plan.split("Exchange")
        items = next(part for part in deepest if "FileScan parquet [l_" in part)
        assert "partial_sum" in items and "SortMergeJoin" not in items


def test_top_products_need_no_full_sort(retail, dims):
    assert "TakeOrderedAndProject" in plan_of(marts.most_sold_products(catalogue._items(retail), dims["products"]))


def test_small_batch_does_not_shuffle_the_open_history(spark, retail, dims):
    """Open rows meet a small batch by broadcast; only new versions are exchanged."""
    merged = merge_versions(
        dims["customers"], catalogue._customers(retail, 2).limit(5), "customer_id", ["street"], "1999-06-01 00:00:00"
    )
    plan = plan_of(merged)
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan


def test_merge_of_a_large_batch_is_all_equality_joins(spark, retail, dims, no_broadcast):
    merged = merge_versions(
        dims["customers"], catalogue._customers(retail, 2), "customer_id", ["street"], "1999-06-01 00:00:00", "snapshot"
    )
    plan = plan_of(merged)
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "SinglePartition" not in plan
