"""Every query against its SQL answer, rows and values exactly."""

import pytest

import __spark_entry__ as contract
from check import connect, differences
from tidemark.catalogue import QUERIES
from tidemark.oracle import ANSWERS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)
    assert set(QUERIES) <= set(contract.queries()) and set(ANSWERS) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == connect(FOLDER).execute("SELECT count(*) FROM lineitem").fetchall()[0][0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_answer(spark, connection, name):
    assert differences(contract.queries()[name](spark, FOLDER), connection, contract.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", ["extract_since", "scd2_merge", "fact_stocks"])
def test_answer_does_not_depend_on_the_session(spark, connection, name):
    before = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.timestampType")}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_LTZ")
    try:
        found = differences(contract.queries()[name](spark, FOLDER), connection, contract.oracle_sql()[name])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == ""
