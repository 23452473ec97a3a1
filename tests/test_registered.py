"""Every registered query against its SQL, over whole tables."""

import os

import pytest
from oracle import compare, connect

from tablewright.registry import all_queries, all_sql

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(SQL))
def test_agrees_with_sql(spark, duck, key):
    difference = compare(spark, duck, QUERIES[key], SQL[key], SF)
    assert difference is None, difference


def test_every_query_is_covered():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 6
    assert set(driver.oracle_sql()) <= set(driver.queries())
