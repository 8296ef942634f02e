"""Registered queries against their SQL twins, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from stockroom import catalog, oracle

from .compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys() and SQL.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, name, QUERIES[name], SQL[name], FOLDER) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["store_name", "total_revenue"]
