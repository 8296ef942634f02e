"""Queries beside their SQL twins."""

import duckdb
import pytest

from stockroom.llm import queries

from ..compare import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for name in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return db


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, name, queries.queries()[name], queries.oracle_sql()[name], FOLDER) is None
