"""Operators that SQL can state: their queries over the given tables, value for value against the SQL text."""

import os

import pytest

from checks import compare
from wattfold.llm import queries, sql

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return compare.duck_with_tables(SF_DIR, ["documents", "embeddings"])


@pytest.mark.parametrize("name", sorted(sql.ORACLE | sql.CLOSE))
def test_query_equals_sql(spark, duck, name):
    ok, message, _ = compare.compare(spark, duck, name, queries.QUERIES[name], (sql.ORACLE | sql.CLOSE)[name], SF_DIR)
    assert ok, message
