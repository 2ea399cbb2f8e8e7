"""Every registered query on the smallest given tables, value for value against its SQL text."""

import os
import re

import pytest

import __spark_entry__ as E
from checks import compare

SF_DIR = "/root/testdata/sf0.001"
NO_SQL: set[str] = set()

#: The training-data operators have tests of their own, against plain versions.
OWN_TESTS = re.compile(r"op\d+_|pipeline$")
NAMES = sorted(n for n in E.queries() if not OWN_TESTS.match(n))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    from checks.standin import TABLES

    return compare.duck_with_tables(SF_DIR, TABLES)


def test_every_query_but_the_listed_ones_has_sql():
    assert set(NAMES) - set(E.oracle_sql()) == NO_SQL


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    ok, message, _ = compare.compare(spark, duck, name, E.queries()[name], E.oracle_sql().get(name), SF_DIR)
    assert ok, message


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["ano_mes", "nom_fonte", "corte_gwh", "gnra_oficial_gwh", "geracao_gwh", "referencia_gwh", "taxa_corte_pct"]
    assert df.count() > 0
