"""Every registered query against its DuckDB statement."""

import pytest

import __spark_entry__ as entry
from airtrack.plans import queries
from checks import compare, oracle_sql
from tests.conftest import SCALE

QUERIES = queries.all_queries()
STATEMENTS = oracle_sql.statements()


@pytest.fixture(scope="module")
def con():
    return compare.tables(SCALE)


def test_every_query_has_a_statement():
    assert QUERIES.keys() == STATEMENTS.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare.difference(QUERIES[name](spark, SCALE), con, STATEMENTS[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1000
