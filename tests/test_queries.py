"""Every registered query with check SQL against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) is None


def test_entry(spark, sf_dir):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
