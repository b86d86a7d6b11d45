"""Every registered query against its SQL, value by value."""

import pytest

import __spark_entry__ as entry
from tests import oracle
from wayfold.plans import oracles, queries

QUERIES, SQL = queries.QUERIES, oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = oracle.connect(small)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, duck, name):
    assert oracle.difference(QUERIES[name](spark, small), duck, SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
