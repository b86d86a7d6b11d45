"""Registered text queries against their SQL."""

import pytest

from tests import oracle
from wayfold.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, size):
    folder = f"/root/testdata/{size}"
    con = oracle.connect(folder)
    assert oracle.difference(queries.QUERIES[name](spark, folder), con, queries.oracle_sql()[name]) is None
    con.close()
