"""Queries that SQL can express, against DuckDB on the same tables."""

import pytest

from convoy.llm.queries import ORACLES, QUERIES
from registry.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = connect(SMALL)
    assert differences(spark, con, QUERIES[name], ORACLES[name], SMALL) is None
