"""Queries that SQL can express, against their SQL on the smallest tables."""

import pytest

from catalog import Query
from gridloom.llm.oracle import SQL
from gridloom.llm.queries import QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    ok, note = compare(spark, connect(SF), Query(QUERIES[name], SQL[name]), SF)
    assert ok, note
