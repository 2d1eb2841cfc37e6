"""Every registered query against its SQL on the smallest tables."""

import pytest

import catalog
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
REGISTRY = catalog.load()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    ok, note = compare(spark, con, REGISTRY[name], SF)
    assert ok, note


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
