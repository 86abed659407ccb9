"""Every bound query against DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks import registry
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_gives_records(spark):
    df = contract.entry(spark)
    assert df.columns == ["record"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees(spark, con, name):
    rows, message = compare(spark, con, SF, contract.queries()[name], contract.oracle_sql().get(name))
    assert message == ""
    assert rows >= 0
