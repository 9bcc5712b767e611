"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from tallywright.plans import catalog, oracle

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    rows = {r["difficulty"]: r["problems"] for r in contract.entry(spark).collect()}
    assert list(rows) == ["Easy", "Medium", "Hard"] and sum(rows.values()) > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, QUERIES[name], SQL[name], sf_dir) == []
