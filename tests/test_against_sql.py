"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from mapledger.checks import oracles
from mapledger.checks import queries as registered
from mapledger.checks.compare import connect, difference

from .conftest import TESTDATA

QUERIES, SQL = registered.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(TESTDATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    df = QUERIES[name](spark, TESTDATA)
    assert difference(df, connection, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    # the one step in Python numbers the tags of XML documents, in Arrow batches
    assert all("_places(" in line for line in plan.splitlines() if "Python" in line)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
