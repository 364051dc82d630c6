"""Every registered query against its SQL twin on the smallest tables, and its physical plan."""

import pytest

import __spark_entry__ as entry
from tests.compare import differences, given_tables
from tests.conftest import SMALL

QUERIES, SQL = entry.warehouse_queries(), entry.oracle_queries.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return given_tables(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 7 and rows[0].leakage_rs >= rows[-1].leakage_rs


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SMALL)
    assert differences(df, connection, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    # No pair of rows is formed without a key, and no row goes through Python.
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan
