"""Every text query is registered; those that SQL can express agree with it, and the native ones run no Python."""

import pytest

import __spark_entry__ as entry
from remitlens.llm import queries
from tests.compare import differences, given_tables

FOLDER = "/root/testdata/sf0.001"


def test_names():
    names = list(entry.queries())
    for number in range(1, 14):
        assert len([n for n in names if n.startswith(f"op{number}_")]) == 1
    assert "pipeline" in names and set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, name):
    df = queries.queries()[name](spark, FOLDER)
    assert differences(df, given_tables(FOLDER), queries.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["op5_chat", "op8_quality_rules", "op9_secrets"])
def test_native(spark, name):
    plan = queries.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
