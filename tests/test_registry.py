"""Every registered query equals its SQL; names and plans keep their rules."""

import re

import pytest
from oracle import compare, duck
from tables import SF

import __spark_entry__ as entry

# The queries of the optional subpackage have tests of their own.
QUERIES, ORACLES = entry.load()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    seen = []

    def query(spark, folder):
        seen.append(QUERIES[name](spark, folder))
        return seen[0]

    assert compare(spark, con, SF, name, query, ORACLES.get(name)) is None
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["doc_id", "text", "generated", "source"]
    assert rows.count() > 0


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert not [n for n in QUERIES if "pipeline" in n or re.match(r"op\d", n)]
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())

