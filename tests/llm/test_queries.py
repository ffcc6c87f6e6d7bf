"""The registered queries: names, SQL, plans without all-pairs joins or row-wise Python, native operators."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry
from textgauge.llm import queries


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.QUERIES) < set(entry.queries())


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, sf, name):
    seen = []

    def query(spark, folder):
        seen.append(queries.QUERIES[name](spark, folder))
        return seen[0]

    assert compare(spark, duck(sf), sf, name, query, queries.ORACLES.get(name)) is None
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan
    if name.startswith(("op1_", "op8_")):
        assert "Arrow" not in plan and "Python" not in plan
