"""Every registered query against its SQL, and the driver contract."""

import compare
import pytest

import __spark_entry__ as contract
from registry.core import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


# Nodes that would mean row-by-row Python or all pairs of rows.
UNWANTED = (
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin",
)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_matches_sql(spark, small, con, name):
    found = QUERIES[name].build(spark, small)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [node for node in UNWANTED if node in plan] == []
    assert compare.differences(found, con, QUERIES[name].sql) == []


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is None])
def test_has_rows(spark, small, name):
    assert QUERIES[name].build(spark, small).count() > 0


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_names_are_free_of_reserved_words():
    assert not [n for n in QUERIES if n.startswith("op") or "pipeline" in n]
