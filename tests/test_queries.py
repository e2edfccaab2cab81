"""Every registered query against its checking SQL."""

from __future__ import annotations

import pytest

from checks import ORACLES, QUERIES
from checks.compare import compare, oracle_connection


SLOW_SHAPES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    text = df._jdf.queryExecution().executedPlan().toString()
    # two fact tables without a dimension meet as one row each
    if name != "semantic_multi_fact_total":
        assert not [shape for shape in SLOW_SHAPES if shape in text]
    assert compare(spark, con, name, sf, df) is None


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(ORACLES) == set(QUERIES)
