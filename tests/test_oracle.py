"""Every registered query against its SQL on DuckDB, at the smallest scale."""

from __future__ import annotations

import pytest
from check import compare, connect

import __spark_entry__ as entry
from sedimenta.testbed.catalog import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert compare(df, con, ORACLE[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
