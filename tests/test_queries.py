"""Registered queries against their DuckDB oracle, and the shape of their plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from checks import REGISTRY
from checks.compare import differences, duck

DATA = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.fixture(scope="module")
def oracle():
    return duck(DATA)


@pytest.mark.parametrize("name", REGISTRY)
def test_query_matches_oracle(spark, oracle, name):
    fn, sql = REGISTRY[name]
    df = fn(spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [f for f in FORBIDDEN if f in plan] == []
    problems, _ = differences(df, oracle, sql)
    assert problems == []


def test_entry_contract(spark):
    assert driver.entry(spark).columns[:2] == ["o_custkey", "win_date"]
    assert driver.entry(spark).count() > 0
    more = driver.llm_queries.QUERIES.keys() | {"pipeline"} if driver.llm_queries else set()
    assert set(driver.queries()) == REGISTRY.keys() | more
    assert REGISTRY.keys() <= set(driver.oracle_sql()) <= set(driver.queries())
