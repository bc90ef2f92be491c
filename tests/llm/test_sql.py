"""The corpus queries that SQL can express, against DuckDB over the given tables."""

import pytest

from oracle_check import compare, connect
from sitescout.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, queries.QUERIES[name], queries.ORACLES[name], SF) > 0


@pytest.mark.parametrize("name", ["op5_order_minhash", "op7_decontamination", "op9_source_mix"])
def test_main_path_is_native(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert forbidden not in plan
