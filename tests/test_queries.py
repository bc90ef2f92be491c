"""Every registered query against its DuckDB SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as contract
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = sorted(contract.CORE)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(contract.CORE) <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, name):
    rows = compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF)
    assert rows > 0 or name.startswith("batch_")


@pytest.mark.parametrize("name", NAMES)
def test_plan_is_native(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert forbidden not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0
