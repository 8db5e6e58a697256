"""Every registered query against its SQL, on the smallest supplied tables."""

import os

import pytest

import __spark_entry__ as contract
from tidemark.queries import CHECKS
from tests.oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(CHECKS) <= set(contract.queries())
    assert set(CHECKS) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_agrees_with_sql(spark, sql, name):
    got = contract.queries()[name](spark, SF_DIR).toArrow()
    want = sql.sql(contract.oracle_sql()[name]).to_arrow_table()
    assert differences(got, want) == []


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


NO_CARTESIAN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize(
    "name",
    [
        n
        for n in CHECKS
        if not any(w in n for w in ("runs", "ingest_p", "ingest_c", "ingest_upsert", "stream", "discover"))
    ],
)
def test_plans_hold_no_pairwise_join_and_no_python(spark, name):
    plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in NO_CARTESIAN if w in plan]
