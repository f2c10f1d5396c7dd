"""Every registered query against its SQL, and against plan rules."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from workload.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert differences(con, df, entry.oracle_sql()[name]) == ""


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Scan ExistingRDD")


@pytest.mark.parametrize("name", NAMES)
def test_plan(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert [f for f in FORBIDDEN if f in plan] == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
