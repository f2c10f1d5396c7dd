"""One key holds a third of all rows: joins are split, windows are limited first."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from canvass.operators import aggregate as a
from canvass.operators import joins, windows

N = 600_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


@pytest.fixture(scope="module")
def facts(spark):
    """Key 0 holds a third of the rows."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(1 + F.col("id") % 10007)
    yield spark.range(0, N, 1, 8).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def expected():
    return Counter(0 if i % 3 == 0 else 1 + i % 10007 for i in range(N))


def run(df):
    """Rows after execution, and the plan that adaptive execution ended with."""
    query = df._jdf.queryExecution()
    return query.toRdd().count(), query.executedPlan().toString()


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(0, 10008).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("label"))


def test_lookups_are_split(facts, dim):
    for df in (joins.lookup(facts, dim, "k"), joins.lookup(facts, dim, "k", null_safe=True), joins.natural_join(facts, dim)):
        rows, plan = run(df)
        assert rows == N and "skew=true" in plan


def test_recode_by_table_is_split(facts, dim):
    mapping = dim.select(F.col("k").cast("string").alias("name"), "label")
    rows, plan = run(joins.recode(facts.withColumn("c", F.col("k").cast("string")), mapping, "c"))
    assert rows == N and "skew=true" in plan


def test_entity_filters_are_split(facts, dim):
    even, odd = dim.filter("k % 2 = 0"), dim.filter("k % 2 = 1")
    want = sum(n for k, n in expected().items() if k % 2 == 0)
    for df in (joins.keep_ids(facts, even, "k"), joins.drop_known(facts, odd, "k")):
        rows, plan = run(df)
        assert rows == want and "skew=true" in plan


def test_group_size_is_split(facts):
    rows, plan = run(a.add_count(facts, "k"))
    assert rows == N and "skew=true" in plan
    got = {r["k"]: r["n"] for r in a.add_count(facts, "k").select("k", "n").distinct().collect()}
    assert got == dict(expected())


def test_share_inside_a_hot_group_is_split(facts):
    # group 0 has as many levels as rows, so even its counts are a third of all
    n = a.counts(facts, ["k", "pad"])
    rows, plan = run(a.share_of_group(n, "k"))
    assert rows == N and "skew=true" in plan


def test_first_row_per_key_is_limited_before_the_shuffle(facts):
    rows, plan = run(windows.dedup_first(facts, "k", ["id"]))
    assert rows == len(expected())
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")
