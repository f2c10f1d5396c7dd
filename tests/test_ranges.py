"""Ranks, row numbers, running sums and quantiles by ranges against plain Python and SQL."""

import random
import re
import statistics

import duckdb
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canvass.operators import ranges as r
from canvass.operators import reshape

SCHEMA = "g string, v int, w string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def sql(rows, query, columns=("g", "v", "w")):
    t = pd.DataFrame(rows, columns=list(columns)).astype({"v": "Int64"})  # noqa: F841
    return sorted(map(tuple, duckdb.sql(query).fetchall()), key=repr)


def told(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["x", "y", None])),
    max_size=40,
)


@settings(max_examples=4, deadline=None)
@given(ROWS)
def test_ranks_and_numbers(spark, rows):
    df = frame(spark, rows)
    got = told(r.ranks(df, ["v"], ["g"], descending=["v"], ranges=5).select("g", "v", "w", "rank", "dense_rank"))
    want = sql(rows, """SELECT g, v, w, rank() OVER p AS a, dense_rank() OVER p AS b FROM t
        WINDOW p AS (PARTITION BY g ORDER BY v DESC NULLS LAST)""") if rows else []
    assert got == want
    got = told(r.row_numbers(df, ["v"], descending=["v"], ranges=5))
    want = sql(rows, """SELECT g, v, w, row_number() OVER (ORDER BY v DESC NULLS LAST, g NULLS LAST, w NULLS LAST) FROM t""") if rows else []
    assert got == want


def test_hot_value_and_ties_on_borders(spark):
    # a third of all rows share a value and a key; the order has no other column to tell them apart
    random.seed(1)
    rows = [("h", 7, "x") if i % 3 == 0 else ("h", random.randrange(400), "y") for i in range(6000)]
    df = frame(spark, rows).repartition(8)
    assert told(r.row_numbers(df, ["v"], ["g"], ranges=16)) == sql(
        rows, "SELECT g, v, w, row_number() OVER (PARTITION BY g ORDER BY v, w) FROM t")
    assert told(r.ranks(df, ["v"], ranges=16).select("v", "rank", "dense_rank").distinct()) == sql(
        rows, "SELECT DISTINCT v, rank() OVER (ORDER BY v), dense_rank() OVER (ORDER BY v) FROM t")


def test_running_sums(spark):
    rows = [("a" if i % 2 else "b", i, "x") for i in range(500)]
    got = told(r.running_sums(frame(spark, rows), ["v"], ["v"], ["g"], descending=["v"], ranges=7).select("g", "v", "v_before"))
    assert got == sql(rows, """SELECT g, v, coalesce(sum(v) OVER (PARTITION BY g ORDER BY v DESC
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT FROM t""")


def test_no_window_runs_over_everything(spark):
    df = spark.range(0, 20000, 1, 8).select((F.col("id") % 977).alias("v"), "id")
    for out in (r.row_numbers(df, ["v"]), r.ranks(df, ["v"]), r.quantiles(df, "v", [0.5])):
        plan = out._jdf.queryExecution().sparkPlan().toString()
        for window in [line for line in plan.splitlines() if " Window [" in line]:
            # inside a range, or over the sums of the ranges (at most RANGES rows for each group)
            inside = re.search(r"\], \[_range#", window)
            assert inside or re.search(r"sum\((_part|__rows|__keys)#", window)


def test_ranges_are_searched_by_compiled_code_without_a_join_on_them(spark):
    df = spark.range(0, 20000, 1, 8).select((F.col("id") % 977).alias("v"), "id")
    for out in (r.row_numbers(df, ["v"], descending=["v"]), r.quantiles(df, "v", [0.5], ["id"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        # a lambda runs uncompiled for every row; array_sort is left, over the borders alone
        searched = [line for line in plan.splitlines() if "_borders" in line and "lambda" in line and "array_sort" not in line]
        joined = [line for line in plan.splitlines() if "Join" in line and "_range#" in line]
        assert searched == [] and joined == []


@pytest.mark.parametrize("ranges", [1, 2, 3, 8, 33])
def test_range_is_the_number_of_borders_reached(spark, ranges):
    random.seed(ranges)
    rows = [(random.choice(["a", "b", None]), random.choice([None, *range(30)]), random.choice(["x", "y", None])) for _ in range(300)]
    got = r.with_range(frame(spark, rows).repartition(4), ["v", "g", "w"], ["g"], ranges=ranges).collect()

    def key(x):
        return (x["v"] is None, x["v"] or 0), (x["g"] is None, -ord(x["g"]) if x["g"] else 0), (x["w"] is None, x["w"] or "")

    keys = {}
    for x in sorted(got, key=key):
        keys.setdefault(key(x), set()).add(x["_range"])
    numbers = [n for ns in keys.values() for n in ns]
    assert len(got) == 300 and all(len(ns) == 1 for ns in keys.values())
    assert numbers == sorted(numbers) and 1 <= max(numbers) <= ranges
    # every border is a key, and the first to reach it
    assert set(numbers) | {0} == set(range(max(numbers) + 1))


def test_quantiles(spark):
    rows = [("a", i * i % 1013, "x") for i in range(3000)] + [("b", 5, "x")] * 7 + [("c", None, "x")] + [(None, 1, "x"), (None, 2, "x")]
    got = {x["g"]: (x["quantiles"], x["n"]) for x in r.quantiles(frame(spark, rows), "v", [0.0, 0.25, 0.5, 1.0], ["g"], ranges=32).collect()}
    for g in ("a", "b", None):
        values = sorted(v for k, v, _ in rows if k == g and v is not None)
        q = statistics.quantiles(values, n=4, method="inclusive")
        assert got[g] == ([values[0], q[0], q[1], values[-1]], len(values))
    assert got["c"] == (None, 0)
    empty = r.quantiles(frame(spark, []), "v", [0.5]).collect()
    assert [tuple(x) for x in empty] == [(None, 0)]
    assert r.quantiles(frame(spark, []), "v", [0.5], ["g"]).count() == 0
    with pytest.raises(ValueError):
        r.quantiles(frame(spark, []), "v", [1.5])


def test_median_of_a_hot_group_of_distinct_values(spark):
    n = 300_000
    df = spark.range(0, n, 1, 8).select(F.lit("h").alias("g"), (F.col("id") * 7919 % n).alias("v"))
    out = r.quantiles(df, "v", [0.5], ["g"])
    assert [tuple(x) for x in out.collect()] == [("h", [(n - 1) / 2], n)]


def test_grid_of_two_tables(spark):
    left = frame(spark, [("a", 1, None), ("a", 1, None), (None, 2, "x")])
    right = spark.createDataFrame([(1, "q"), (2, None), (2, None)], "i int, j string")
    got = told(reshape.grid(left, right))
    assert got == sorted([(*a, *b) for a in [("a", 1, None), (None, 2, "x")] for b in [(1, "q"), (2, None)]], key=repr)
    assert reshape.grid(left, right.filter("i = 0")).count() == 0
