"""Properties that hold for any answers."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canvass.functions.local import local_table
from canvass.operators import aggregate as a
from canvass.operators import joins, privacy, reshape, windows

few = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
code = st.sampled_from([None, "", "a", "b", "c d", "ü"])
answers = st.lists(st.tuples(code, st.one_of(st.none(), st.integers(0, 5))), min_size=1, max_size=40)


def frame(spark, data):
    return local_table(spark, [(i, c, v) for i, (c, v) in enumerate(data)], "id int, c string, v int")


@few
@given(answers)
def test_recode_keeps_every_row(spark, data):
    df = frame(spark, data)
    table = local_table(spark, [("a", "A"), ("b", "B"), (None, "N")], "name string, label string")
    got = joins.recode(df, table, "c", null_safe=True).collect()
    assert {r["id"]: r["c"] for r in got} == {i: {"a": "A", "b": "B", None: "N"}.get(c) for i, (c, _) in enumerate(data)}
    assert len(got) == len(data)


@few
@given(answers)
def test_long_rows_are_the_known_cells(spark, data):
    df = frame(spark, data).withColumn("w", F.col("v") + 1)
    known = sum(v is not None for _, v in data)
    assert reshape.columns_long(df, ["v", "w"], "x", ["id"]).count() == 2 * known
    assert reshape.columns_long(df, ["v", "w"], "x", ["id"], keep_null=True).count() == 2 * len(data)


@few
@given(answers)
def test_shares_of_each_group_sum_to_one(spark, data):
    out = a.distribution_within(frame(spark, data), ["c"], "v")
    for r in out.groupBy("c").agg(F.sum("percent").alias("p"), F.sum("n").alias("n")).collect():
        assert abs(r["p"] - 1) < 1e-9 and r["n"] == sum(c == r["c"] for c, _ in data)


@few
@given(answers, st.integers(1, 5))
def test_no_small_group_is_shown(spark, data, k):
    sizes = Counter(c for c, _ in data)
    for r in a.group_mean_suppressed(frame(spark, data), "c", "v", k=k).collect():
        assert r["n"] == sizes[r["c"]]
        known = [v for c, v in data if c == r["c"] and v is not None]
        assert (r["avg"] is None) == (r["n"] < k or not known)


@few
@given(answers)
def test_released_column_is_the_same_multiset(spark, data):
    out = privacy.delink(frame(spark, data), "c", ["id"])
    assert out.columns == ["c"]
    assert Counter(r["c"] for r in out.collect()) == Counter(c for c, _ in data)


@few
@given(answers)
def test_first_row_per_key(spark, data):
    got = {r["c"]: r["id"] for r in windows.dedup_first(frame(spark, data), "c", ["id"]).collect()}
    want = {}
    for i, (c, _) in enumerate(data):
        if c is not None:
            want.setdefault(c, i)
    assert got == want


@few
@given(answers)
def test_completed_counts(spark, data):
    n = a.counts(frame(spark, data), ["c", "v"])
    got = {(r["c"], r["v"]): r["n"] for r in reshape.complete(n, ["c"], "v", [0, 9]).collect()}
    want = Counter(data)
    for c, _ in data:
        for level in (0, 9):
            want.setdefault((c, level), 0)
    assert got == dict(want)


@few
@given(answers)
def test_stack_positions(spark, data):
    got = windows.stacked_positions(frame(spark, data), "c").collect()
    total = len(data)
    assert max(r["csum"] for r in got) == total
    for r in got:
        assert r["pos"] == r["csum"] - r["n"] / 2
        assert r["perc"] == pytest.approx(100 * r["n"] / total, abs=0.0501)
