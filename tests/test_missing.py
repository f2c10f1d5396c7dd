"""Missing-value rules."""

from pyspark.sql import functions as F

from canvass.functions import missing as m
from canvass.functions.local import local_table
from canvass.operators import joins, windows
from canvass.operators.aggregate import item_stats, need_bands


def one(df):
    return tuple(df.collect()[0])


def test_strict_aggregates_need_every_value(spark):
    known = local_table(spark, [(1,), (2,)], "x int")
    gap = local_table(spark, [(1,), (None,)], "x int")
    aggs = [m.strict_sum("x"), m.strict_mean("x"), m.strict_max("x"), m.sum_or_zero("x")]
    assert one(known.agg(*aggs)) == (3, 1.5, 2, 3)
    assert one(gap.agg(*aggs)) == (None, None, None, 1)


def test_sum_of_nothing_is_zero(spark):
    empty = local_table(spark, [], "x int")
    none = local_table(spark, [(None,)], "x int")
    assert one(empty.agg(m.strict_sum("x"), m.sum_or_zero("x"), F.avg("x"))) == (0, 0, None)
    assert one(none.agg(m.strict_sum("x"), m.sum_or_zero("x"), F.avg("x"))) == (None, 0, None)


def test_any_is_three_valued(spark):
    rows = [("t", True), ("t", None), ("u", False), ("u", None), ("f", False), ("f", False)]
    df = local_table(spark, rows, "k string, x boolean")
    got = {r["k"]: r["a"] for r in df.groupBy("k").agg(m.any3(F.col("x")).alias("a")).collect()}
    assert got == {"t": True, "u": None, "f": False}


def test_missing_counts_as_a_value(spark):
    df = local_table(spark, [("a",), ("a",), (None,), (None,)], "x string")
    assert one(df.agg(m.n_distinct("x"))) == (2,)
    assert one(df.filter("x IS NOT NULL").agg(m.n_distinct("x"))) == (1,)
    assert one(df.filter("x = 'none'").agg(m.n_distinct("x"))) == (0,)


def test_casts_cut_decimals_and_reject_text(spark):
    texts = ["2.7", " 3 ", "-1.9", "1e2", "", "x", "3d", "4f", "NaN", "inf", "Infinity", None, "1,5", "1e400", "-1e400"]
    df = local_table(spark, [(t,) for t in texts], "x string")
    got = [(r[0], r[1]) for r in df.select(m.to_int("x"), m.to_double("x")).collect()]
    assert got == [
        (2, 2.7), (3, 3.0), (-1, -1.9), (100, 100.0), *[(None, None)] * 11,
    ]


def test_outliers(spark):
    df = local_table(spark, [(39.5,), (40.0,), (99.0,), (100.0,), (None,)], "x double")
    got = [tuple(r) for r in df.select(m.keep_below("x", 40), m.drop_above("x", 99)).collect()]
    assert got == [(39.5, 39.5), (None, 40.0), (None, 99.0), (None, None), (None, None)]


def test_no_answer_category(spark):
    df = local_table(spark, [("a",), (None,), ("keine Angabe",), ("",)], "x string")
    assert [r[0] for r in df.select(m.no_answer("x")).collect()] == ["a", "keine Angabe", "keine Angabe", ""]
    assert [r[0] for r in df.filter(m.answered("x")).collect()] == ["a", ""]
    assert [r[0] for r in df.select(m.empty_to_null("x")).collect()] == ["a", None, "keine Angabe", None]
    assert [r[0] for r in df.select(m.yes("x", "a")).collect()] == [True, False, False, False]


def test_null_keys_in_joins(spark):
    left = local_table(spark, [(1, "a"), (2, None), (3, "c")], "id int, k string")
    dim = local_table(spark, [("a", "A"), (None, "none")], "k string, label string")
    safe = {r["id"]: r["label"] for r in joins.lookup(left, dim, "k", null_safe=True).collect()}
    plain = {r["id"]: r["label"] for r in joins.lookup(left, dim, "k").collect()}
    assert safe == {1: "A", 2: "none", 3: None}
    assert plain == {1: "A", 2: None, 3: None}


def test_anti_join_keeps_null_unless_null_is_known(spark):
    left = local_table(spark, [("a",), (None,), ("c",)], "k string")
    known = local_table(spark, [("a",)], "k string")
    with_null = local_table(spark, [("a",), (None,)], "k string")
    assert {r[0] for r in joins.drop_known(left, known, "k").collect()} == {None, "c"}
    assert {r[0] for r in joins.drop_known(left, with_null, "k").collect()} == {"c"}
    assert {r[0] for r in joins.drop_known(left, with_null, "k", null_known=False).collect()} == {None, "c"}


def test_half_rounds_to_even(spark):
    df = local_table(spark, [("a", 2), ("a", 3), ("a", 2), ("a", 3), ("b", 3), ("b", 4), ("b", 3), ("b", 4)], "g string, x int")
    from canvass.operators.aggregate import group_mean_suppressed

    got = {r["g"]: r["avg"] for r in group_mean_suppressed(df, "g", "x").collect()}
    assert got == {"a": 2.0, "b": 4.0}


def test_sorting_puts_missing_last(spark):
    from canvass.operators.sets import sorted_nulls_last

    df = local_table(spark, [(None, 1), ("b", 2), ("a", None), ("a", 3)], "x string, y int")
    assert [tuple(r) for r in sorted_nulls_last(df, ["x", "y"]).collect()] == [("a", 3), ("a", None), ("b", 2), (None, 1)]


def test_stats_of_unanswered_item(spark):
    df = local_table(spark, [("a", 0), ("a", 3), ("b", None), ("c", 0), ("d", 1), ("d", None)], "bedarf string, v int")
    got = {r["bedarf"]: r for r in need_bands(item_stats(df, ["bedarf"], "v")).collect()}
    assert (got["a"]["median_bedarf"], got["a"]["bedarf_mean"], got["a"]["range"]) == (1.5, 1.5, 3)
    assert abs(got["a"]["sd"] - 4.5**0.5) < 1e-12
    assert (got["a"]["bedarf_label"], got["a"]["sd_label"]) == ("mittel", "variierend")
    assert got["b"]["bedarf_mean"] is None and got["b"]["erklaerung"] == "Nicht genug Informationen *"
    # the first band is open at 0, the spread band is closed there
    assert (got["c"]["bedarf_label"], got["c"]["sd_label"]) == (None, "konstant")
    assert got["d"]["sd"] is None and got["d"]["bedarf_label"] == "gering"


def test_unlisted_levels_count_as_missing(spark):
    df = local_table(spark, [("a",), ("z",), (None,)], "x string")
    got = {r["x"]: (r["n"], r["csum"]) for r in windows.stacked_positions(df, "x", levels=["a", "b"]).collect()}
    assert got == {"a": (1, 3), None: (2, 2)}


def test_stack_with_an_unknown_count(spark):
    df = local_table(spark, [("a", 4), ("b", None), ("c", 2)], "x string, n int")
    got = {r["x"]: (r["csum"], r["perc"], r["pos"]) for r in windows.positions_of_counts(df, "x").collect()}
    assert got == {"a": (None, None, 2.0), "b": (None, None, None), "c": (2, None, 1.0)}
