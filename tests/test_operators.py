"""Operators against brute force on small rows."""

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from canvass.functions import text as t
from canvass.functions.local import local_table
from canvass.operators import aggregate as a
from canvass.operators import clean, joins, privacy, reshape, sets, windows


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_multiselect_keeps_empty_tokens_and_drops_missing(spark):
    df = local_table(spark, [(1, "a b"), (2, None), (3, "a  c"), (4, "")], "id int, `g/x` string")
    got = rows(reshape.multiselect_long(df, "g/x", ["id"], "x"))
    assert got == [(1, "a"), (1, "b"), (3, ""), (3, "a"), (3, "c"), (4, "")]


def test_long_forms(spark):
    df = local_table(spark, [(1, "x", None), (2, None, None)], "id int, `g/a` string, `g/b` string")
    assert rows(reshape.columns_long(df, ["g/a", "g/b"], "v", ["id"])) == [(1, "g/a", "x")]
    assert len(rows(reshape.columns_long(df, ["g/a", "g/b"], "v", ["id"], keep_null=True))) == 4
    labels = [("g/a", {"l": "A"}), ("g/a", {"l": "A2"}), ("g/b", {"l": "B"})]
    assert rows(reshape.labelled_long(df, labels, ["id"], "v")) == [(1, "A", "x"), (1, "A2", "x")]
    cells = [("g/a", "r", "c")]
    num = local_table(spark, [(1, "3.9"), (2, "x")], "id int, `g/a` string")
    assert rows(reshape.matrix_cells(num, cells, ["id"], "row", "col")) == [(1, "r", "c", 3), (2, "r", "c", None)]


def test_rename_block_follows_the_path(spark):
    df = local_table(spark, [(1, "x", "y")], "id int, `g/b` string, `g/a` string")
    out = reshape.rename_block(df, {"g/a": "first", "g/b": "second"}, ["id"])
    assert out.columns == ["id", "first", "second"] and rows(out) == [(1, "y", "x")]


@pytest.mark.parametrize("as_table", [False, True])
def test_complete_fills_only_gaps(spark, as_table):
    n = local_table(spark, [("r", "a", 2), ("s", "b", 1), (None, "a", 5), ("r", None, 7)], "g string, x string, n int")
    levels = local_table(spark, [("a",), ("b",), ("b",), (None,)], "z string") if as_table else ["a", "b"]
    got = rows(reshape.complete(n, ["g"], "x", levels))
    assert got == sorted([
        ("r", "a", 2), ("r", "b", 0), ("s", "a", 0), ("s", "b", 1), (None, "a", 5), (None, "b", 0), ("r", None, 7),
    ], key=repr)


def test_grid_and_chunks(spark):
    left = local_table(spark, [(i % 5,) for i in range(20)], "a int")
    right = local_table(spark, [(i, str(i)) for i in range(200)] * 2, "b int, c string")
    got = reshape.grid(left, right)
    assert got.columns == ["a", "b", "c"]
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, j, str(j)) for i in range(5) for j in range(200))


def test_presence_matrix_has_fixed_columns(spark):
    df = local_table(spark, [("g", "a"), ("g", "a"), ("h", "zz"), ("h", None)], "g string, x string")
    wide = reshape.presence_matrix(df, "g", "x", ["a", "new"])
    assert wide.columns == ["g", "a", "new"] and rows(wide) == [("g", 1, 0), ("h", 0, 0)]
    assert rows(reshape.matrix_long(wide, "g", ["a", "new"])) == [
        ("g", "a", 1, "✓"), ("g", "new", 0, "✗"), ("h", "a", 0, "✗"), ("h", "new", 0, "✗"),
    ]


def test_recode_variants(spark):
    df = local_table(spark, [(i, c) for i, c in enumerate(["a", "zz", None])], "id int, x string")
    small = {"a": "A"}
    large = {f"k{i}": f"v{i}" for i in range(133)} | small
    table = local_table(spark, large.items(), "name string, label string")
    for mapping in (small, large, table):
        assert rows(joins.recode(df, mapping, "x")) == [(0, "A"), (1, None), (2, None)]
    assert rows(joins.recode(df, {}, "x")) == [(0, None), (1, None), (2, None)]
    twice = local_table(spark, [("a", "A"), ("a", "B")], "name string, label string")
    with pytest.raises(joins.DuplicateKeys):
        joins.recode(df, twice, "x")


def test_other_text_two_ways(spark):
    df = local_table(
        spark, [(1, "a other", "t1"), (2, "a", "t2"), (3, "other", None), (4, None, "t4")], "id int, m string, t string"
    )
    options = reshape.multiselect_long(df, "m", ["id"], "x")
    joined = joins.attach_other(options, df, ["id"], "x", "other", "t", "text")
    direct = joins.multiselect_with_other(df, "m", "t", ["id"], "x", "text", "other")
    want = [(1, "a", None), (1, "other", "t1"), (2, "a", None), (3, "other", None)]
    assert rows(joined.select("id", "x", "text")) == rows(direct) == sorted(want, key=repr)


def test_regex_join_multiplies_and_drops(spark):
    df = local_table(spark, [(1, "m_weiblich_1"), (2, "none"), (3, None)], "id int, c string")
    patterns = {"weiblich_1": "w", "lich": "x", "m_": "m"}
    want = [(1, "m_weiblich_1", n, v) for n, v in sorted(patterns.items())]
    assert rows(joins.regex_join(df, patterns, "c")) == sorted(want, key=repr)
    for size in (0, 1, 1001):
        longer = {"none": "n", **{f"absent_{i}": str(i) for i in range(size)}} if size else {}
        want = [(2, "none", "none", "n")] if size else []
        table = local_table(spark, longer.items(), "name string, label string")
        assert rows(joins.regex_join(df, table, "c")) == rows(joins.regex_join(df, longer, "c")) == want


@pytest.mark.parametrize("size", [0, 1, 128, 129])
@pytest.mark.parametrize("null_safe", [False, True])
def test_recode_is_the_same_at_every_size(spark, size, null_safe):
    mapping = {**{str(i): f"l{i}" for i in range(size)}, None: "missing"}
    df = local_table(spark, [(1, 0), (2, 128), (3, None), (4, -5)], "id int, x int")
    want = [(1, "l0" if size else None), (2, "l128" if size == 129 else None), (3, "missing" if null_safe else None), (4, None)]
    table = local_table(spark, mapping.items(), "name string, label string")
    assert rows(joins.recode(df, mapping, "x", null_safe=null_safe)) == want
    assert rows(joins.recode(df, table, "x", null_safe=null_safe)) == want
    assert rows(joins.recode_all(df, {"x": mapping}, null_safe)) == want


def test_natural_and_suffixed_joins(spark):
    left = local_table(spark, [(1, "a", 5), (2, None, 6)], "id int, k string, v int")
    right = local_table(spark, [("a", 7), (None, 8)], "k string, v int")
    assert rows(joins.natural_join(left.drop("v"), right)) == [(1, "a", 7), (2, None, 8)]
    out = joins.suffixed_join(left, right, ["k"])
    assert out.columns == ["id", "k", "v", "v_lookup"] and rows(out) == [(1, "a", 5, 7), (2, None, 6, 8)]
    with pytest.raises(ValueError):
        joins.natural_join(left.select("id"), right)


def test_slice_region(spark):
    data = local_table(spark, [(1, "W"), (2, "N"), (3, None)], "id int, region_grouped string")
    long = local_table(spark, [(1, "x"), (1, "y"), (2, "z"), (9, "w")], "id int, v string")
    agg = local_table(spark, [("W", 5), ("N", 6)], "region_grouped string, n int")
    part = clean.slice_region(data, {"long": long, "agg": agg}, "W", ["id"])
    assert rows(part["data"]) == [(1, "W")]
    assert rows(part["long"]) == [(1, "x"), (1, "y")] and rows(part["agg"]) == [("W", 5)]


def test_clean_rows_and_columns(spark):
    df = local_table(
        spark, [(1, "u", "i", "s", "e", None), (2, "u", "i", "s", "e", "x")],
        "og_id int, _uuid string, `meta/instance` string, start string, end string, `g/a` string",
    )
    cut = clean.drop_system_columns(df)
    assert cut.columns == ["og_id", "g/a"]
    assert rows(clean.drop_empty_rows(cut, ["og_id"])) == [(2, "x")]
    assert clean.drop_system_columns(df, ("_",), ()).columns == ["og_id", "meta/instance", "start", "end", "g/a"]
    assert clean.add_missing_columns(cut, ["g/a", "g/b"]).columns == ["og_id", "g/a", "g/b"]
    assert clean.pick(df, ["g/a"]).columns == ["og_id", "g/a"]


def test_deadline_is_midnight_after_new_year(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, timestamp'2024-12-31 23:59:59'), (2, timestamp'2025-01-01 00:00:00'), (3, NULL) AS t(id, `end`)"
    )
    assert [r["id"] for r in clean.before_deadline(df, 2024).collect()] == [1]


def test_likert_and_shares(spark):
    df = local_table(spark, [("a", "4"), ("a", "3"), ("a", None), ("b", None), ("a", "6")], "q string, value string")
    got = {r["q"]: tuple(r)[1:] for r in a.likert_summary(df, "q").collect()}
    assert got["a"][0] == 3 and got["a"][2] == 2 and abs(got["a"][1] - 13 / 3) < 1e-12
    assert got["b"] == (0, None, 0, None)
    share = a.share(df, "q", a.all_rows(df))
    assert {r["q"]: r["share"] for r in share.collect()} == {"a": 0.8, "b": 0.2}
    ids = local_table(spark, [(1, "x"), (1, "y"), (2, "x")], "id int, o string")
    assert {r["o"]: r["share"] for r in a.share(ids, "o", a.respondents(ids, "id")).collect()} == {"x": 1.0, "y": 0.5}


def test_weighted_mean_uses_complete_pairs(spark):
    df = local_table(spark, [("a", 10.0, 2), ("a", None, 50), ("a", 20.0, None), ("a", 40.0, 1), ("b", None, 3)], "g string, v double, n int")
    got = {r["g"]: r["w"] for r in df.groupBy("g").agg(a.weighted_mean("v", "n").alias("w")).collect()}
    assert got == {"a": 20.0, "b": None}


def test_top_values(spark):
    df = local_table(spark, [("g", "x")] * 2 + [("g", "y")] * 2 + [("h", "z"), (None, "q")], "g string, v string")
    n = a.counts(df, ["g", "v"])
    assert rows(a.top_values(n, "g")) == sorted([("g", "x", 2), ("g", "y", 2), ("h", "z", 1), (None, "q", 1)], key=repr)
    assert rows(a.top_value(df, "v", ["g"])) == sorted([("g", "x", 2), ("h", "z", 1), (None, "q", 1)], key=repr)
    assert rows(a.top_value(df, "v")) == [("x", 2)]


def test_percent_by_year_is_strict(spark):
    df = local_table(spark, [(1, "a"), (1, "b"), (2, "a"), (2, None)], "year int, x string")
    got = {r["choice"]: (r["pct_1"], r["pct_2"], r["pct_3"]) for r in a.percent_by_year(df, "x", ["a", "c"], [1, 2, 3]).collect()}
    assert got == {"a": (50.0, None, None), "c": (0.0, None, None)}


def test_item_stats_against_statistics(spark):
    rng = random.Random(3)
    data = [(f"i{rng.randrange(4)}", rng.choice([None, 0, 1, 2, 3])) for _ in range(500)]
    got = {r["q"]: r for r in a.item_stats(local_table(spark, data, "q string, v int"), ["q"], "v").collect()}
    for q in {q for q, _ in data}:
        known = [v for k, v in data if k == q and v is not None]
        assert got[q]["median_bedarf"] == statistics.median(known)
        assert abs(got[q]["bedarf_mean"] - statistics.mean(known)) < 1e-12
        assert abs(got[q]["sd"] - statistics.stdev(known)) < 1e-9
        assert got[q]["range"] == max(known) - min(known)


def test_shares_of_a_group_sum_to_one(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, "a", "b"]), rng.randrange(6)) for _ in range(300)]
    df = a.distribution_within(local_table(spark, data, "g string, v int"), ["g"], "v")
    for r in df.groupBy("g").agg(F.sum("percent").alias("s"), F.sum("n").alias("n")).collect():
        assert abs(r["s"] - 1) < 1e-12 and r["n"] == sum(g == r["g"] for g, _ in data)


def test_add_count_keeps_rows(spark):
    df = local_table(spark, [(1, "a"), (2, "a"), (3, None)], "id int, g string")
    assert rows(a.add_count(df, "g")) == [(1, "a", 2), (2, "a", 2), (3, None, 1)]


def test_stacked_positions_brute_force(spark):
    data = ["a"] * 5 + ["b"] * 2 + ["c"] * 9 + [None]
    got = {r["x"]: tuple(r)[1:] for r in windows.stacked_positions(local_table(spark, [(d,) for d in data], "x string"), "x").collect()}
    assert got == {
        "a": (5, 17, round(500 / 17, 1), 2.5 + 12), "b": (2, 12, round(200 / 17, 1), 1 + 10),
        "c": (9, 10, round(900 / 17, 1), 4.5 + 1), None: (1, 1, round(100 / 17, 1), 0.5),
    }


def test_stack_order_and_year_chart(spark):
    df = local_table(spark, [(1, "a", 2), (1, "b", 2), (2, "b", 1)], "year int, x string, n bigint")
    got = rows(windows.year_chart(df, "year", "n", "x"))
    assert got == [(1, "a", 2, 1, 1), (1, "b", 2, 1, 2), (2, "a", 0, 1, 1), (2, "b", 1, 2, 2)]
    with pytest.raises(ValueError, match="Missing columns: m"):
        windows.year_chart(df, "year", "m")


def test_rank_levels(spark):
    df = local_table(spark, [("a", 1), ("b", 5), ("c", 5), ("a", 1)], "x string, n int")
    assert rows(windows.rank_levels(df, "x", "n").select("x", "total", "rank")) == [("a", 2, 3), ("b", 5, 1), ("c", 5, 2)]


def test_dedup_first(spark):
    df = local_table(spark, [("a", 3), ("a", 1), (None, 0), ("b", 2)], "k string, t int")
    assert rows(windows.dedup_first(df, "k", ["t"])) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_marker_blocks_brute_force(spark, chunk):
    rng = random.Random(11)
    data = [(f, o, rng.choice(["begin", "end", "q", "q", "q"])) for f in ("x", "y") for o in range(60)]
    want = set()
    for form in ("x", "y"):
        state = None
        for f, o, kind in data:
            if f != form:
                continue
            if kind == "begin":
                state = o
            elif kind == "end":
                state = None
            elif state is not None:
                want.add((f, o, state))
    df = local_table(spark, data, "f string, o int, kind string")
    got = windows.marker_blocks(
        df, ["f"], "o", F.col("kind") == "begin", F.col("kind") == "end", F.col("o"), chunk=chunk
    )
    assert {(r["f"], r["o"], r["block"]) for r in got.collect()} == want


def test_delink(spark):
    data = [(i, f"v{i % 7}") for i in range(500)]
    df = local_table(spark, data, "id int, x string")
    out = privacy.released(df, "x", ["id"], "5")
    assert out.columns == ["x"]
    values = [r["x"] for r in out.collect()]
    assert Counter(values) == Counter(x for _, x in data) and values != [x for _, x in data]
    # the same secret gives the same order however the rows arrive
    again = privacy.released(df.repartition(5, "x"), "x", ["id"], "5")
    assert [r["x"] for r in again.collect()] == values
    assert [r["x"] for r in privacy.delink(df, "x", ["id"]).collect()] != values


def test_suppression(spark):
    df = local_table(spark, [("a", 1)] * 2 + [("b", 1)] * 3 + [("c", None)] * 4, "g string, v int")
    got = {r["g"]: (r["avg"], r["n"]) for r in a.group_mean_suppressed(df, "g", "v").collect()}
    assert got == {"a": (None, 2), "b": (1.0, 3), "c": (None, 4)}


def test_sets(spark):
    x = local_table(spark, [(1, "a"), (2, None)], "id int, k string")
    y = local_table(spark, [("b", 1.5)], "k string, z double")
    assert rows(sets.union_all([x, y])) == sorted([(1, "a", None), (2, None, None), (None, "b", 1.5)], key=repr)
    assert [r[0] for r in sets.level_union([x, y], "k").collect()] == ["a", "b"]
    assert [r[0] for r in sets.level_difference(x.dropna(), y, "k").collect()] == ["a"]


def test_text(spark):
    df = local_table(
        spark,
        [("Sing-Kreis Nord", "a/b/Montag_stunden", "andere_person", "selected(${Q}, 'flyer')", "stimmt (1)", "x___y"),
         (" SINGKREIS ", "dienstag", "x", None, "(6) nicht am Ende", "x_y")],
        "name string, path string, code string, rule string, label string, raw string",
    )
    got = [tuple(r) for r in df.select(
        t.without_words("name", ["singkreis", "sing-kreis"]), t.weekday_name("path"), t.spoken_code("code"),
        t.option_of_rule("rule"), t.swap_scale_ends("label"), t.plain_code("raw"),
    ).collect()]
    assert got == [
        ("Nord", "Montag", "Andere Person", "flyer", "stimmt (6)", "x_y"),
        ("", "Dienstag", "X", "insgesamt", "(6) nicht am Ende", "x_y"),
    ]
    blank = local_table(spark, [("\u00a0 Nord\u3000\t",), ("  ",), (None,)], "x string")
    assert [r[0] for r in blank.select(t.trimmed("x")).collect()] == ["Nord", "", None]
    q = local_table(spark, [('Bei uns gilt auf einer Skala von "Alle" bis "Keiner":',)], "label string")
    assert q.select(t.scale_label("label", "Bei uns gilt auf einer Skala")).collect()[0][0] == "  Alle SEP Keiner"
    n = local_table(spark, [(1234567, 0.1234), (12, 0.5)], "n int, p double")
    assert [tuple(r) for r in n.select(t.dotted_number("n"), t.comma_percent("p")).collect()] == [
        ("1.234.567", "12,3%"), ("12", "50,0%"),
    ]
    assert t.without_number_suffix("a/Teilnehmende_002") == "a/Teilnehmende"
