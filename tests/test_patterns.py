"""Pattern tables, name proposals and totals that withhold cells, against plain code."""

import itertools
import random
import re

import pytest
from canvass.functions.local import local_table
from canvass.operators import joins, patterns, privacy
from canvass.operators.proposals import propose
from pyspark.sql import functions as F

# every kind of syntax that may hide, repeat or drop characters
ODD = [
    "abc", "^abc", "abc$", "abcd?", "abc*", "(abc)?def", "(?:abc)+", "a{0,2}bcd", "abc|bcd", "abc|b", "(abc|cde)f", "[abc]cd.fg", r"a\.bc",
    r"\Qabc\E", "(?i)ABC", "(?=abc)a", r"abc\d", r"\x61bc", r"abcd\x3f?", "[]a]bcd", "[^]x]bcd", "[a[bc]]bcd", "((((((abc))))))", "((abc)(d)?)+efg", "abcd+e",
    "abc{2}", "", "a", r"\babc\b", "a.c", "abc.*def", "äöüß", "😀ab", "abc?+def", r"bcd\|abc", "x||abc", r"\(abc\)", "abc()def", r"(abc)\1",
    "a b c", "abc\nd", "abcde??f", "ab{1,}cde", r"\p{Alpha}bcd", r"abc\\def", "abc😀?def",
]


def texts(seed, n=150):
    rnd = random.Random(seed)
    pieces = ["abc", "bcd", "def", "c", "cd", "ccc", "efg", "?", "|", "(", ")", "\\", ".", "ä", "öüß", "😀ab", "ABC", " ", "a b c", "\n", "cde", "f", "bb", "d", "1"]
    return [None, "", "abc", "abc"] + ["".join(rnd.choices(pieces, k=rnd.randint(1, 8))) for _ in range(n)]


def test_odd_patterns_find_what_testing_every_row_finds(spark):
    df = local_table(spark, list(enumerate(texts(1))), "id int, c string")
    table = local_table(spark, [(p, str(i)) for i, p in enumerate(ODD)] + [("abc", "twice"), (None, "none")], "name string, label string")
    want = sorted(
        (r["id"], p, v) for p, v in [(p, str(i)) for i, p in enumerate(ODD)] + [("abc", "twice")]
        for r in df.filter(F.col("c").rlike(p)).collect()
    )
    got = sorted((r["id"], r["name"], r["label"]) for r in joins.regex_join(df, table, "c").collect())
    assert got == want
    assert {p for _, p, _ in got} >= {"", "a", "abc|b", "(?i)ABC", "😀ab", r"\Qabc\E"}


def test_pieces_hold_nothing_a_match_may_lack(spark):
    table = local_table(spark, [(p,) for p in ODD], "p string")
    got = {r["p"]: r["x"] for r in table.select("p", patterns.literal_pieces(F.col("p")).alias("x")).collect()}
    for p in ("(?i)ABC", r"\Qabc\E", "(?=abc)a", "((((((abc))))))"):
        assert got[p] is None
    assert "abc" in got["abc.*def"][0] and "def" in got["abc.*def"][0]
    assert got["abc|bcd"] == [["abc"], ["bcd"]]
    assert not any("d" in x for x in got["abcd?"][0]) and not any("c" in x for x in got["abc*"][0])


def test_many_patterns_give_few_candidates(spark):
    rnd = random.Random(2)
    word = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(50_000)]
    table = local_table(spark, [(f"^.*{w[:5]}[a-z]?{w[6:]}", w) for w in word], "name string, label string")
    rows = [(i, f"column/{word[i]}/{word[i + 1]}") for i in range(0, 4000, 2)]
    df = local_table(spark, rows, "id int, c string")
    assert patterns.candidates(df, table, "c").count() < 40 * len(rows)  # of 100 million pairs
    got = {(r["id"], r["label"]) for r in joins.regex_join(df, table, "c").collect()}
    assert got >= {(i, word[i + k]) for i in range(0, 4000, 2) for k in (0, 1)}
    tests = [re.compile(f"^.*{w[:5]}[a-z]?{w[6:]}") for w in word]
    for i, c in rows[:3]:
        assert {v for j, v in got if j == i} == {w for w, t in zip(word, tests) if t.search(c)}


def test_run_of_all_patterns_and_texts_is_spread(spark):
    df = local_table(spark, [(i, f"needle {i}") for i in range(400)], "id int, c string")
    table = local_table(spark, [(f"^needle [0-9]+$|zzzz{i}", str(i)) for i in range(50)], "name string, label string")
    found = joins.regex_join(df, table, "c")
    assert found.count() == found.distinct().count() == 400 * 50
    plan = patterns.candidates(df, table, "c")._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner" in line and "_run#" in line and "_part#" in line for line in plan.splitlines())


def test_candidates_hold_a_whole_piece_and_grow_with_the_rows(spark):
    """Numbers share their runs of three digits; a text meets the patterns of its own number, not all of those of a run."""
    df = local_table(spark, [(i, f"http://x/en/{i}/") for i in range(10_000, 12_000)], "id int, c string")
    table = local_table(spark, [(f"x/[a-z]+/{i}($|/)", str(i)) for i in range(10_000, 12_000)], "name string, label string")
    assert patterns.candidates(df, table, "c").count() == 2_000
    assert {(r["id"], r["label"]) for r in joins.regex_join(df, table, "c").collect()} == {(i, str(i)) for i in range(10_000, 12_000)}


def test_parts_pair_each_text_and_pattern_once(spark, monkeypatch):
    monkeypatch.setattr(patterns, "TEXTS", 3)
    monkeypatch.setattr(patterns, "PATTERNS", 2)
    words = ["needle", "haystack", "a literal that is longer than a key", "😀😀😀ä"]
    rows = [(i, " ".join(w for k, w in enumerate(words) if i >> k & 1)) for i in range(16)] + [(16, "needle"), (16, "needle")]
    df = local_table(spark, rows, "id int, c string")
    given = [("|".join(w for k, w in enumerate(words) if i >> k & 1), str(i)) for i in range(1, 16)] + [("needle|xneedle", "a"), ("needle|xneedle", None)]
    table = local_table(spark, given, "name string, label string")
    want = sorted((i, p, str(v)) for i, c in rows for p, v in given if re.search(p, c))
    got = joins.regex_join(df, table, "c")
    assert sorted((r["id"], r["name"], str(r["label"])) for r in got.collect()) == want
    pairs = patterns.candidates(df, table, "c")
    assert pairs.count() == len({(c, p) for i, c in rows for p, _ in given if re.search(p, c)})


def test_long_and_repeated_texts_and_no_rows(spark):
    long = "ab" * 200_000 + "needle"
    df = local_table(spark, [(1, long), (1, long), (2, "needle")], "id int, name string")
    table = local_table(spark, [("needle$", "x"), ("b{3}", "y")], "p string, l string")
    got = joins.regex_join(df, table, "name", "p", "l")
    assert sorted((r["id"], r["l"]) for r in got.select("id", "l").collect()) == [(1, "x"), (1, "x"), (2, "x")]
    for left, right in ((df.limit(0), table), (df, table.limit(0))):
        assert joins.regex_join(left, right, "name", "p", "l").count() == 0


def test_too_many_patterns_without_literals_are_an_error(spark):
    df = local_table(spark, [("aa",)], "c string")
    table = local_table(spark, [(f"a{i % 10}?", str(i)) for i in range(11)], "name string, label string")
    assert patterns.matches(df, table, "c", open_limit=11).count() == 11
    with pytest.raises(Exception, match="no literal text"):
        patterns.matches(df, table, "c", open_limit=10).collect()


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_proposals_are_those_of_all_pairs(spark, distance):
    rnd = random.Random(distance)
    known = ["", "a", "ab", "München", "Münster", "Bad 😀 Ems", "x" * 400] + ["".join(rnd.choices("abc", k=rnd.randint(1, 9))) for _ in range(60)]
    asked = ["", "Munchen", "Bad Ems", "x" * 398 + "yx", "zzzzzzzzzzzz"] + ["".join(rnd.choices("abc", k=rnd.randint(1, 9))) for _ in range(60)]
    names = local_table(spark, [(n, i) for i, n in enumerate(dict.fromkeys(asked))] + [(None, -1)], "raw string, n int")
    table = local_table(spark, [(k,) for k in known + known[:3]] + [(None,)], "og_name string")
    got = {}
    for r in propose(names, table, "raw", "og_name", distance).collect():
        got.setdefault(r["raw"], []).append((r["rank"], r["distance"], r["proposal"]))
    for name in [*dict.fromkeys(asked), None]:
        near = sorted((edits(name, k), k) for k in set(known) if abs(len(name) - len(k)) <= distance and edits(name, k) <= distance) if name is not None else []
        want = [(i, d, k) for i, (d, k) in enumerate(near, 1)] or [(None, None, None)]
        assert sorted(got[name], key=lambda t: t[0] or 0) == want


def totals_of(spark, cells, k=3):
    df = local_table(spark, [("t", r, c, n) for (r, c), n in cells.items()], "t string, r string, c string, n long")
    return privacy.protected_totals(df, ["t"], "r", "c", k=k).collect()


def reckoned(cells, out):
    """Withheld cells that have one value in all tables of counts that fit what is released (counts moved by one at most)."""
    free = sorted({(x["r"], x["c"]) for x in out if x["withheld"] and x["r"] and x["c"]})
    released = [(x["r"], x["c"]) for x in out if not x["withheld"]]
    hidden = {(x["r"], x["c"]) for x in out if x["withheld"]}
    moved = set()
    for moves in itertools.product((-1, 0, 1), repeat=len(free)):
        by = dict(zip(free, moves))
        if any(cells.get(p, 0) + m < 0 for p, m in by.items()):
            continue

        def change(r, c):
            return sum(m for (x, y), m in by.items() if r in (None, x) and c in (None, y))

        if all(change(r, c) == 0 for r, c in released if r is None or c is None):
            moved |= {p for p in hidden if change(*p) != 0}
    return hidden - moved


@pytest.mark.parametrize("seed", range(6))
def test_no_withheld_cell_can_be_reckoned(spark, seed):
    rnd = random.Random(seed)
    places = [(r, c) for r in "xyz" for c in "pqr"]
    cells = {p: rnd.choice([0, 1, 2, 4, 7, 12]) if rnd.random() < 0.4 else rnd.randint(5, 30) for p in places if rnd.random() < 0.9}
    out = totals_of(spark, cells)
    assert {(x["r"], x["c"]) for x in out} >= set(cells) | {(None, None)}
    for x in out:
        n = sum(v for (r, c), v in cells.items() if x["r"] in (None, r) and x["c"] in (None, c))
        assert x["released"] == (None if x["withheld"] else n)
        assert (x["withheld"] == "small") == (n < 3 and (x["withheld"] != "companion"))
        assert x["row_total"] == (x["c"] is None) and x["column_total"] == (x["r"] is None)
    assert reckoned(cells, out) == set()


@pytest.mark.parametrize("cells", [
    {("x", "p"): 1}, {("x", "p"): 1, ("x", "q"): 9, ("y", "q"): 8}, {("x", "p"): 1, ("x", "q"): 0, ("y", "p"): 8, ("y", "q"): 0},
    {("x", "p"): 1, ("x", "q"): 1, ("y", "p"): 8, ("y", "q"): 9, ("z", "q"): 7},
    {("x", "p"): 0, ("y", "p"): 0, ("x", "q"): 20, ("y", "q"): 30},
])
def test_sparse_tables(spark, cells):
    assert reckoned(cells, totals_of(spark, cells)) == set()


def test_nothing_small_nothing_withheld(spark):
    out = totals_of(spark, {("x", "p"): 5, ("x", "q"): 6, ("y", "p"): 7})
    assert {x["withheld"] for x in out} == {None} and len(out) == 8
    assert privacy.protected_totals(local_table(spark, [], "r string, c string, n long"), [], "r", "c").filter("r is not null").count() == 0
    one = local_table(spark, [("x", "p", 1), (None, "p", 50)], "r string, c string, n long")
    assert {(x["r"], x["c"], x["withheld"]) for x in privacy.protected_totals(one, [], "r", "c").collect()} == {
        ("x", "p", "small"), ("x", None, "small"), (None, "p", "small"), (None, None, "small")
    }
