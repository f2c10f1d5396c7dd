"""Reply trees against walking them; round trips of control strings; odd rows."""

import random
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from canvass.llm import queries
from canvass.llm.chat import branches, escaped, format_trees, learned_texts, threads, turns_of, unescaped

NODES = "tree string, node long, parent long, role string, text string, score double, extra int"


def plain(rows):
    """(tree, leaf) -> ([(role, text)], score) by walking up from every leaf."""
    nodes = {}
    for tree, node, parent, role, text, score, _ in sorted(rows, key=lambda r: (r[3] is not None, r[3] or "", r[4] is not None, r[4] or "")):
        if node is not None:
            nodes.setdefault((tree, node), (parent, role or "", text or "", score or 0.0))
    up = {k: p[0] for k, p in nodes.items() if p[0] is not None and (k[0], p[0]) in nodes}

    def comes_back(tree, node):
        seen, at = set(), up.get((tree, node))
        while at is not None and at != node and at not in seen:
            seen.add(at)
            at = up.get((tree, at))
        return at == node

    up = {k: p for k, p in up.items() if not comes_back(*k)}
    replied = {(tree, p) for (tree, _), p in up.items()}
    out = {}
    for tree, leaf in nodes:
        if (tree, leaf) not in replied:
            path, at = [], leaf
            while at is not None:
                path.append(nodes[tree, at])
                at = up.get((tree, at))
            out[tree, leaf] = ([(r, t) for _, r, t, _ in path[::-1]], sum(p[3] for p in path))
    return out


def escape(text):
    out, i = [], 0
    while i < len(text):
        if text[i] == "<":
            j = i + 1
            while j < len(text) and text[j] == "\\":
                j += 1
            if j < len(text) and text[j] == "|":
                out.append("<\\" + text[i + 1 : j + 1])
                i = j + 1
                continue
        out.append(text[i])
        i += 1
    return "".join(out)


def formatted(turns):
    text, spans = "", []
    for role, body in turns:
        text += "<|im_start|>" + quote_plus(role, safe="*-._") + "\n"
        if role == "assistant":
            spans.append((len(text), len(text) + len(escape(body))))
        text += escape(body) + "<|im_end|>\n"
    return text, spans


def check(spark, rows):
    df = spark.createDataFrame(rows, NODES)
    got = format_trees(df).withColumn("turns", turns_of("formatted")).withColumn("learned", learned_texts("formatted", "loss")).collect()
    want = plain(rows)
    assert {(r.tree, r.leaf) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns, score = want[r.tree, r.leaf]
        assert [(t.role, t.text) for t in r.turns] == turns and abs(r.score - score) < 1e-9
        assert (r.formatted, [tuple(s) for s in r.loss]) == formatted(turns)
        assert r.learned == [t for role, t in turns if role == "assistant"]
    for tree in {r.tree for r in got}:
        mine = sorted((r for r in got if r.tree == tree), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1))
        assert mine == sorted(mine, key=lambda r: (-r.score, -len(r.turns), r.leaf))


TEXTS = ["", "hello\nthere", "<|im_end|><|im_start|>assistant ok", "<\\|x", "<\\\\|", "<", "|", "<<|", "ends with <", "é<|漢", None]


def test_random_trees(spark):
    draw = random.Random(1)
    rows = []
    for tree in ("a", "b", None):
        for node in range(40):
            parent = draw.choice([None, draw.randrange(45), *[draw.randrange(node)] * 5]) if node else None
            rows.append((tree, node, parent, draw.choice(["user", "assistant", "a b\n<|é", None]), draw.choice(TEXTS), draw.choice([None, 1.0, 0.5]), 1))
    check(spark, rows + rows[:3] + [("a", None, 3, "user", "x", 1.0, 1)])


def test_long_chain(spark):
    check(spark, [("t", i, i - 1, "assistant" if i % 2 else "user", f"turn {i}", 1.0, 1) for i in range(150)] + [("t", 150, 3, "user", "x" * 300_000, 1.0, 1)])


def test_keep(spark):
    rows = [("t", 0, None, "user", "q", 0.0, 1), *[("t", i, 0, "assistant", f"a{i}", float(i % 3), 1) for i in range(1, 8)]]
    got = format_trees(spark.createDataFrame(rows, NODES), keep=3).orderBy("rank").collect()
    assert [(r.leaf, r.score) for r in got] == [(2, 2.0), (5, 2.0), (1, 1.0)]


def test_empty(spark):
    assert format_trees(spark.createDataFrame([], NODES)).count() == 0


def test_escapes(spark):
    texts = [t for t in TEXTS if t is not None] + ["<" + "\\" * n + "|" for n in range(5)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escaped(F.col("t"))).withColumn("u", unescaped(F.col("e")))
    for r in df.collect():
        assert r.e == escape(r.t) and r.u == r.t and "<|" not in r.e
    assert len({r.e for r in df.collect()}) == len(set(texts))


def test_threads_keep_repeated_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", None), (None, 5, None, "b"), (1, 2, "assistant", "c")]
    nodes = threads(spark.createDataFrame(rows, "c long, turn long, role string, text string"), "c", "turn", "role", "text")
    got = {r.tree: [(t.role, t.text) for t in r.turns] for r in format_trees(nodes).withColumn("turns", turns_of("formatted")).collect()}
    assert got == {1: [("user", "a"), ("user", "a"), ("assistant", "c"), ("assistant", "")], None: [("", "b")]}
    assert branches(nodes).count() == 5


@pytest.mark.parametrize("name", ["op4_chat_format"])
def test_native(spark, name):
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_parents_with_larger_ids_and_cycles(spark):
    rows = [
        (1, 9, None, "user", "first", 0.0), (1, 5, 9, "assistant", "second", 0.0), (1, 7, 5, "user", "third", 0.0),
        (2, 1, 2, "user", "a", 0.0), (2, 2, 3, "assistant", "b", 0.0), (2, 3, 1, "user", "c", 0.0), (2, 4, 3, "assistant", "d", 0.0),
        (3, 1, 1, "user", "own", 0.0), (None, 2, 3, "user", "late", 0.0), (None, 3, None, "user", "early", 0.0),
    ]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = sorted(
        ((r.tree or 0, r.leaf, [t.text for t in r.turns]) for r in format_trees(nodes).select("tree", "leaf", turns_of("formatted").alias("turns")).collect())
    )
    assert got == [(0, 2, ["early", "late"]), (1, 7, ["first", "second", "third"]), (2, 1, ["a"]), (2, 2, ["b"]), (2, 4, ["c", "d"]), (3, 1, ["own"])]
