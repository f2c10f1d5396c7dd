"""Jaccard join against comparing all pairs; odd rows; components."""

import random
import re

import numpy as np
import pytest

from canvass.llm import jaccard
from canvass.llm.graph import components
from canvass.llm.jaccard import Shingler, Threshold, Unit, class_key, keep_one_of_each, packs, similar_rows

SCHEMA = "doc_id long, text string, lang string, key string, n int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size, part, whole):
    """Smallest id reachable for each row."""
    sets = [shingles(r[1], size) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and group[i] != group[j] and whole * len(a & b) >= part * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return [(r[0], len(s), least.get(g)) for r, s, g in zip(rows, sets, group)]


def corpus(seed, families=12, copies=9):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(draw.choice(vocabulary) for _ in range(30))
    rows = []
    for _ in range(families):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([3, 5, 40, 120]))]
        for _ in range(draw.randrange(1, copies)):
            words = list(base)
            for _ in range(draw.randrange(0, 4)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            text = draw.choice([" ", "\n", " \t "]).join(words)
            rows.append((draw.randrange(10**6), draw.choice([text, text.upper(), text + " " + passage]), "x", "k", 1))
    return rows


ODD = [
    (1, None, "x", "k", 1), (2, "", "x", None, 1), (3, " \n\t", None, "k", 1), (4, "one", "x", "k", 1), (5, "One", "x", "k", 1),
    (6, "one two", "x", "k", None), (7, "two one", "x", "k", 1), (8, "one two", "x", "k", 1), (9, "É é", "x", "k", 1),
    (10, "é é", "x", "k", 1), (None, "one", "x", "k", 1), (None, "a lonely text without any number", "x", "k", 1),
    (11, "a b c d e f g h i j k l m n o p", "x", "k", 1), (11, "a b c d e f g h i j k l m n o p", "x", "k", 1),
]


def got(df, **settings):
    key = lambda r: tuple((v is None, v) for v in r)
    return sorted(((r.id, r.n, r.component_id) for r in similar_rows(df, **settings).collect()), key=key)


@pytest.mark.parametrize("size, part", [(4, 85), (5, 80)])
def test_against_all_pairs(spark, size, part):
    rows = corpus(size) + ODD
    key = lambda r: tuple((v is None, v) for v in r)
    want = sorted(brute(rows, size, part, 100), key=key)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), size=size, part=part, whole=100) == want


def test_small_blocks(spark, monkeypatch):
    """One large group in many blocks."""
    rows = corpus(3, families=1, copies=2) + [
        (100 + i, " ".join(f"v{(k * 7 + (i if k == i else 0)) % 999}" for k in range(60)), "x", "k", 1) for i in range(60)
    ]
    monkeypatch.setattr(jaccard, "BLOCK", 2000)
    key = lambda r: tuple((v is None, v) for v in r)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4), size=4, part=85, whole=100) == sorted(brute(rows, 4, 85, 100), key=key)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert similar_rows(df).count() == 0 and keep_one_of_each(df).count() == 0


def test_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(60000))
    rows = [(1, long, "x", "k", 1), (2, long + " more", "x", "k", 1), (3, "short text here", "x", "k", 1)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == [(1, 59997, 1), (2, 59998, 1), (3, 1, 3)]


def test_keep_one(spark):
    rows = corpus(8) + ODD
    df = spark.createDataFrame(rows, SCHEMA)
    kept = keep_one_of_each(df)
    assert kept.schema == df.schema
    left = kept.collect()
    components_of = brute(rows, 5, 80, 100)
    with_words = {c for (i, n, c) in components_of if n}
    assert len(left) == len([1 for i, n, c in components_of if not n]) + len(with_words)
    ids = {r.doc_id for r in left if shingles(r.text, 5)}
    assert ids == with_words


def test_unit_keeps_links_under_every_order():
    draw = random.Random(5)
    sets = [np.unique(np.array(draw.sample(range(1, 120), draw.randrange(60, 100)), np.uint64)) for _ in range(60)]
    sets = sorted(sets, key=len)
    for part in (50, 60, 75):
        unit = Unit(sets, np.zeros(len(sets), bool), Threshold(part, 100))
        group = list(range(len(sets)))
        for i, j in unit.links():
            group = [group[j] if g == group[i] else g for g in group]
        want = list(range(len(sets)))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                common = len(np.intersect1d(a, b))
                if 100 * common >= part * (len(a) + len(b) - common):
                    want = [want[j] if g == want[i] else g for g in want]
        same = lambda g: [[x == y for x in g] for y in g]
        assert same(group) == same(want)


def test_packs_hold_every_shingle_once():
    shingler = Shingler(4)
    sets = [shingler.shingles(t) for t in ("a b c d e f", "a b c d e g", "x y")]
    rows = list(packs(5, [(k - 1, s) for k, s in enumerate(sets)], 7))
    assert sum(len(r["shingles"]) + len(r["common"]) for r in rows) == 4 * len(np.unique(np.concatenate(sets)))
    shared = {int(i): int(n) for r in rows for i, n in zip(np.frombuffer(r["done"], np.int64), np.frombuffer(r["shared"], np.uint32))}
    assert shared == {-1: 2, 0: 2, 1: 0}


def test_key_depends_on_the_set():
    shingler = Shingler(4)
    assert class_key(shingler.shingles("a b c d a b c d a")) == class_key(shingler.shingles("a b c d a b c d a b c d a"))
    assert class_key(shingler.shingles("a b")) != class_key(shingler.shingles("b a"))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 90), (95, 100), (7, 7), (200, 201), (201, 200)]
    rows = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert rows == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
