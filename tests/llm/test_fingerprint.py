"""Fingerprints: sums, order, edits, likeness; the order of documents against sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from canvass.llm import queries
from canvass.llm.fingerprint import Hasher, Vector, fingerprint_columns, paired_with_next

HASHER = Hasher()
SCHEMA = "doc_id long, text string, fingerprint int, next string"


def vector(text):
    return HASHER.vector(text)


def words(seed, n=60):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(5000)}" for _ in range(n))


def same(a, b):
    return np.array_equal(a.identity, b.identity) and np.array_equal(a.sketch, b.sketch)


def test_order_and_increments():
    lines = [words(i) for i in range(30)] + ["", "a", "a b", words(3)]
    whole = vector("\n".join(lines))
    shuffled = lines[:]
    random.Random(0).shuffle(shuffled)
    assert same(whole, vector("\n".join(shuffled)))
    assert same(whole, sum((vector(x + "\n") for x in lines), Vector()))
    assert same(whole - vector(lines[5]), vector("\n".join(lines[:5] + lines[6:])))
    assert not same(whole, vector("\n".join(lines + ["a"])))
    assert same(Vector.decoded(whole.encoded()), whole)


def test_multiplicity():
    assert not same(vector("a\n" * 65536), vector("a\n" * 131072))
    assert not same(vector("a\na"), vector("a"))
    assert same(vector(""), Vector()) and not same(vector("\n"), Vector())


def exact(a, b):
    def shingles(text):
        out = Counter()
        for p in text.split("\n"):
            w = p.split()
            out.update(tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2)) if w)
        return out

    a, b = shingles(a), shingles(b)
    return 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))


def test_likeness():
    errors = []
    for i in range(40):
        a = "\n".join(words(100 * i + k) for k in range(8))
        b = a[: len(a) * (i % 10 + 1) // 11] + "\n" + words(7777 + i, 150)
        errors.append(vector(a).likeness(vector(b)) - exact(a, b))
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.2
    assert vector("").likeness(vector("")) == 1.0 and vector("a b").likeness(vector("")) == 0.0


@pytest.mark.parametrize("line", ["one two three", words(5, 9)])
@pytest.mark.parametrize("times", [300, 70_000])
def test_repeated_lines_count_once_each(line, times):
    own = "\n".join(words(9000 + k) for k in range(40))
    some, many = (own + ("\n" + line) * n for n in (times // 3, times))
    for left, right in ((own, some), (own, many), (some, many), (("\n" + line) * times, line)):
        assert abs(vector(left).likeness(vector(right)) - exact(left, right)) < 0.2
    whole = vector(many)
    assert same(Vector.decoded(whole.encoded()), whole)
    assert same(whole - vector((line + "\n") * (times - 1)), vector(own + "\n" + line))


def test_likeness_of_pasted_lines():
    errors = []
    for i in range(30):
        a = "\n".join(words(100 * i + k) for k in range(20))
        b = "\n".join([*a.split("\n")[:15], *[words(7000 + i, 9)] * 288])
        errors.append(vector(a).likeness(vector(b)) - exact(a, b))
    assert abs(np.mean(errors)) < 0.05 and np.max(np.abs(errors)) < 0.2


def test_rows(spark):
    long = "one two three four five\n" * 20000
    rows = [(1, None, 5, "x"), (2, "", 5, None), (3, long, 5, "x"), (3, long, 5, "x"), (None, "a\nb", 5, "b\na")]
    out = fingerprint_columns(spark.createDataFrame(rows, SCHEMA), {"text": "fingerprint", "next": "other"}).collect()
    assert out[0].__fields__ == ["doc_id", "text", "next", "fingerprint", "other"] and len(out) == 5
    for r in out:
        assert r.fingerprint == vector(r.text or "").encoded()
    assert out[4].fingerprint == out[4].other
    assert fingerprint_columns(spark.createDataFrame([], SCHEMA), {"text": "f"}).count() == 0


@pytest.mark.parametrize("buckets", [1, 7, 40])
@pytest.mark.parametrize("ids", [
    [], [5], [None], [None, None, 3], list(range(50)), [7] * 20 + [1, 2, None], [2**60 + i for i in range(9)], [-3, 0, None, 8, 8],
])
def test_next(spark, ids, buckets):
    rows = [(i, f"t{k}" if k % 5 else None, k, None) for k, i in enumerate(ids)]
    got = paired_with_next(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "next", buckets).collect()
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or ""))
    want = [(r[0], r[1], rows[(k + 1) % len(rows)][1]) for k, r in enumerate(rows)]
    assert Counter((r.doc_id, r.text, r.next) for r in got) == Counter(want)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op9_fingerprint(spark, sf).collect()}
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda d: -d.doc_id)
    assert len(got) == len(docs)
    texts = [d.text or "" for d in docs]
    by_text = {}
    for k, d in enumerate(docs):
        text, after, row = texts[k], texts[(k + 1) % len(docs)], got[d.doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if k % 10 == 0:
            assert row.fingerprint == vector(text).encoded() and row.edited_fingerprint == vector(edited).encoded()
            assert row.near_next == vector(text).likeness(vector(after))
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
    assert len(set(by_text.values())) == len(by_text)
    assert sum(r.near_edited for r in got.values()) > sum(r.near_next for r in got.values()) + 0.3 * len(got)
