"""Top-k search against scoring every document; pruning; odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from canvass.llm import search as s
from canvass.llm.search import Index, search, term_hash, terms_of

SCHEMA = "doc_id long, text string, words string, score int"


def plain(rows, queries, k):
    docs = [(i, Counter(terms_of(t))) for i, t, *_ in rows]
    total, mean = len(docs), max(1, sum(sum(c.values()) for _, c in docs)) / max(1, len(docs))
    df = Counter(t for _, c in docs for t in c)
    out = []
    for qid, text in dict.fromkeys((q[0], q[1]) for q in queries):
        terms = sorted(set(terms_of(text)), key=term_hash)
        scored = []
        for i, c in docs:
            score = 0.0
            for t in terms:
                if c[t]:
                    tf, norm = c[t], s.K1 * (1 - s.B + s.B * sum(c.values()) / mean)
                    score += tf * (s.K1 + 1) / (tf + norm) * math.log(1 + (total - df[t] + 0.5) / (df[t] + 0.5))
            if score > 0:
                scored.append((-round(score, 9), i is None, i or 0, i))
        out += [(qid, x[3], n + 1, -x[0]) for n, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def same(got, want):
    got = sorted((r.query_id, r.rank, r.doc_id, r.score) for r in got)
    want = sorted((q, n, i, v) for q, i, n, v in want)
    assert [(g[0], g[1]) for g in got] == [(w[0], w[1]) for w in want]
    assert all(math.isclose(a[3], b[3], abs_tol=2e-9) for a, b in zip(got, want))
    assert sum(a[2] != b[2] for a, b in zip(got, want)) == 0


def corpus(n):
    draw = random.Random(n)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(draw.choices(vocabulary, weights, k=draw.randrange(1, 60))), "x", 1) for i in range(n)]


@pytest.mark.parametrize("shard_bytes", [20_000, 1 << 30])
def test_against_all(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(s, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(s, "QUERY_BLOCK", 20)
    odd = [
        (1000, None, "x", 1), (1001, "", "x", 1), (1002, "!!! ...", "x", 1), (None, "w1 w2 w3", "x", 1), (None, "w1 w2 w3", "x", 1),
        (1003, "w5 É", "x", 1), (1003, "w5 É", "x", 1), (1050, "W5 w5 é É", "x", 1), (1004, "w7 " * 40_000, "x", 1), (1100, "only here", "x", 1),
    ]
    rows = corpus(700) + odd
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    queries = df.where("doc_id % 50 = 0").union(df.where("doc_id = 1003"))
    asked = [r for r in rows if r[0] is not None and (r[0] % 50 == 0 or r[0] == 1003)]
    same(search(df, queries, 10).collect(), plain(rows, asked, 10))


def test_pruning_is_exact():
    draw = np.random.default_rng(3)
    terms = [np.unique(draw.zipf(1.3, 30).clip(max=500)).astype(np.int64) for _ in range(3000)]
    times = [np.ones(len(t), np.uint32) for t in terms]
    words = np.array([float(len(t)) for t in terms])
    index = Index(terms, times, words, words.mean())
    for k in (1, 3, 10, 5000):
        query = np.array([2, 3, 9, 77, 400, 10**9], np.int64)
        weights = np.array([0.5, 0.7, 2.0, 5.0, 6.0, 9.0])
        docs, scores = index.top(query, weights, k)
        full = np.zeros(len(terms))
        for i, t in enumerate(terms):
            norm = s.K1 * (1 - s.B + s.B * words[i] / words.mean())
            full[i] = round(sum(w * (s.K1 + 1) / (1 + norm) for q, w in zip(query, weights) if q in t), 9)
        want = np.lexsort((np.arange(len(full)), -full))[:k]
        want = want[full[want] > 0]
        assert docs.tolist() == want.tolist() and np.allclose(scores, full[want])


def test_documents_that_cannot_reach_are_passed_over():
    """Postings of frequent terms are not read once rare ones decide; those of terms that no query has are not kept."""
    draw = np.random.default_rng(5)
    frequent = np.arange(100, 140)
    terms = [np.unique(np.r_[draw.choice(frequent, 30, False), 1000 + i // 20]).astype(np.int64) for i in range(4000)]
    times, words = [np.ones(len(t), np.uint32) for t in terms], np.array([float(len(t)) for t in terms])
    query, weights = np.r_[frequent, 1007], np.r_[np.full(40, 0.3), 20.0]
    index = Index(terms, times, words, words.mean(), query)
    docs, scores = index.top(query, weights, 10)
    assert set(docs) <= set(range(140, 160)) and len(docs) == 10
    assert index.touched < 0.1 * len(index.doc) and len(index.doc) == sum(np.isin(t, query).sum() for t in terms)
    whole = [round(sum(w * index.most.max() for q, w in zip(query, weights) if q in terms[d]), 6) for d in range(140, 160)]
    assert np.isclose(scores[0], max(whole), rtol=0.05)


def test_no_fiftieth_term_in_a_shard():
    index = Index([np.array([5], np.int64)], [np.ones(1, np.uint32)], np.ones(1), 1.0, np.array([3, 9], np.int64))
    assert index.top(np.array([3]), np.array([1.0]), 10)[0].tolist() == []


def test_empty(spark):
    df, none = spark.createDataFrame(corpus(5), SCHEMA), spark.createDataFrame([], SCHEMA)
    assert search(none, none, 10).count() == 0 and search(df, none, 10).count() == 0 and search(none, df, 10).count() == 0


def test_neither_shards_nor_queries_are_copied_for_the_pairs(spark, monkeypatch):
    """What the pairs of shards and queries send does not grow with the number of shards; the plan shuffles no copies."""
    monkeypatch.setattr(s, "SHARD_BYTES", 400)
    monkeypatch.setattr(s, "GROUPS", 2)
    kept = []
    merge = s.best_of_groups
    monkeypatch.setattr(s, "best_of_groups", lambda shards, *rest: kept.append((shards.count(), merge(shards, *rest))) or kept[0][1])
    rows = corpus(600)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = search(df, df.where("doc_id % 50 = 0"), 3)
    same(found.collect(), plain(rows, [r for r in rows if r[0] % 50 == 0], 3))
    (shards, sent), = kept
    assert shards > 100 and sent.count() <= 2 * 12 * 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CoGroup" not in plan


def test_equal_scores_in_later_shards():
    """The floor of shards read before keeps documents with the same score, of which the lower id counts, null ids last."""
    query = {"query_id": 7, "query_digest": 1, "q_terms": np.array([3, 5], np.int64).tobytes(), "q_weights": np.array([1.0, 2.0]).tobytes()}
    block = s.Block(pa.array([query]), 3, 2.0)
    for ids, texts in ([[9, 12, None], [[3, 5], [3, 8], [3, 5]]], [[4, 11], [[3, 5], [4, 8]]], [[], [[3, 5]]], [[1], [[8, 9]]], [[2], [[3, 5]]]):
        terms, sizes, places, times = s.inverted([np.array(t, np.int64) for t in texts], [np.ones(2, np.uint32) for _ in texts])
        arrays = {
            "words": np.full(len(texts), 2, np.int64), "ids": np.array([i for i in ids if i is not None], np.int64), "terms": terms,
            "sizes": sizes.astype(np.uint32), "places": places.astype(np.uint16), "times": times,
        }
        block.meet({name: a.tobytes() for name, a in arrays.items()})
    found = block.found()
    assert found["doc_id"].to_pylist() == [2, 4, 9] and len(set(found["score"].to_pylist())) == 1


def test_shards_that_cannot_reach_the_floor_are_not_read():
    terms = [np.array([1, 2], np.int64), np.array([2], np.int64)]
    index = Index(terms, [np.ones(len(t), np.uint32) for t in terms], np.array([2.0, 1.0]), 1.5)
    docs, scores = index.top(np.array([1, 2]), np.array([1.0, 1.0]), 1)
    assert docs.tolist() == [0] and index.touched
    index.touched = 0
    assert len(index.top(np.array([1, 2]), np.array([1.0, 1.0]), 1, scores[0] + 1)[0]) == 0 and index.touched == 0
    assert index.top(np.array([1, 2]), np.array([1.0, 1.0]), 2, scores[0])[0].tolist() == [0]


def test_a_worker_gets_few_pairs_at_once(spark):
    """Batches of pairs have bounded bytes, unless the session names a number of its own."""
    was = spark.conf.get(s.BATCH)
    try:
        for named, after in ((s.SPARK_BYTES, s.BATCH_BYTES), ("3m", "3m")):
            spark.conf.set(s.BATCH, named)
            df = spark.createDataFrame(corpus(100), SCHEMA).repartition(3)
            search(df, df.where("doc_id % 50 = 0"), 3).collect()
            assert spark.conf.get(s.BATCH) == after
    finally:
        spark.conf.set(s.BATCH, was)


@pytest.mark.parametrize("rare", [False, True])
def test_dense_terms_are_bounded_in_single_precision_and_scored_in_double(rare):
    """Lengths that differ by a ten-millionth give scores that single precision does not tell apart; ranks and scores are exact."""
    draw = np.random.default_rng(8)
    dense = np.arange(100, 150)
    terms = [np.sort(draw.choice(dense, 40, False)) if rare else dense for _ in range(3000)]
    for i in range(0, 3000, 30) if rare else ():
        terms[i] = np.r_[terms[i], 1007]
    times = [draw.integers(1, 4, len(t)).astype(np.uint32) if rare else np.ones(len(t), np.uint32) for t in terms]
    words = 1e7 + draw.permutation(3000)
    index = Index(terms, times, words, words.mean())
    assert index.dense.dtype == np.float32 and index.dense.shape == (3000, 50)
    query, weights = np.r_[dense, 1007], np.r_[draw.random(50) / 50, 9.0]
    by = dict(zip(query.tolist(), weights.tolist()))
    norm = s.K1 * (1 - s.B + s.B * words / words.mean())
    full = np.round([sum(by[t] * n * (s.K1 + 1) / (n + b) for t, n in zip(ts.tolist(), ns.tolist())) for ts, ns, b in zip(terms, times, norm)], 9)
    want = np.lexsort((np.arange(3000), -full))[:10]
    assert rare or len(set(full[want].astype(np.float32))) < len(set(full[want])) == 10
    for floor in (0.0, full[want[-1]]):
        docs, scores = index.top(query, weights, 10, floor)
        assert docs.tolist() == want.tolist() and np.allclose(scores, full[want], rtol=0, atol=2e-9)


def test_terms_are_found_in_any_bytes():
    import re

    text = "".join(map(chr, range(0x250))) + "aB9é😀\x85\xa0 x\x1fy\x00z"
    assert terms_of(text) == re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower()) and terms_of(None) == []
    assert s.term_hashes(terms_of(text)).tolist() == [term_hash(t) for t in terms_of(text)]
