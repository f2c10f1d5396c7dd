"""Hard negatives against scoring all pairs, termination of the walks, and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from canvass.llm import negatives, queries
from canvass.llm.negatives import hard_negatives, scores_of, walk

SCHEMA = "id long, label int, vector array<long>, rank string"


def plain(rows, every, positives=5, negatives=3, low=50, high=95, whole=100):
    """All pairs; rows are (id, label, vector)."""
    known = {}
    for i, label, v in sorted((r for r in rows if None not in r and None not in r[2]), key=lambda r: (r[0], r[1], r[2])):
        known.setdefault(i, (label, v))
    dot = lambda a, b: max(negatives_min, min(negatives_max, sum(x * y for x, y in zip(a, b))))
    negatives_min, negatives_max = -(1 << 63), (1 << 63) - 1
    out = []
    for a, (label, v) in known.items():
        if a % every:
            continue
        scored = sorted((-dot(v, w), i, k) for i, (k, w) in known.items() if i != a)
        same = [(i, -s) for s, i, k in scored if k == label][:positives]
        for p, score in same:
            fits = [(i, -s) for s, i, k in scored if k != label and low * score <= -s * whole <= high * score][:negatives]
            out += [(a, p, r, i, score, s) for r, (i, s) in enumerate(fits, 1)]
    return sorted(out)


def got(df, **more):
    return sorted(tuple(r) for r in hard_negatives(df, F.col("id") % 10 == 0, **more).collect())


def clustered(n, width=16, groups=6, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, width))
    vectors = centres[rng.integers(groups, size=n)] + 0.2 * rng.normal(size=(n, width))
    return [(int(i), int(rng.integers(4)), np.floor(64 * v).astype(int).tolist()) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(negatives, "SHARD", 60)
    monkeypatch.setattr(negatives, "BLOCK", 6)
    monkeypatch.setattr(negatives, "SAMPLE", 40)
    monkeypatch.setattr(negatives, "STEP", 16)
    rows = clustered(300, seed=seed)
    # a third of the rows are copies of one vector, so ids decide
    rows = [(i, label, rows[0][2] if i % 3 == 0 else v) for i, label, v in rows]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert got(df) == plain(rows, 10)
    assert got(df, positives=2, negatives=5, low=10, high=100) == plain(rows, 10, 2, 5, 10, 100)


def test_odd_rows(spark):
    rows = [
        (0, 1, [3, 4]), (0, 1, [3, 4]), (0, 1, [9, 9]), (1, 1, [3, 4, 100]), (2, 2, [2, 2]), (3, 2, []), (4, 2, [0, 0]), (10, 1, [-3, -4]),
        (20, 3, [1]), (None, 1, [1, 1]), (5, None, [1, 1]), (6, 1, None), (7, 2, [1, None]), (8, 2, [2, 2, 0, 0]), (9, 2, [1 << 62, 7]),
        (30, 2, [1 << 61, 1]), (11, 1, [1 << 61, 1]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert got(df) == plain(rows, 10)
    assert hard_negatives(df.where("false"), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives(df, F.lit(False)).count() == 0
    assert hard_negatives(df.where("label = 3"), F.col("id") % 10 == 0).columns == hard_negatives(df, F.lit(True)).columns
    assert hard_negatives(df.where("label = 3"), F.col("id") % 10 == 0).count() == 0


def test_scores_are_exact():
    one = negatives.matrix([[(1 << 40) + 1, 3]])
    other = negatives.matrix([[(1 << 21) + 1, 5], [1 << 50, 1]])
    assert scores_of(one, other).tolist() == [[((1 << 40) + 1) * ((1 << 21) + 1) + 15, (1 << 63) - 1]]


def test_walks_end_early_where_rows_are_clustered():
    rows = clustered(20000)
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[2] for r in rows], float)
    centre = np.argsort(-(vectors @ vectors[0]))[:50]
    members = vectors[centre]
    low, high = np.full((50, 1), negatives.LEAST), np.full((50, 1), negatives.MOST)
    found = walk(members, vectors, ids, 5, low, high, lambda a, r: np.ones((len(a), len(r)), bool))
    assert found.scored < 50 * len(rows) / 2
    exact = (members @ vectors.T).astype(int)
    for k in range(50):
        want = sorted(range(len(rows)), key=lambda i: (-exact[k, i], i))[:5]
        assert found.ids[found.rows == k].tolist() == want
        assert found.scores[found.rows == k].tolist() == exact[k, want].tolist()
    # a bound that is known beforehand shortens the walk, and leaves the result as it is
    known = found.scores[4::5].reshape(-1, 1)
    again = walk(members, vectors, ids, 5, known, high, lambda a, r: np.ones((len(a), len(r)), bool))
    assert again.scored <= found.scored and again.ids.tolist() == found.ids.tolist()


def test_query(spark):
    random.seed(1)
    sf = "/root/testdata/sf0.001"
    rows = [
        (r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, np.floor(256 * np.array(r.embedding, float)).astype(int).tolist())
        for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ]
    out = queries.op11_hard_negatives(spark, sf)
    assert out.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"),
        ("negative_score", "bigint")]
    assert sorted(tuple(r) for r in out.collect()) == plain(rows, 50)
