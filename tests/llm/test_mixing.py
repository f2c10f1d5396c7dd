"""Weights against a plain search, epochs against counting, odd rows."""

import math
import re
from collections import Counter, defaultdict

import pytest

from canvass.llm import mixing, queries
from canvass.llm.arrow import prepare_checkpoints
from canvass.llm.mixing import Target, mix_sources, mixture, token_rows, weigh

SCHEMA = "doc_id long, text string, source string, weight string, lang string"


def corpus(sizes=(400, 120, 30, 7)):
    rows, i = [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            rows.append((i, " ".join(["w"] * (1 + i * 7 % 13)), f"s{s}", "x", "en"))
            i += 1
    return rows


def tokens(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_weights(sizes, exponent):
    w = {s: n**exponent for s, n in sizes.items()}
    return {s: x / sum(w.values()) for s, x in w.items()}


def entropy(weights):
    return -sum(w * math.log(w) for w in weights.values())


def sizes_of(rows):
    out = defaultdict(int)
    for _, text, source, *_ in rows:
        out[source] += tokens(text)
    return out


def weights_of(spark, rows, target):
    light = token_rows(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source")
    prepare_checkpoints(spark)
    return {r.source: r for r in weigh(light, target).collect()}


@pytest.mark.parametrize("share", [0.75, 0.9, 1.0])
def test_entropy(spark, share):
    rows = corpus()
    got = weights_of(spark, rows, Target(entropy=share, budget=1000))
    weights = {s: r.weight for s, r in got.items()}
    assert math.isclose(entropy(weights), share * math.log(4), abs_tol=1e-5)
    sizes = sizes_of(rows)
    exponent = math.log(weights["s0"] / weights["s1"]) / math.log(sizes["s0"] / sizes["s1"])
    for s, w in plain_weights(sizes, exponent).items():
        assert math.isclose(w, weights[s], abs_tol=1e-9)


@pytest.mark.parametrize("limit", [1.0, 1.5, 4.0, 1000.0])
def test_repeats(spark, limit):
    rows = corpus()
    got = weights_of(spark, rows, Target(repeats=limit))
    assert math.isclose(min(r.epochs for r in got.values()), 1)
    most = max(r.epochs for r in got.values())
    sizes = sizes_of(rows)
    flat = max(sizes.values()) / min(sizes.values())
    assert math.isclose(most, min(limit, flat), rel_tol=1e-5)


def check_mixture(rows, out, budgets):
    """Copies of each row, by source and epoch: all rows in each full epoch, budgets kept and nearly used."""
    sizes = sizes_of(rows)
    for source, budget in budgets.items():
        mine = [r for r in rows if r[2] == source]
        read = [r for r in out if r.source == source]
        by_epoch = defaultdict(Counter)
        for r in read:
            by_epoch[r.epoch][(r.doc_id, r.text)] += 1
        full = int(budget / sizes[source] + 1e-6)
        for e in range(full):
            assert by_epoch[e] == Counter((r[0], r[1]) for r in mine)
        assert all(n <= Counter((r[0], r[1]) for r in mine)[k] for k, n in by_epoch[full].items())
        assert max(by_epoch, default=0) <= full
        used = sum(tokens(r.text) for r in read)
        assert used <= budget + 1e-6 * sizes[source]
        assert used > budget - 14
        assert all(0 <= r.progress < 1 + 1e-9 for r in read)


@pytest.mark.parametrize("block", [50, 100_000])
@pytest.mark.parametrize("budget", [200, 3000, 20_000])
def test_budget(spark, monkeypatch, block, budget):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", block)
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = mixture(df, Target(entropy=0.9, budget=budget)).collect()
    assert out[0].__fields__ == ["doc_id", "text", "source", "lang", "epoch", "progress", "weight"]
    check_mixture(rows, out, {r.source: r.weight * budget for r in out})
    again = mixture(df.repartition(2), Target(entropy=0.9, budget=budget)).collect()
    key = lambda r: (r.doc_id, r.epoch)
    assert [key(r) for r in sorted(out, key=key)] == [key(r) for r in sorted(again, key=key)]


def test_epochs_differ_in_order(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 20)
    out = mixture(spark.createDataFrame(corpus((40, 8)), SCHEMA), Target(entropy=1.0, budget=3000)).collect()
    orders = defaultdict(list)
    for r in sorted(out, key=lambda r: r.progress):
        if r.source == "s1":
            orders[r.epoch].append(r.doc_id)
    assert len({tuple(o) for o in orders.values()}) > 2


def test_odd_rows(spark):
    odd = [
        (9001, None, "s0", "x", "en"), (9002, "", "s1", None, "en"), (9003, "a null source", None, "x", "en"), (None, "no id", "s0", "x", None),
        (9004, "same row", "s0", "x", "en"), (9004, "same row", "s0", "x", "en"), (9005, None, "silent", "x", "en"),
        (9006, "long " * 50_000, "s0", "x", "en"),
    ]
    df = spark.createDataFrame(corpus((20, 5)) + odd, SCHEMA)
    out = mix_sources(df, repeats=3.0)
    assert out.schema == df.schema
    copies, before = Counter(out.collect()), Counter(df.collect())
    assert set(copies) == set(before)
    assert all(copies[r] >= n for r, n in before.items())
    assert all(copies[r] <= 3 * n for r, n in before.items())
    assert all(copies[r] == before[r] for r in before if r.source in ("s0", "silent"))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixture(df, Target(entropy=0.9, repeats=2.0, budget=5)).count() == 0 and mix_sources(df).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(d.doc_id, d.text, d.source, "x", "en") for d in docs]
    out = queries.op5_mixing(spark, sf).collect()
    text = {d.doc_id: d.text for d in docs}
    total = sum(sizes_of(rows).values())
    used = defaultdict(int)
    for r in out:
        used[r.source] += tokens(text[r.doc_id])
    weights = {r.source: r.weight for r in out}
    assert math.isclose(sum(weights.values()), 1, abs_tol=1e-6)
    assert all(used[s] <= w * total + 1 for s, w in weights.items())
    assert all(n == 1 for n in Counter((r.doc_id, r.epoch) for r in out).values())


def test_steep_targets(spark):
    rows = [(i, "w", "a" if i < 100 else "b", "x", "en") for i in range(199)]
    weights = {s: r.weight for s, r in weights_of(spark, rows, Target(entropy=0.5, budget=100)).items()}
    assert math.isclose(entropy(weights), 0.5 * math.log(2), abs_tol=1e-5)
    equal = [(i, "w", f"s{i % 2}", "x", "en") for i in range(20)]
    with pytest.raises(ValueError, match="no exponent"):
        weights_of(spark, equal, Target(entropy=0.5, budget=10))
