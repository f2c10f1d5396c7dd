"""Extendible hashing against splitting buckets one by one."""

import hashlib
from collections import Counter

import pytest

from canvass.llm.sharding import shard_rows, write_shards

SCHEMA = "doc_id long, text string, shard int, source string"


def bits(i):
    return bin(int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16))[2:].zfill(60)


def plain(rows, limit):
    """Bits of the shard of each row, by splitting recursively."""
    out = {}

    def split(prefix, members):
        size = sum(len((t or "").encode()) for _, t, *_ in members)
        if size <= limit or len({bits(r[0]) for r in members}) == 1 or len(prefix) == 60:
            for r in members:
                out[r[0]] = (prefix, size, len(members), size <= limit)
            return
        for b in "01":
            deeper = [r for r in members if bits(r[0])[len(prefix)] == b]
            if deeper:
                split(prefix + b, deeper)

    split("", rows)
    return out


ODD = [(None, "x" * 90, 1, "s"), (None, "é" * 50, 1, "s"), (3, None, 1, "s"), (4, "", 1, None), (5, "long " * 5000, 1, "s"), (5, "long " * 5000, 1, "s")]


@pytest.mark.parametrize("limit", [0, 1, 100, 2000, 10**9])
def test_against_recursion(spark, limit):
    rows = [(i, "w" * (i * 37 % 101), 7, "s") for i in range(6, 300)] + ODD
    out = shard_rows(spark.createDataFrame(rows, SCHEMA).repartition(3), limit)
    assert out.columns == ["doc_id", "text", "source", "shard", "depth", "shard_bytes", "shard_rows", "fits"]
    got = out.collect()
    want = plain(rows, limit)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    for r in got:
        assert (r.shard, r.shard_bytes, r.shard_rows, r.fits) == want[r.doc_id] and r.depth == len(r.shard)


def test_empty(spark):
    assert shard_rows(spark.createDataFrame([], SCHEMA), 10).count() == 0


def test_files(spark, tmp_path):
    rows = [(i, "w" * 50, 7, "s") for i in range(40)]
    sharded = shard_rows(spark.createDataFrame(rows, SCHEMA), 300)
    write_shards(sharded, f"{tmp_path}/shards")
    back = spark.read.option("basePath", f"{tmp_path}/shards").schema("doc_id long, text string, shard string").parquet(f"{tmp_path}/shards")
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, r.shard) for r in sharded.collect()}
    assert len(list(tmp_path.glob("shards/*/part-*"))) == sharded.select("shard").distinct().count() > 5
