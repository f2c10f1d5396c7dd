"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its paragraphs (lines).  Each paragraph hashes to a
wide vector, and a document's fingerprint is the sum of the vectors of its
paragraphs, lane by lane modulo a power of two.  The order of paragraphs
therefore does not matter, and paragraphs are inserted into or deleted from a
fingerprint by adding or subtracting their vectors.

A vector has two parts.  The IDENTITY lanes (modulo 2^64) are
pseudo-random words of the whole paragraph: sums agree only for equal multisets.
The sketch counts the paragraph's word shingles in its first lane and adds, for each
of them, SKETCH values of a Cauchy distribution to the others (64 bits, no text wraps
them).  The lanes of a difference are then Cauchy distributed with the number of
shingles that differ as their scale, however often a single one occurs, and the
likeliest scale gives the likeness.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Callable
from functools import cache

import numpy as np
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField

from canvass.llm.arrow import add_columns, by_row

IDENTITY = 8
SKETCH = 512
# Words in a shingle of the sketch; a shorter paragraph is one shingle.
SHINGLE = 3
# Words whose hash is kept in one task, and lines whose sketch is kept.
CACHED_WORDS = 400_000
CACHED_LINES = 4096
# Lines summed at a time, and shingles: GATHERED values of WIDEST at most stay within 32 bits.
TOGETHER = 256
GATHERED = 64
WIDEST = (1 << 31) // GATHERED - 1
# Whole numbers in one unit of the Cauchy distribution.
UNIT = 16
# Places at which the values of a shingle may start.  Two different shingles share one by chance: n differing
# shingles on both sides make a likeness too high by about n / PLACES.
PLACES = 1 << 22

MIX = np.uint64(0x9E3779B97F4A7C15)
FOLD = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
STEPS = np.arange(1, IDENTITY + 1, dtype=np.uint64) * MIX


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each 64-bit word spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * FOLD[0]
    x = (x ^ (x >> np.uint64(27))) * FOLD[1]
    return x ^ (x >> np.uint64(31))


@cache
def cauchy_windows() -> np.ndarray:
    """Row i holds the SKETCH values of a shingle that starts at place i; rows are views of one array."""
    values = np.empty(PLACES + SKETCH, np.int32)
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16)]
        bits = mixed(np.arange(at + 1, at + 1 + len(part), dtype=np.uint64) * MIX) >> np.uint64(12)
        drawn = np.tan(np.pi * ((bits.astype(np.float64) + 0.5) / 2.0**52 - 0.5))
        part[:] = np.clip(np.rint(drawn * UNIT), -WIDEST, WIDEST)
    return np.lib.stride_tricks.sliding_window_view(values, SKETCH)


def cauchy_scale(values: np.ndarray) -> float:
    """Likeliest scale of values around 0, by Newton steps from their median size; 0 if half of them are 0."""
    squares = values * values
    scale = float(np.median(squares))
    for _ in range(20 if scale else 0):
        share = squares / (squares + scale)
        step = (share.sum() - len(values) / 2) / (share * (1.0 - share)).sum()
        scale *= float(np.exp(min(1.0, max(-1.0, step))))
        if abs(step) < 1e-9:
            break
    return scale**0.5


class Vector:
    """A fingerprint as lanes; sums wrap around by themselves."""

    __slots__ = ("identity", "sketch")

    def __init__(self, identity: np.ndarray | None = None, sketch: np.ndarray | None = None) -> None:
        self.identity = np.zeros(IDENTITY, np.uint64) if identity is None else identity
        self.sketch = np.zeros(1 + SKETCH, np.int64) if sketch is None else sketch

    def __add__(self, other: Vector) -> Vector:
        return Vector(self.identity + other.identity, self.sketch + other.sketch)

    def __sub__(self, other: Vector) -> Vector:
        return Vector(self.identity - other.identity, self.sketch - other.sketch)

    def encoded(self) -> str:
        """Sketch lanes take 4 bytes if all fit, else 8; the first byte tells which."""
        width = 4 if np.abs(self.sketch).max() < 1 << 31 else 8
        lanes = self.identity.astype("<u8").tobytes() + self.sketch.astype(f"<i{width}").tobytes()
        return base64.b64encode(bytes([width]) + lanes).decode()

    @classmethod
    def decoded(cls, text: str) -> Vector:
        lanes = base64.b64decode(text)
        end = 1 + 8 * IDENTITY
        return cls(np.frombuffer(lanes[1:end], "<u8"), np.frombuffer(lanes[end:], f"<i{lanes[0]}").astype(np.int64))

    def likeness(self, other: Vector) -> float:
        """Estimated share of common shingles: twice the common over the sum of both, 1 for two empty ones."""
        if np.array_equal(self.identity, other.identity):
            return 1.0
        sizes = int(self.sketch[0] + other.sketch[0])
        if not sizes:
            return 0.0
        apart = self.sketch - other.sketch
        differ = max(abs(int(apart[0])), cauchy_scale(apart[1:].astype(np.float64)) / UNIT)
        return max(0.0, 1.0 - differ / sizes)


class Hasher:
    """Sums the vectors of a text's paragraphs; those of recent paragraphs are kept."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.lines: dict[int, int] = {}
        self.sums = np.zeros((CACHED_LINES, 1 + SKETCH), np.int64)

    def vector(self, text: str) -> Vector:
        # a trailing line break ends the last paragraph, it does not begin an empty one
        paragraphs = Counter(text.removesuffix("\n").split("\n") if text else [])
        if not paragraphs:
            return Vector()
        keys = np.array([xxhash.xxh3_64_intdigest(p.encode("utf-8")) for p in paragraphs], np.uint64)
        times = np.array(list(paragraphs.values()), np.uint64)
        identity = (mixed(keys[:, None] + STEPS) * times[:, None]).sum(axis=0, dtype=np.uint64)
        return Vector(identity, self.sketch(list(paragraphs), keys.tolist(), times.astype(np.int64)))

    def sketch(self, paragraphs: list[str], keys: list[int], times: np.ndarray) -> np.ndarray:
        total, known = np.zeros(1 + SKETCH, np.int64), self.lines
        for at in range(0, len(keys), TOGETHER):
            part = dict(zip(keys[at : at + TOGETHER], paragraphs[at : at + TOGETHER]))
            if len(known) + sum(k not in known for k in part) > CACHED_LINES:
                known.clear()
            self.learn({k: p for k, p in part.items() if k not in known})
            rows = [known[k] for k in keys[at : at + TOGETHER]]
            total += (self.sums[rows] * times[at : at + TOGETHER, None]).sum(axis=0)
        return total

    def learn(self, lines: dict[int, str]) -> None:
        """Keep the sketches of lines, all their shingles hashed at once."""
        if not lines:
            return
        known, split = self.words, [p.split() for p in lines.values()]
        new = {w for words in split for w in words if w not in known}
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = {w for words in split for w in words}
        known.update((w, xxhash.xxh3_64_intdigest(w.encode("utf-8"))) for w in new)
        sizes = np.array([len(words) for words in split])
        flat = np.fromiter((known[w] for words in split for w in words), np.uint64, int(sizes.sum()))
        # a shingle starts at each word that has enough words after it in its paragraph, or at a short one's first
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = np.repeat(sizes, sizes) - place
        hashes = flat.copy()
        for k in range(1, SHINGLE):
            follows = np.flatnonzero(left > k)
            hashes[follows] = mixed(hashes[follows]) + flat[follows + k] * np.uint64(2 * k + 1)
        starts = (left >= SHINGLE) | (place == 0)
        places = (mixed(hashes[starts]) % np.uint64(PLACES)).astype(np.int64)
        windows, end = cauchy_windows(), 0
        for key, n in zip(lines, np.where(sizes > 0, np.maximum(sizes - SHINGLE + 1, 1), 0).tolist()):
            begin, end = end, end + n
            row = self.sums[len(self.lines)]
            row[0], row[1:] = n, 0
            for at in range(begin, end, GATHERED):
                row[1:] += windows[places[at : min(end, at + GATHERED)]].sum(axis=0, dtype=np.int32)
            self.lines[key] = len(self.lines)


def fingerprint_columns(
    df: DataFrame, columns: dict[str, str], likeness: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """`df` with the fingerprints of its text columns, and the likeness of pairs of these fingerprints.

    `columns` maps a text column to its result's name, `likeness` a result's name to two names of fingerprints.
    Null and empty texts have the fingerprint of no paragraphs.  Only the text
    counts: equal texts, also in repeated rows, have equal fingerprints, and so
    have texts with the same lines in another order.  Very long texts are
    hashed whole.  An empty table gives no rows; a column named like a result is replaced.
    """
    names = list(columns.values())
    pairs = [(names.index(a), names.index(b)) for a, b in (likeness or {}).values()]

    def make() -> Callable[..., tuple]:
        hasher = Hasher()
        recent: dict[str, Vector] = {}

        def vector(text: str) -> Vector:
            # rows that quote their neighbours repeat texts at short distance
            if text not in recent:
                if len(recent) >= 4:
                    del recent[next(iter(recent))]
                recent[text] = hasher.vector(text)
            return recent[text]

        def row(*texts: str | None) -> tuple:
            vectors = [vector(t or "") for t in texts]
            return (*[v.encoded() for v in vectors], *[vectors[a].likeness(vectors[b]) for a, b in pairs])

        return row

    fields = [*[StructField(n, StringType()) for n in names], *[StructField(n, DoubleType()) for n in likeness or {}]]
    return add_columns(df, list(columns), fields, by_row(make))


def paired_with_next(df: DataFrame, id_col: str, value: str, into: str, buckets: int) -> DataFrame:
    """`df` with the `value` of the next row by descending id; after the last row the first follows.

    Ids are numbers.  Rows are dealt into ranges of ids, and each range also gets the first row of the
    range that follows it, so one shuffle serves all ranges and no task holds more than
    one of them.  Rows with the same id follow each other by `value`; null ids and values come
    last.  A single row is its own next; an empty table gives no rows.
    """
    ids = df.select(F.col(id_col).cast("double").alias("__id"), F.col(id_col).alias("__head"))
    steps = [i / buckets for i in range(1, buckets)]
    # two ranges at least
    bounds = sorted(set(ids.approxQuantile("__id", steps, 0.1 / buckets) if steps else [])) or [0.0]
    ranges = Bucketizer(
        splits=[-float("inf"), *bounds, float("inf")], inputCol="__id", outputCol="__range", handleInvalid="keep"
    )
    # ranges count from the highest ids; null ids are the last range
    last = len(bounds) + 1
    place = F.when(F.col("__id").isNull(), last).otherwise(len(bounds) - F.col("__range")).cast("int")
    # one row for each range
    found = ranges.transform(ids).groupBy(place.alias("p")).agg(F.max("__head").alias("head")).orderBy("p").collect()
    heads, goes = [None] * (last + 1), [None] * (last + 1)
    for i, (p, head) in enumerate(found):
        heads[p], goes[p] = head, found[i - 1].p
    kind = df.schema[id_col].dataType
    head = F.element_at(F.lit(heads).cast(ArrayType(kind)), F.col("__p") + 1)
    before = F.element_at(F.lit(goes).cast("array<int>"), F.col("__p") + 1)
    own, early = (F.struct(F.lit(k).alias("early"), c.alias("p")) for k, c in ((0, F.col("__p")), (1, before)))
    copies = F.when(F.col(id_col).eqNullSafe(head), F.array(own, early)).otherwise(F.array(own))
    order = Window.partitionBy("__to.p").orderBy("__to.early", F.desc_nulls_last(id_col), F.asc_nulls_last(value))
    return (
        ranges.transform(df.withColumn("__id", F.col(id_col).cast("double")))
        .withColumn("__p", place)
        .withColumn("__to", F.explode(copies))
        .drop("__id", "__range", "__p")
        .withColumn(into, F.lead(value).over(order))
        .where("__to.early = 0")
        .drop("__to")
    )
