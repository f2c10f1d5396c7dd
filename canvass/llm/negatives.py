"""Hard negatives by shared lists of anchor clusters, ordered by an angular bound.

Anchors near one another form a block.  No member of a block lies further than an angle
r from the block's centre, so the inner product of a member a and a row c is at most
|a| |c| cos(angle(c, centre) - r).  Rows are sorted once for each block by this
bound, without |a|, and every member walks the same list from its top.  It has
finished, certified, when what it has found beats the bound of the next row.
Lists are cut into shards, so that a task holds one block and one shard; results of
shards are merged exactly.  A member starts with what a bounded sample of the rows
guarantees, so in most shards a walk over clustered data ends near the top.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.llm.arrow import small, stored

# Rows of a shard and anchors of a block, on average: what one task holds.
SHARD = 16_384
BLOCK = 256
# Rows of the sample that tells first bounds and cluster centres, at most; and centres.
SAMPLE = 4_096
CENTRES = 256
# Rows of a list that are scored at a time.
STEP = 512
# Scores below 2^53 are exact as doubles.
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def matrix(vectors: list[list[int]]) -> np.ndarray:
    """Whole numbers as doubles, or as Python's integers if doubles cannot hold them; short vectors end with zeros."""
    width = max([len(v) for v in vectors], default=0)
    exact = all(-EXACT < x < EXACT for v in vectors for x in (min(v, default=0), max(v, default=0)))
    out = np.zeros((len(vectors), width), float if exact else object)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def widened(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices with as many columns as the wider one."""
    width = max(one.shape[1], other.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (one, other))


def scores_of(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact inner products; those beyond a long are held at its ends."""
    if one.dtype != object and other.dtype != object:
        most = np.abs(one).max(initial=0) * np.abs(other).max(initial=0) * max(one.shape[1], 1)
        if most < EXACT:
            return (one @ other.T).astype(np.int64)
    whole, across = ([[int(x) for x in r] for r in m.tolist()] for m in (one, other))
    products = [[max(LEAST, min(MOST, sum(x * y for x, y in zip(a, b)))) for b in across] for a in whole]
    return np.array(products, np.int64).reshape(len(one), len(other))


def unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at length one, and their lengths; rows of zeros stay."""
    m = m.astype(float)
    scale = np.abs(m).max(axis=1, initial=0)
    m = m / np.where(scale > 0, scale, 1)[:, None]
    length = np.sqrt((m * m).sum(axis=1))
    return m / np.where(length > 0, length, 1)[:, None], length * scale


@dataclass
class Walks:
    """Walks of the members of a block: what each has found, the best first, and how many rows were scored."""

    rows: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    scored: int


def walk(
    members: np.ndarray, rows: np.ndarray, ids: np.ndarray, wanted: int,
    low: np.ndarray, high: np.ndarray, allowed: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> Walks:
    """The `wanted` best rows of each member and window, by score, then id.

    A member has one or more windows: scores from `low` to `high`, matrices of members by windows.  `low`
    may be any score that the last wanted row of the window is known to reach.
    `allowed` tells for members and rows (indices) which pairs count.  A window's number is
    member * windows + window; `rows` of the result holds these numbers, ascending.
    """
    members, rows = widened(members, rows)
    n, windows = low.shape
    floor = low.copy()
    best = [np.empty(0, np.int64)] * 3  # window number, id, score
    direction, length = unit(members)
    other, size = unit(rows)
    centre, _ = unit(direction.sum(axis=0, keepdims=True))
    radius = np.arccos(np.clip(direction @ centre[0], -1, 1))[length > 0].max(initial=0)
    angle = np.arccos(np.clip(other @ centre[0], -1, 1))
    # a centre of zero length bounds nothing
    bound = size * np.cos(np.maximum(0, angle - radius)) if centre.any() else size
    slack = 1e-9 * length * size.max(initial=0) + 1e-6
    order = np.lexsort((ids, -bound))
    active = np.flatnonzero((low <= high).any(axis=1))
    scored = 0
    for at in range(0, len(order), STEP):
        reach = bound[order[at]] * length[active] + slack[active]
        active = active[((floor[active] <= reach[:, None]) & (low[active] <= high[active])).any(axis=1)]
        if not len(active):
            break
        part = order[at : at + STEP]
        scores = scores_of(members[active], rows[part])
        scored += scores.size
        fits = allowed(active, part)
        found = [best]
        for w in range(windows):
            hit, col = np.nonzero(fits & (scores >= floor[active, w][:, None]) & (scores <= high[active, w][:, None]))
            found.append([active[hit] * windows + w, ids[part[col]], scores[hit, col]])
        number, own, score = (np.concatenate([f[k] for f in found]) for k in range(3))
        rank = np.lexsort((own, -score, number))
        number, own, score = number[rank], own[rank], score[rank]
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else np.empty(0, int)
        place = np.arange(len(number)) - np.repeat(starts, np.diff(np.r_[starts, len(number)]))
        keep = place < wanted
        full = place == wanted - 1
        np.maximum.at(floor.reshape(-1), number[full], score[full])
        best = [number[keep], own[keep], score[keep]]
    return Walks(*best, scored)


@dataclass
class Sample:
    """A bounded sample of the rows, with cluster centres."""

    ids: np.ndarray
    labels: list
    vectors: np.ndarray
    centres: np.ndarray


def learned_sample(rows: DataFrame, anchors: int) -> Sample:
    """At most SAMPLE rows, the one with the smallest hash of each hash part, and centres from a few rounds over them."""
    hashed = F.xxhash64("id")
    kept = rows.groupBy(F.pmod(hashed, F.lit(SAMPLE)).alias("part")).agg(F.min_by(F.struct("id", "label", "vector"), hashed).alias("r"))
    found = sorted((r.r for r in kept.select("r").collect()), key=lambda r: r.id)
    vectors = matrix([r.vector for r in found])
    directions, length = unit(vectors)
    directions = directions[length > 0]
    number = max(1, min(CENTRES, -(-anchors // BLOCK), len(directions)))
    centres = directions[:: max(1, len(directions) // number)][:number]
    for _ in range(5):
        nearest = np.argmax(directions @ centres.T, axis=1) if len(centres) else np.empty(0, int)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, directions)
        moved, length = unit(sums)
        centres = np.where(length[:, None] > 0, moved, centres)
    return Sample(np.array([r.id for r in found], np.int64), [r.label for r in found], vectors, centres)


def with_cluster(anchors: DataFrame, sample: Sample, positives: int) -> DataFrame:
    """Anchors with the nearest centre and a score that their last positive reaches at least."""
    shared = anchors.sparkSession.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        labels = np.array(known.labels, object)
        for batch in (b.slice(at, STEP) for b in batches for at in range(0, b.num_rows, STEP)):
            vectors = matrix(batch.column(2).to_pylist())
            one, centres = widened(unit(vectors)[0], known.centres)
            cluster = np.argmax(one @ centres.T, axis=1) if len(centres) else np.zeros(len(one), int)
            scores = scores_of(*widened(vectors, known.vectors))
            floors = []
            for i, (own, label) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                same = scores[i][(labels == label) & (known.ids != own)]
                floors.append(int(np.partition(same, -positives)[-positives]) if len(same) >= positives else LEAST)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cluster, pa.int32()), pa.array(floors, pa.int64())], names=["id", "label", "vector", "cluster", "floor"]
            )

    label = anchors.schema["label"].dataType.simpleString()
    return anchors.select("id", "label", "vector").mapInArrow(
        run, f"id long, label {label}, vector array<long>, cluster int, floor long"
    )


def bounded_by_sample(anchors: DataFrame, sample: Sample, negatives: int) -> DataFrame:
    """`floors`: for each window a score that its last negative reaches at least, known from the sample."""
    shared = anchors.sparkSession.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        labels = np.array(known.labels, object)
        for batch in (b.slice(at, STEP) for b in batches for at in range(0, b.num_rows, STEP)):
            columns = dict(zip(batch.schema.names, (c.to_pylist() for c in batch.columns)))
            scores = scores_of(*widened(matrix(columns["vector"]), known.vectors))
            floors = []
            for i, (label, lows, highs) in enumerate(zip(columns["label"], columns["lows"], columns["highs"])):
                others = scores[i][labels != label]
                told = []
                for low, high in zip(lows, highs):
                    inside = others[(others >= low) & (others <= high)]
                    told.append(int(np.partition(inside, -negatives)[-negatives]) if len(inside) >= negatives else low)
                floors.append(told)
            names = [*batch.schema.names, "floors"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors, pa.list_(pa.int64()))], names=names)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return anchors.mapInArrow(run, fields + ", floors array<long>")


def nearest_positives(wanted: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best rows of a shard of the same label, for the anchors of a block."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        own, ids = anchors["id"].to_numpy(), rows["id"].to_numpy()
        low = anchors["floor"].to_numpy().reshape(-1, 1)
        found = None
        if len(own) and len(ids):
            found = walk(
                matrix(anchors["vector"].to_pylist()), matrix(rows["vector"].to_pylist()), ids, wanted,
                low, np.full_like(low, MOST), lambda a, r: own[a][:, None] != ids[r][None, :],
            )
        return results(own, found, 1)

    return run


def nearest_negatives(wanted: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best rows of a shard of other labels in each window of the anchors of a block."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        own, ids = anchors["id"].to_numpy(), rows["id"].to_numpy()
        windows = max([len(x) for x in anchors["lows"].to_pylist()], default=0)
        found = None
        if windows and len(ids):
            low, high = np.full((len(own), windows), MOST), np.full((len(own), windows), LEAST)
            for i, (floors, highs) in enumerate(zip(anchors["floors"].to_pylist(), anchors["highs"].to_pylist())):
                low[i, : len(floors)], high[i, : len(highs)] = floors, highs
            codes: dict = {}
            label, other = (
                np.array([codes.setdefault(x, len(codes)) for x in t["label"].to_pylist()]) for t in (anchors, rows)
            )
            found = walk(
                matrix(anchors["vector"].to_pylist()), matrix(rows["vector"].to_pylist()), ids, wanted,
                low, high, lambda a, r: label[a][:, None] != other[r][None, :],
            )
        return results(own, found, windows)

    return run


def results(own: np.ndarray, found: Walks | None, windows: int) -> pa.Table:
    number, ids, scores = (found.rows, found.ids, found.scores) if found else (np.empty(0, np.int64),) * 3
    windows = max(windows, 1)
    return pa.table({
        "anchor": pa.array(own[number // windows], pa.int64()), "slot": pa.array(number % windows, pa.int32()),
        "other": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64()),
    })


RESULT = "anchor long, slot int, other long, score long"


def shards_of(count: Column | int) -> Column:
    return F.greatest(F.lit(1), F.ceil((F.lit(count) if isinstance(count, int) else count) / SHARD)).cast("int")


def best(found: DataFrame, wanted: int) -> DataFrame:
    """The wanted best of each anchor and window over all shards, with their `rank`."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def hard_negatives(
    df: DataFrame, anchor: Column, id_col: str = "id", label: str = "label", vector: str = "vector",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, whole: int = 100,
) -> DataFrame:
    """Columns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor` is the condition that makes a row an anchor, `vector` an array of whole
    numbers, and a score an inner product, exact up to the ends of a long.  An
    anchor's positives are its best other rows of the same label, up to `positives`;
    for each, the best rows of other labels with low * positive <= whole * score <= high *
    positive are its negatives, up to `negatives`, so a positive with a negative score has none.  Higher
    scores come first, then smaller ids.

    Rows with a null id, label, vector or component take no part.  Ids name rows:
    of several rows with one id that with the least label, then vector, counts, so
    repeated rows count once.  Missing components of shorter vectors count as zero, however
    long the others are.  Empty tables, and anchors alone with their label, give no rows.  Other columns
    are not read.
    """
    hollow = F.exists("vector", lambda x: x.isNull())
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"),
        F.col(f"`{vector}`").cast("array<long>").alias("vector"), anchor.alias("is_anchor"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(~hollow)
    rows = stored(rows.groupBy("id").agg(F.min(F.struct("label", "vector", "is_anchor")).alias("r")).select("id", "r.*"))
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    sample = learned_sample(rows, asked)
    anchors = stored(with_cluster(rows.where("is_anchor"), sample, positives))
    rows = rows.drop("is_anchor")

    # positives: blocks and shards of one label
    per_label = rows.groupBy("label").agg(shards_of(F.count(F.lit(1))).alias("shards"))
    blocks = anchors.groupBy("label", "cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("pieces"))
    spread = F.xxhash64("id", F.lit(1))
    left = anchors.join(small(blocks, 64), ["label", "cluster"]).withColumn("piece", F.pmod(spread, "pieces")).drop("pieces")
    left = left.join(small(per_label, 64), "label").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    right = rows.join(small(per_label, 64), "label").withColumn("shard", F.pmod(spread, "shards"))
    pieces = blocks.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces").cast("bigint") - 1)))
    right = right.join(small(pieces.drop("pieces"), 64), "label")
    key = ["label", "shard", "cluster", "piece"]
    # both sides come from the same tables: the second gets names of its own
    other_key = [f"r_{k}" for k in key]
    typed = {"shard": F.col("shard").cast("int"), "piece": F.col("piece").cast("int")}
    left, right = left.withColumns(typed), right.withColumns(typed).withColumnsRenamed(dict(zip(key, other_key)))
    near = left.select(*key, "id", "vector", "floor").groupBy(*key).cogroup(
        right.select(*other_key, "id", "vector").groupBy(*other_key)
    ).applyInArrow(nearest_positives(positives), RESULT)
    chosen = stored(best(near, positives).select("anchor", "rank", F.col("other").alias("positive"), "score"))

    # negatives: blocks of any label against all shards
    in_order = F.array_sort(F.collect_list(F.struct("rank", "positive", "score")))
    listed = chosen.where("score >= 0").groupBy(F.col("anchor").alias("id")).agg(in_order.alias("p"))
    bounds = {
        "lows": F.transform("p", lambda p: F.ceil(p["score"].cast("decimal(38,0)") * low / whole).cast("long")),
        "highs": F.transform("p", lambda p: F.floor(p["score"].cast("decimal(38,0)") * high / whole).cast("long")),
    }
    windows = anchors.drop("floor").join(listed, "id").withColumns(bounds).drop("p")
    sizes = {r.cluster: r.n for r in anchors.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, starts = 0, {}
    for cluster, n in sorted(sizes.items()):
        starts[cluster] = (first, -(-n // BLOCK))
        first += starts[cluster][1]
    shards = max(1, -(-total // SHARD))
    if not first:
        return chosen.where("false").select(*[F.lit(0).cast(kind).alias(name) for name, kind in OUT])
    entries = [F.struct(F.lit(c), F.struct(F.lit(at).alias("at"), F.lit(n).alias("n"))) for c, (at, n) in starts.items()]
    known = F.map_from_entries(F.array(*entries))
    told = bounded_by_sample(windows.select("id", "label", "vector", "cluster", "lows", "highs"), sample, negatives)
    of = known[F.col("cluster")]
    left = told.withColumn("block", (of["at"] + F.pmod(spread, of["n"])).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    right = rows.withColumn("r_shard", F.pmod(spread, F.lit(shards)).cast("int")).withColumn(
        "r_block", F.explode(F.sequence(F.lit(0), F.lit(first - 1)))
    )
    far = left.groupBy("shard", "block").cogroup(right.groupBy("r_shard", "r_block")).applyInArrow(nearest_negatives(negatives), RESULT)
    slots = listed.select(F.col("id").alias("anchor"), F.posexplode("p").alias("slot", "p"))
    named = best(far, negatives).join(slots, ["anchor", "slot"])
    return named.select(
        F.col("anchor").alias("anchor_id"), F.col("p.positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )


OUT = [
    ("anchor_id", "long"), ("positive_id", "long"), ("rank", "int"), ("negative_id", "long"), ("positive_score", "long"),
    ("negative_score", "long"),
]
