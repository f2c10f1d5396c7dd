"""Jaccard join of documents on word shingles, by prefix filters under several token orders.

Texts with the same set of shingles form a class; classes are joined, not texts.

1. Support.  A class can only be linked if enough of its shingles occur in another class.
   Blocks of texts send each shingle once, as part of a packed array, to the part of the hash range it
   belongs to; what comes back, one packed array for each block and part, is the number of shared shingles of each class.
2. Groups.  Under the first order (rare shingles first), linked classes share a shingle in their
   prefixes: the first shingles of the order, as many as a linked partner cannot all miss.
   Classes connected by shared prefix shingles form a group; links never leave a group.
3. Verification.  A group is cut into blocks, and each pair of blocks is one unit of work.  In a
   unit, pairs must share prefix shingles under every order and be of
   fitting size; those that do, and are not connected yet, have their common shingles counted
   exactly.  Only links that connect are returned, at most one for each member of a unit.
4. Components of the links.

Shingles are 64-bit hashes, classes are known by 128-bit hashes of their sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField

from canvass.llm.arrow import add_columns, by_row, give_back, release, small, stored
from canvass.llm.graph import components

# Factors of the orders: shingles are sorted by their hash times the factor, in the first order after their frequency.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
# Shingles of a task that are packed together.
PACK = 4_000_000
# Shingles in a block of a group; each class counts MEMBER more.
BLOCK, MEMBER = 400_000, 256
CACHED_WORDS = 400_000

FACTOR = np.uint64(0xD6E8FEB86659FD93)
FOLD = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * FOLD[0]
    x = (x ^ (x >> np.uint64(27))) * FOLD[1]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of a text.

    Words are runs of other bytes than blanks and ASCII controls 9 to 13, with A to Z in lower case.
    """

    def __init__(self, size: int) -> None:
        self.size = size
        self.words: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        split = (text or "").encode("utf-8").lower().split()
        known = self.words
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in split:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        words = np.array([known[w] for w in split], np.uint64)
        size = min(self.size, len(words))
        if not size:
            return words
        places = len(words) - size + 1
        total = np.full(places, size, np.uint64)
        for k in range(size):
            total = total * FACTOR + words[k : k + places]
        return np.unique(mixed(total))


def class_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes())


class Threshold:
    """Links have `part` * union <= `whole` * intersection."""

    def __init__(self, part: int, whole: int) -> None:
        self.part, self.whole = part, whole

    def least_common(self, n):
        """Shingles that a set of n has to share with any partner."""
        return -(-self.part * n // self.whole)

    def prefix(self, n):
        return n - self.least_common(n) + 1

    def links(self, common, a, b):
        return self.whole * common >= self.part * (a + b - common)


def classes_of(df: DataFrame, id_col: str, text: str, size: int) -> DataFrame:
    """Columns id, digest (of the text), n (shingles), key (of the class), ref (part of the key)."""

    def make() -> Callable[[str | None], tuple]:
        release()
        shingler = Shingler(size)

        def row(value: str | None) -> tuple:
            found = shingler.shingles(value)
            key = class_key(found)
            return len(found), key, reference(key)

        return row

    source = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    fields = [StructField("n", IntegerType()), StructField("key", BinaryType()), StructField("ref", LongType())]
    return add_columns(source, ["text"], fields, by_row(make)).drop("text")


def shingle_rows(df: DataFrame, text: str, size: int) -> DataFrame:
    """Columns key, n, shingles (packed, sorted) of each text that has any."""

    def make() -> Callable[[str | None], tuple]:
        release()
        shingler = Shingler(size)

        def row(value: str | None) -> tuple:
            found = shingler.shingles(value)
            return class_key(found), len(found), found.tobytes()

        return row

    fields = [StructField("key", BinaryType()), StructField("n", IntegerType()), StructField("shingles", BinaryType())]
    return add_columns(df.select(F.col(text).alias("text")), ["text"], fields, by_row(make)).drop("text").where("n > 0")


def reference(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


PACKED = "pack long, part int, refs binary, sizes binary, shingles binary, common binary, done binary, shared binary, whole binary"


KINDS = {"pack": pa.int64(), "part": pa.int32()}


def packs(pack: int, classes: list[tuple[int, np.ndarray]], parts: int) -> Iterator[dict]:
    """One row of a pack for each part of the hash range from distinct classes (reference, shingles).

    Shingles of one class go with its reference; those of several are counted here, and go
    once and without one.
    """
    refs = np.array([r for r, _ in classes], np.int64)
    sizes = np.array([len(s) for _, s in classes])
    flat, owner = np.concatenate([s for _, s in classes]), np.repeat(np.arange(len(classes)), sizes)
    order = np.argsort(flat)
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    single = np.diff(np.r_[first, len(flat)]) == 1
    shared = np.bincount(owner[~np.repeat(single, np.diff(np.r_[first, len(flat)]))], minlength=len(classes))
    alone, common = first[single], flat[first[~single]]
    tokens, owner = flat[alone], owner[alone]
    # parts are ranges of the upper half of the hash, so rows of a part are neighbours
    bounds = part_bounds(parts)
    cut = np.searchsorted(tokens >> np.uint64(32), bounds)
    cut_common = np.searchsorted(common >> np.uint64(32), bounds)
    home = refs % parts
    for p in range(parts):
        own, mine = owner[cut[p] : cut[p + 1]], np.flatnonzero(home == p)
        by_owner = np.argsort(own, kind="stable")
        present, counts = np.unique(own, return_counts=True)
        yield {
            "pack": pack, "part": p,
            "refs": refs[present].tobytes(),
            "sizes": counts.astype(np.uint32).tobytes(),
            "shingles": tokens[cut[p] : cut[p + 1]][by_owner].astype(np.uint32).tobytes(),
            "common": common[cut_common[p] : cut_common[p + 1]].astype(np.uint32).tobytes(),
            "done": refs[mine].tobytes(),
            "shared": shared[mine].astype(np.uint32).tobytes(),
            "whole": sizes[mine].astype(np.uint32).tobytes(),
        }


def count_shared(table: pa.Table) -> pa.Table:
    """For one part: how many of the shingles of each class of a pack occur in another class, packed like the question."""

    def gather(name: str, kind) -> np.ndarray:
        return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table[name]] or [np.zeros(0, kind)])

    asked = gather("refs", np.int64)
    refs, of_row = np.unique(asked, return_inverse=True)
    of = np.repeat(of_row, gather("sizes", np.uint32)).astype(np.uint64)
    # copies of a class in other packs count once
    pairs = np.unique(gather("shingles", np.uint32).astype(np.uint64) << np.uint64(32) | of)
    tokens = pairs >> np.uint64(32)
    again = np.zeros(len(tokens), bool)
    again[1:] = tokens[1:] == tokens[:-1]
    again[:-1] |= again[1:]
    common = np.unique(gather("common", np.uint32)).astype(np.uint64)
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        again |= common[at] == tokens
    shared = np.bincount((pairs[again] & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=len(refs))
    told = shared[of_row].astype(np.uint32)
    ends = np.cumsum([len(x.as_buffer()) // 8 for x in table["refs"]]).tolist()
    answers = [told[a:b].tobytes() for a, b in zip([0, *ends], ends)]
    del pairs, tokens, again, common, of
    give_back()
    return table.select(["pack", "refs", "done", "shared", "whole"]).append_column("told", pa.array(answers, pa.binary()))


COUNTED = "pack long, refs binary, done binary, shared binary, whole binary, told binary"


def enough_shared(limit: Threshold) -> Callable[[pa.Table], pa.Table]:
    """References of the classes of a pack that share enough, from what each part told and the pack itself knew."""

    def run(table: pa.Table) -> pa.Table:
        def gather(name: str, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table[name]])

        refs, order = np.unique(gather("done", np.int64), return_index=True)
        shared = gather("shared", np.uint32)[order].astype(np.int64)
        n = gather("whole", np.uint32)[order].astype(np.int64)
        shared += np.bincount(np.searchsorted(refs, gather("refs", np.int64)), gather("told", np.uint32), len(refs)).astype(np.int64)
        return pa.table({"ref": refs[shared * limit.whole >= n * limit.part]})

    return run


def supported(df: DataFrame, text: str, size: int, limit: Threshold, parts: int) -> DataFrame:
    """Column ref: references of the classes that share enough shingles with others.

    Hashes are shortened to the part and 32 bits here, which can only let a class pass that need not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        shingler = Shingler(size)
        held: dict[int, np.ndarray] = {}
        total = 0
        # the same for a repeated task, which reads the same rows
        number = itertools.count(TaskContext.get().partitionId() << 32)

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                for row in packs(next(number), list(held.items()), parts):
                    yield pa.RecordBatch.from_pydict({k: pa.array([v], KINDS.get(k, pa.binary())) for k, v in row.items()})
            held.clear()

        for batch in batches:
            for value in batch.column(0):
                found = shingler.shingles(value.as_py())
                if len(found):
                    ref = reference(class_key(found))
                    if ref not in held:
                        held[ref] = found
                        total += len(found)
                if total >= PACK:
                    yield from flush()
                    total = 0
        yield from flush()
        give_back()

    packed = df.select(F.col(text).alias("text")).mapInArrow(run, PACKED)
    counted = packed.groupBy("part").applyInArrow(count_shared, COUNTED)
    return counted.groupBy("pack").applyInArrow(enough_shared(limit), "ref long").distinct()


def gathered(sets: DataFrame) -> DataFrame:
    """Rows of `sets` in packs of bounded size: pack, keys, sizes, shingles (of distinct classes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, found, total = [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "pack": pa.array([reference(keys[0])], pa.int64()), "keys": pa.array([b"".join(keys)], pa.binary()),
                "sizes": pa.array([np.array([len(f) // 8 for f in found], np.uint32).tobytes()], pa.binary()),
                "shingles": pa.array([b"".join(found)], pa.binary()),
            })

        for batch in batches:
            for key, packed in zip(*[c.to_pylist() for c in batch.columns]):
                keys.append(key)
                found.append(packed)
                total += len(packed) // 8
                if total >= PACK // 4:
                    yield flush()
                    keys, found, total = [], [], 0
        if keys:
            yield flush()
            keys.clear()
            found.clear()
        give_back()

    return sets.select("key", "shingles").mapInArrow(run, "pack long, keys binary, sizes binary, shingles binary")


def members(pack: dict) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Keys, sizes, and all shingles of a pack."""
    keys = [pack["keys"][i : i + 16] for i in range(0, len(pack["keys"]), 16)]
    return keys, np.frombuffer(pack["sizes"], np.uint32).astype(np.int64), np.frombuffer(pack["shingles"], np.uint64)


def scattered(packs: DataFrame) -> DataFrame:
    """Columns key, n, shingles: the rows that `gathered` put into packs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.to_pylist():
                keys, sizes, flat = members(pack)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(keys, pa.binary()), "n": pa.array(sizes, pa.int32()),
                    "shingles": pa.array([part.tobytes() for part in np.split(flat, np.cumsum(sizes)[:-1])], pa.binary()),
                })
        give_back()

    return packs.mapInArrow(run, "key binary, n int, shingles binary")


def part_bounds(parts: int) -> np.ndarray:
    """Parts of the hash range by the upper half of a hash."""
    return np.array([-(-(p << 32) // parts) for p in range(parts)] + [1 << 32], np.uint64)


def levels_of(packs: DataFrame, parts: int) -> DataFrame:
    """Columns pack, part, levels: for the sorted distinct shingles of a pack, the binary logarithm of their number of classes.

    A pack sends each shingle once with its own count, so a frequent one meets in one row for each pack at most.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.to_pylist():
                tokens, counts = np.unique(members(pack)[2], return_counts=True)
                cut = np.searchsorted(tokens >> np.uint64(32), part_bounds(parts))
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(range(parts), pa.int32()), "pack": pa.array([pack["pack"]] * parts, pa.int64()),
                    "shingles": pa.array([tokens[a:b].astype(np.uint32).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                    "counts": pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                })
        give_back()

    def count(table: pa.Table) -> pa.Table:
        found = [np.frombuffer(x.as_buffer(), np.uint32) for x in table["shingles"]]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["counts"]])
        tokens, which = np.unique(np.concatenate(found), return_inverse=True)
        level = np.log2(np.maximum(np.bincount(which, counts, len(tokens)), 1)).astype(np.uint8)[which]
        ends = np.cumsum([len(f) for f in found])
        return pa.table({
            "pack": table["pack"], "part": table["part"],
            "levels": pa.array([level[e - len(f) : e].tobytes() for e, f in zip(ends, found)], pa.binary()),
        })

    sent = packs.mapInArrow(send, "part int, pack long, shingles binary, counts binary")
    return sent.groupBy("part").applyInArrow(count, "pack long, part int, levels binary")


def prefix_rows(packs: DataFrame, limit: Threshold, parts: int) -> DataFrame:
    """Columns shingle and key: prefixes under the first order (rare before frequent, then by hash).

    Shingles of one class only are left out, and classes that share too few of theirs.
    """

    def run(pack: pa.Table, levels: pa.Table) -> pa.Table:
        keys, sizes, flat = members(pack.to_pylist()[0])
        tokens, which = np.unique(flat, return_inverse=True)
        level = np.frombuffer(b"".join(levels.sort_by("part")["levels"].to_pylist()), np.uint8)
        owner = np.repeat(np.arange(len(keys)), sizes)
        rank = np.empty(len(tokens), np.int64)
        rank[np.lexsort((tokens * np.uint64(ORDERS[0]), level))] = np.arange(len(tokens))
        order = np.lexsort((rank[which], owner))
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        shared = np.bincount(owner, level[which] > 0, len(keys)) >= limit.least_common(sizes)
        chosen = (place < np.repeat(limit.prefix(sizes), sizes)) & (level[which[order]] > 0) & np.repeat(shared, sizes)
        return pa.table({
            "shingle": pa.array(flat[order][chosen].view(np.int64)),
            "key": pa.array(keys, pa.binary()).take(pa.array(owner[order][chosen])),
        })

    levels = levels_of(packs, parts)
    return packs.groupBy("pack").cogroup(levels.groupBy("pack")).applyInArrow(run, "shingle long, key binary")


class Unit:
    """The classes of one block, or of two, with an index of their shingles."""

    def __init__(self, sets: list[np.ndarray], sides: np.ndarray, limit: Threshold) -> None:
        self.limit, self.sides = limit, sides
        self.sizes = np.array([len(s) for s in sets])
        self.starts = np.cumsum(self.sizes) - self.sizes
        tokens, self.ids = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.all = self.index(self.ids, owner, len(tokens))
        place = np.arange(len(owner)) - np.repeat(self.starts, self.sizes)
        keeps = place < np.repeat(limit.prefix(self.sizes), self.sizes)
        self.orders = []
        for factor in ORDERS:
            rank = np.empty(len(tokens), np.int64)
            rank[np.argsort(tokens * np.uint64(factor))] = np.arange(len(tokens))
            sorted_ids = self.ids[np.lexsort((rank[self.ids], owner))]
            prefixes = np.split(sorted_ids[keeps], np.cumsum(limit.prefix(self.sizes))[:-1])
            self.orders.append((prefixes, self.index(sorted_ids[keeps], owner[keeps], len(tokens))))

    @staticmethod
    def index(ids: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Owners of each id, those of an id together, and where each id's begin."""
        return owner[np.argsort(ids, kind="stable")], np.r_[0, np.cumsum(np.bincount(ids, minlength=size))]

    @staticmethod
    def owners(index: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> np.ndarray:
        owners, begin = index
        return np.concatenate([owners[begin[i] : begin[i + 1]] for i in ids.tolist()])

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that connect what was not connected before; members are sorted by size."""
        group = np.arange(len(self.sizes))
        for i in range(1, len(group)):
            open_ = (group[:i] != group[i]) & (self.sizes[:i] * self.limit.whole >= self.sizes[i] * self.limit.part)
            if self.sides.any() and not self.sides.all():
                open_ &= self.sides[:i] != self.sides[i]
            for prefixes, index in self.orders:
                if not open_.any():
                    break
                shares = np.zeros(len(group), bool)
                shares[self.owners(index, prefixes[i])] = True
                open_ &= shares[:i]
            if not open_.any():
                continue
            own = self.ids[self.starts[i] : self.starts[i] + self.sizes[i]]
            common = np.bincount(self.owners(self.all, own), minlength=len(group))[:i]
            for j in np.flatnonzero(open_ & self.limit.links(common, self.sizes[:i], self.sizes[i])).tolist():
                if group[j] != group[i]:
                    yield i, j
                    group[group == group[j]] = group[i]


def unit_links(limit: Threshold) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        keys = table["key"].to_pylist()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        order = sorted(range(len(keys)), key=lambda i: (len(sets[i]), keys[i]))
        crossing = table["low"][0].as_py() != table["high"][0].as_py()
        sides = np.array([crossing and table["block"][i].as_py() == table["high"][0].as_py() for i in order], bool)
        unit = Unit([sets[i] for i in order], sides, limit) if len(keys) > 1 else None
        found = [(keys[order[i]], keys[order[j]]) for i, j in unit.links()] if unit and (not crossing or 0 < sides.sum() < len(sides)) else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return run


def class_links(df: DataFrame, classes: DataFrame, id_col: str, text: str, size: int, limit: Threshold) -> DataFrame:
    """Columns a, b: links between classes, enough to connect all that are linked."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    refs = supported(df, text, size, limit, parts)
    shared = classes.where("n > 0").groupBy("key", "ref").agg(F.min("id").alias("id")).join(refs, "ref", "left_semi")
    chosen = small(stored(shared.select(F.col("id").alias("chosen")).distinct()), 16)
    texts = df.join(chosen, df[id_col].eqNullSafe(F.col("chosen")), "left_semi")
    packs = stored(gathered(shingle_rows(texts, text, size).groupBy("key").agg(F.first("shingles").alias("shingles"))))
    rows = stored(prefix_rows(packs, limit, parts))
    sets = scattered(packs)
    heads = rows.groupBy("shingle").agg(F.min("key").alias("head"), F.count("*").alias("m")).where("m > 1").drop("m")
    # a class meets the smallest class of each of its shingles; these meet each other here, so that few edges remain
    met = rows.join(heads, "shingle").groupBy("key").agg(F.collect_set("head").alias("heads"))
    edges = met.select(F.explode(F.array_append("heads", F.col("key"))).alias("a"), F.array_min("heads").alias("b"))
    groups = components(edges).withColumnRenamed("node", "key")
    sized = groups.join(classes.select("key", "n").distinct(), "key")
    weights = sized.groupBy("root").agg(F.ceil(F.sum(F.col("n") + MEMBER) / BLOCK).cast("int").alias("blocks"))
    plan = stored(groups.join(weights, "root").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")))
    dealt = sets.drop("n").join(small(plan, 64), "key")
    units = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "key", "shingles"
    )
    return units.groupBy("root", "low", "high").applyInArrow(unit_links(limit), "a binary, b binary")


def similar_rows(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 4, part: int = 85, whole: int = 100
) -> DataFrame:
    """Columns id, digest, n, key, root and component_id: one row for each row of `df`.

    Two rows link when whole * |intersection| >= part * |union| of their sets of distinct
    `size`-word shingles; a shorter text is one shingle, one without words (or null) has none and is linked
    with nothing.  component_id is the smallest id reachable by links; its own id for a row without links.
    Repeated rows and texts are linked with each other.  Rows with a null id are
    linked like others; the component of rows with null ids only is null.  An empty table gives no rows.
    """
    limit = Threshold(part, whole)
    classes = stored(classes_of(df, id_col, text, size))
    links = stored(class_links(df, classes, id_col, text, size, limit))
    roots = components(links).withColumnRenamed("node", "key")
    first = classes.where("n > 0").groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("m"))
    smallest = first.join(roots, "key").groupBy("root").agg(F.min("first").alias("smallest"))
    linked = roots.join(smallest, "root")
    known = first.join(linked, "key", "left").where("m > 1 or root is not null").select(
        "key", F.coalesce("root", "key").alias("root"), F.coalesce("smallest", "first").alias("smallest")
    )
    labelled = classes.join(known.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & (F.col("n") > 0), "left")
    return labelled.select("id", "digest", "n", "key", "root", F.coalesce("smallest", "id").alias("component_id"))


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, part: int = 80, whole: int = 100
) -> DataFrame:
    """`docs` with one row of each component: that with the smallest id, the last being null; texts without words stay.

    Columns stay as they are.
    """
    rows = similar_rows(docs, id_col, text, size, part, whole).withColumn("group", F.coalesce("root", "key"))
    best = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest")).alias("best")
    kept = rows.where("n > 0").groupBy("group").agg(best).select("best.id", "best.digest")
    others = rows.where("n > 0").join(
        kept.select(F.col("id").alias("kid"), F.col("digest").alias("kdigest")),
        F.col("id").eqNullSafe(F.col("kid")) & (F.col("digest") == F.col("kdigest")), "left_anti",
    )
    dropped = stored(others.select("id", "digest").distinct())
    digest = F.xxhash64(text)
    left = docs.withColumn("__digest", digest).join(
        small(dropped, 24), docs[id_col].eqNullSafe(dropped["id"]) & (F.col("__digest") == dropped["digest"]), "left_anti"
    )
    # rows that repeat both id and text
    number = F.row_number().over(Window.partitionBy(id_col, "__digest").orderBy(F.xxhash64(*docs.columns)))
    bare = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]", "")) == 0
    return left.withColumn("__number", number).where((F.col("__number") == 1) | bare).select(*[f"`{c}`" for c in docs.columns])
