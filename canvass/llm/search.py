"""Exact BM25 top-k: an inverted index for each shard, read from the rarest term up, merged by global statistics.

Each text is cut into terms once, for the index of its shard, which is stored.  Document frequencies and the mean length
are counted from the shards over all texts.  Shards lie in a few groups, and each group meets each block of queries in one
task, which reads the stored shards one after the other, so neither shards nor queries are copied for the pairs.  The index
has the highest weight of every term.  The sum of these maxima over the terms of a query that are not read yet bounds what
they add, so documents that cannot reach the k-th best sum of all shards read so far are passed over as soon as the bound
allows.  The best of all groups are merged.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from canvass.llm.arrow import SLICE, add_columns, by_row, give_back, stored

K1, B = 1.2, 0.75
# Bytes of text and documents in a shard, of which an executor has one for each core, and queries in a block.
SHARD_BYTES = 32 << 20
SHARD_DOCS = 1 << 16
QUERY_BLOCK = 2048
# Groups of shards.  Each sends its best k for a query, so their number must not grow with the documents.
GROUPS = 8
# Bytes of pairs that Spark sends to a worker at once, unless the session names another number than Spark's 64 MiB.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES, SPARK_BYTES = f"{8 << 20}b", f"{64 << 20}b"
# A term that more than this share of a shard's documents have is added for many queries at once, by a matrix of this many bytes;
# the sums of these queries take as many at most.
DENSE_SHARE, DENSE_BYTES, DENSE_QUERIES = 1 / 16, 32 << 20, 128
# If at most this share of the documents is open, their rows of the matrix are read instead.
FEW = 1 / 16
# Scores are compared by this many decimals, so that the order of additions does not matter.
DECIMALS = 9

# Bytes of terms as they count, blanks for all others.
LETTERS = bytes(c if re.match(rb"[0-9a-z\x80-\xff]", bytes([c])) else 32 for c in bytes(range(256)).lower())


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all other than ASCII characters, A to Z in lower case."""
    return (text or "").encode("utf-8").translate(LETTERS).split()


def term_hash(term: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(term)
    return value - (1 << 64) if value >> 63 else value


def term_hashes(terms: Collection[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms)).view(np.int64)


def inverted(terms: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct terms of documents with their numbers of documents; by term, the places of documents and the counts."""
    sizes = np.array([len(t) for t in terms], np.int64)
    flat = np.concatenate([*terms, np.zeros(0, np.int64)])
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    begin = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]][: len(flat)])
    doc = np.repeat(np.arange(len(terms), dtype=np.uint16 if len(terms) <= SHARD_DOCS else np.int32), sizes)[order]
    return flat[begin], np.diff(np.r_[begin, len(flat)]), doc, np.concatenate([*times, np.zeros(0, np.uint32)])[order]


SHARD = "shard long, rows long, words binary, ids binary, terms binary, sizes binary, places binary, times binary"


def shards_of(docs: DataFrame) -> DataFrame:
    """Inverted shards of `docs` (id, text), whose documents lie by id, nulls last and without a place in `ids`; packed arrays are compressed."""
    most = SHARD_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids, terms, times, taken = [], [], [], 0

        def flush() -> pa.RecordBatch:
            order = sorted(range(len(ids)), key=lambda n: (ids[n] is None, ids[n] or 0))
            known, sizes, places, counts = inverted([terms[n] for n in order], [times[n] for n in order])
            arrays = {
                "words": np.array([times[n].sum() for n in order], np.int64), "ids": np.array([ids[n] for n in order if ids[n] is not None], np.int64),
                "terms": known, "sizes": sizes.astype(np.uint32), "places": places.astype(np.uint16), "times": counts.astype(np.min_scalar_type(counts.max(initial=0))),
            }
            sent = pa.RecordBatch.from_pydict({
                "shard": pa.array([(task << 32) + made], pa.int64()), "rows": pa.array([len(ids)], pa.int64()),
                **{name: pa.array([zlib.compress(values.tobytes(), 1)], pa.binary()) for name, values in arrays.items()},
            })
            for held in (ids, terms, times):
                held.clear()
            return sent

        for part in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            for i, value in zip(*[c.to_pylist() for c in part.columns]):
                counts = Counter(terms_of(value))
                ids.append(i)
                terms.append(term_hashes(counts))
                times.append(np.fromiter(counts.values(), np.uint32, len(counts)))
                taken += len((value or "").encode())
                if taken >= most or len(ids) == SHARD_DOCS:
                    yield flush()
                    made, taken = made + 1, 0
        if ids:
            yield flush()
        give_back()

    return docs.select(F.col("id").cast("long"), "text").mapInArrow(run, SHARD)


def statistics(shards: DataFrame) -> DataFrame:
    """Columns term, docs, words: documents with each term; in the row of the null term, all documents and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for n, words, terms, sizes in zip(part["rows"].to_pylist(), *[part[c] for c in ("words", "terms", "sizes")]):
                known = np.frombuffer(zlib.decompress(terms.as_buffer()), np.int64)
                docs = np.frombuffer(zlib.decompress(sizes.as_buffer()), np.uint32).astype(np.int64)
                whole = int(np.frombuffer(zlib.decompress(words.as_buffer()), np.int64).sum())
                yield pa.RecordBatch.from_pydict({
                    "term": pa.array([None], pa.int64()), "docs": pa.array([n], pa.int64()), "words": pa.array([whole], pa.int64()),
                })
                yield pa.RecordBatch.from_pydict({"term": known, "docs": docs, "words": np.zeros(len(known), np.int64)})

    partial = shards.select("rows", "words", "terms", "sizes").mapInArrow(run, "term long, docs long, words long")
    return partial.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words"))


class Index:
    """Postings by term with the highest weight of each term; terms of many documents as columns of a matrix, too.

    The matrix has single precision.  It tells which documents can be among the best; their scores are then counted anew
    from the numbers of the terms, so they are those of double precision.  With `asked` (sorted), only the postings of these
    terms are kept.  `touched` counts the postings that were read.
    """

    def __init__(
        self, terms: list[np.ndarray], times: list[np.ndarray], words: np.ndarray, mean: float, asked: np.ndarray | None = None
    ) -> None:
        self.read(*inverted(terms, times), words, mean, asked)

    @classmethod
    def of(cls, raw: dict[str, bytes], mean: float, asked: np.ndarray) -> Index:
        """The index of the arrays of a row of `shards_of`."""
        kinds = {"terms": np.int64, "sizes": np.uint32, "places": np.uint16, "times": None, "words": np.int64}
        kinds["times"] = f"u{2 * len(raw['times']) // max(1, len(raw['places'])) or 1}"  # the narrowest that holds all counts
        index = cls.__new__(cls)
        index.read(*[np.frombuffer(raw[name], kind) for name, kind in kinds.items()], mean, asked)
        return index

    def read(
        self, terms: np.ndarray, sizes: np.ndarray, doc: np.ndarray, times: np.ndarray, words: np.ndarray, mean: float, asked: np.ndarray | None
    ) -> None:
        self.docs, self.touched, size = len(words), 0, sizes.astype(np.int64)
        if asked is not None:
            own = np.zeros(len(terms), bool)
            own[self.find(terms, asked)[1]] = True
            kept = np.repeat(own, size)
            terms, size, doc, times = terms[own], size[own], doc[kept], times[kept]
            del kept
        self.terms, self.doc, self.size = terms, doc, size
        self.norm = K1 * (1 - B + B * words / mean)
        bottom = self.norm[doc]
        weight = times.astype(np.float64)
        bottom += weight
        weight *= K1 + 1
        weight /= bottom
        del bottom
        self.weight = weight
        self.start = np.r_[0, np.cumsum(size)]
        self.most = np.maximum.reduceat(weight, self.start[:-1]) if len(doc) else np.zeros(0)
        frequent = np.argsort(-size, kind="stable")[: DENSE_BYTES // ((4 + times.itemsize) * max(1, self.docs))]
        frequent = np.sort(frequent[size[frequent] > DENSE_SHARE * self.docs])
        self.column = np.full(len(terms), -1)
        self.column[frequent] = np.arange(len(frequent))
        rows, self.times = (np.zeros((len(frequent), self.docs), kind) for kind in (np.float32, times.dtype))
        for row, counts, begin, end in zip(rows, self.times, self.start[frequent].tolist(), self.start[frequent + 1].tolist()):
            row[doc[begin:end]] = weight[begin:end]
            counts[doc[begin:end]] = times[begin:end]
        self.dense = np.ascontiguousarray(rows.T)
        del rows
        # by what share sums of numbers of no sign may be off in single precision, and twice that
        self.off = (len(frequent) + 8) * 2.0**-23

    @staticmethod
    def find(terms: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the asked are among the sorted terms, and their places."""
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(terms, asked), len(terms) - 1)
        known = np.flatnonzero(terms[at] == asked)
        return known, at[known]

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        return self.tops([terms], [weights], k, [floor])[0]

    def tops(self, terms: list[np.ndarray], weights: list[np.ndarray], k: int, floors: list[float]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the documents with the k highest positive scores, and the scores; lower places first among equals.

        Terms add to the documents' scores from the rarest up, until no document can reach the k-th best sum with what
        the other terms can add.  Dense terms come last, for the documents that can still reach it; if these are many, for
        many queries together.  Documents with less than the floor of the query, the k-th best score elsewhere, are left out.
        """
        sizes = np.array([len(t) for t in terms], np.int64)
        known, at = self.find(self.terms, np.concatenate([*terms, np.zeros(0, np.int64)]))
        query = np.repeat(np.arange(len(terms)), sizes)[known]
        order = np.lexsort((self.size[at], query))
        return self.tops_at(query[order], at[order], np.concatenate([*weights, np.zeros(0)])[known][order], k, floors)

    def tops_at(self, query: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int, floors: list[float]) -> list[tuple[np.ndarray, np.ndarray]]:
        """`tops` of queries 0, 1, ..., told by the place of each of their terms, sorted by query, rare terms first."""
        out: list = [None] * len(floors)
        many = min(DENSE_QUERIES, max(1, DENSE_BYTES // (8 * self.docs)))
        for first in range(0, len(floors), many):
            some = np.arange(first, min(first + many, len(floors)) + 1)
            part = slice(*np.searchsorted(query, some[[0, -1]]))
            dense = self.column[at[part]] >= 0
            of, at_, own, ends = [], [], [], []
            for kind in (~dense, dense):
                for held, values in zip((of, at_, own), (query, at, weights)):
                    held.append(values[part][kind])
                ends.append(np.searchsorted(of[-1], some).tolist())
            size, bound = self.size[at_[0]], own[0] * self.most[at_[0]]
            above = np.bincount(of[1] - first, own[1] * self.most[at_[1]], len(some) - 1).tolist()
            open_ = []
            for n, q in enumerate(some[:-1].tolist()):
                sparse, last = (slice(e[n], e[n + 1]) for e in ends)
                last = at_[1][last], own[1][last]
                out[q], sums = self.rare(at_[0][sparse], own[0][sparse], size[sparse], bound[sparse], *last, above[n], k, floors[q])
                if out[q] is None:
                    open_.append((q, sums, *last))
            if not open_:
                continue
            factors = np.zeros((len(open_), self.dense.shape[1]), np.float32)
            for row, (_, _, places, values) in zip(factors, open_):
                row[self.column[places]] = values
                self.touched += int(self.size[places].sum())
            for (q, sums, *last), near in zip(open_, factors @ self.dense.T):
                near += sums
                out[q] = self.exact(None, near, sums, *last, k, floors[q])
        return out

    def rare(
        self, at: np.ndarray, weights: np.ndarray, size: np.ndarray, bound: np.ndarray, dense: np.ndarray, factors: np.ndarray, above: float, k: int, floor: float
    ) -> tuple[tuple[np.ndarray, np.ndarray] | None, np.ndarray | None]:
        """The best documents of a query, or else the sums of its terms that are not dense; the dense ones add at most `above`."""
        until = len(at)
        rest, read = np.full(until + 1, float(above)), np.zeros(until + 1, np.int64)
        rest[:-1] += bound[::-1].cumsum()[::-1]
        size.cumsum(out=read[1:])
        start = self.start[at] - read[:-1]
        near = 10.0**-DECIMALS
        sums, done, step, open_ = None, 0, self.docs, None
        while True:
            least, left = floor, float(rest[done])
            if done and np.count_nonzero(sums > max(floor, left)) >= k:
                least = np.partition(sums, self.docs - k)[self.docs - k]
            if left < least - near or not left:
                open_ = np.flatnonzero(sums >= least - near - left) if done else np.zeros(0, np.int64)
            if done == until or open_ is not None and not len(open_):
                break
            end = min(until, max(done + 1, int(read.searchsorted(read[done] + step, "right")) - 1))
            part, begin, count = size[done:end], int(read[done]), int(read[end] - read[done])
            places = start[done:end].repeat(part)
            places += np.arange(begin, begin + count)
            value = self.weight.take(places)
            value *= weights[done:end].repeat(part)
            more = np.bincount(self.doc.take(places), value, self.docs)
            sums = more if sums is None else np.add(sums, more, out=sums)
            self.touched += count
            done, step = end, 2 * step
        if open_ is not None and not len(open_):
            return (open_, np.zeros(0)), None
        if sums is None:
            sums = np.zeros(self.docs)
        if not len(dense):
            open_ = np.arange(self.docs) if open_ is None else open_
            return self.best(open_, sums[open_], k, floor), None
        if open_ is None or len(open_) > FEW * self.docs:
            return None, sums
        row = np.zeros(self.dense.shape[1], np.float32)
        row[self.column[dense]] = factors
        self.touched += len(open_) * len(dense)
        return self.exact(open_, self.dense[open_] @ row + sums[open_], sums, dense, factors, k, floor), None

    def exact(
        self, docs: np.ndarray | None, near: np.ndarray, sums: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int, floor: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """The best of `docs` (None: all), whose scores are `near`, scored from the sums of the rare and the counts of the dense terms."""
        least = floor * (1 - self.off) - 10.0**-DECIMALS
        high = np.flatnonzero(near >= least) if least > 0 else np.flatnonzero(near)
        if not len(high):
            return np.zeros(0, np.int64), np.zeros(0)
        if len(high) > k:
            reach = near[high].astype(np.float64)
            least = np.partition(reach, len(reach) - k)[len(reach) - k] * (1 - 2 * self.off) - 10.0**-DECIMALS
            high = high[reach >= least]
        docs = high if docs is None else docs[high]
        times = self.times[np.ix_(self.column[at], docs)].astype(np.float64)
        return self.best(docs, sums[docs] + weights @ (times * (K1 + 1) / (times + self.norm[docs])), k, floor)

    @staticmethod
    def best(docs: np.ndarray, sums: np.ndarray, k: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        if floor > 0:
            reach = np.flatnonzero(sums >= floor - 10.0**-DECIMALS)
            docs, sums = docs[reach], sums[reach]
        scores = np.round(sums, DECIMALS)
        if len(scores) > k:
            high = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
            docs, scores = docs[high], scores[high]
        found = np.lexsort((docs, -scores))[:k]
        found = found[scores[found] > 0]
        return docs[found], scores[found]


class Block:
    """A block of queries and the best k documents of each among the shards that were read."""

    def __init__(self, queries: pa.Array, k: int, mean: float) -> None:
        # copies, as the batch goes
        of = dict(zip([f.name for f in queries.type], queries.flatten()))
        self.query_id, self.digest = np.array(of["query_id"]), np.array(of["query_digest"])
        terms = [np.frombuffer(x.as_py(), np.int64) for x in of["q_terms"]]
        weights = [np.frombuffer(x.as_py(), np.float64) for x in of["q_weights"]]
        self.query = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        order = np.lexsort((-np.concatenate([*weights, np.zeros(0)]), self.query))
        self.weights = np.concatenate([*weights, np.zeros(0)])[order]
        self.known, self.spots = np.unique(np.concatenate([*terms, np.zeros(0, np.int64)])[order], return_inverse=True)
        self.k, self.mean, self.floor = k, mean, np.zeros(len(terms))
        # of each kept document: the query, whether the id is null, the id, the score
        self.kept = [np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0)]

    def meet(self, shard: dict[str, bytes]) -> None:
        index, ids = Index.of(shard, self.mean, self.known), np.frombuffer(shard["ids"], np.int64)
        ids, absent = np.r_[ids, np.zeros(index.docs - len(ids), np.int64)], np.arange(index.docs) >= len(ids)
        place = np.full(len(self.known), -1)
        known, at = index.find(index.terms, self.known)
        place[known] = at
        at = place[self.spots]
        known = np.flatnonzero(at >= 0)
        best = index.tops_at(self.query[known], at[known], self.weights[known], self.k, self.floor.tolist())
        docs, scores = (np.concatenate([b[n] for b in best]) for n in (0, 1))
        query = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
        query, null, ids, scores = (np.r_[a, b] for a, b in zip(self.kept, (query, absent[docs], ids[docs], scores)))
        order = np.lexsort((ids, null, -scores, query))
        first = np.searchsorted(query[order], np.arange(len(best)))
        place = np.arange(len(order)) - first[query[order]]
        self.kept = [a[order[place < self.k]] for a in (query, null, ids, scores)]
        last = order[place == self.k - 1]
        self.floor[query[last]] = scores[last]

    def found(self) -> pa.RecordBatch:
        query, null, ids, scores = self.kept
        return pa.RecordBatch.from_pydict({
            "query_id": self.query_id[query], "query_digest": self.digest[query], "doc_id": pa.array(ids, mask=null), "score": scores,
        })


def best_of_groups(shards: DataFrame, blocks: DataFrame, k: int, mean: float) -> DataFrame:
    """The best k of each group of `shards` for the queries of all `blocks`.  A task has one shard and one block at a time.

    Sets the session's bytes of an Arrow batch, if they are Spark's, as a task would otherwise hold pairs of 64 MiB twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, Block] = {}
        for part in batches:
            for row in range(part.num_rows):
                n = part["block"][row].as_py()
                if n not in met:
                    met[n] = Block(part["queries"][row].values, k, mean)
                met[n].meet({name: zlib.decompress(part[name][row].as_buffer()) for name in ("words", "ids", "terms", "sizes", "places", "times")})
            del part
            give_back()
        for block in met.values():
            yield block.found()
        met.clear()
        give_back()

    conf = shards.sparkSession.conf
    if conf.get(BATCH) == SPARK_BYTES:
        conf.set(BATCH, BATCH_BYTES)
    pairs = shards.coalesce(GROUPS).crossJoin(blocks)
    return pairs.mapInArrow(run, "query_id long, query_digest long, doc_id long, score double")


def search(docs: DataFrame, queries: DataFrame, k: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns query_id, doc_id, rank, score: the k best rows of `docs` for each row of `queries`, ids being integers.

    A query is the set of the terms of its whole text.  Rows without a common term are no results, so a null or empty
    query has none; rows of `queries` with a null id are no queries.  Of equal scores (rounded to nine decimals), the lower id ranks first, a null id last.
    Repeated rows of `docs` are results each; repeated rows of `queries` are one query.  Empty tables give no rows.
    """
    shards = stored(shards_of(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))))
    stats = stored(statistics(shards))
    whole = stats.where("term is null").first()
    total, words = (whole.docs, whole.words) if whole else (0, 0)
    mean = max(words, 1) / max(total, 1)
    # terms of the queries with their weights, packed again
    asked = queries.select(F.col(id_col).alias("query_id"), F.xxhash64(text).alias("query_digest"), F.col(text).alias("text")).where("query_id is not null")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            for i, digest, value in zip(*[c.to_pylist() for c in part.columns]):
                found = term_hashes(set(terms_of(value)))
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array([i] * len(found), pa.int64()), "query_digest": pa.array([digest] * len(found), pa.int64()),
                    "term": pa.array(found),
                })

    each = asked.mapInArrow(spread, "query_id long, query_digest long, term long").distinct()
    idf = F.log(1 + (F.lit(float(total)) - F.col("docs") + 0.5) / (F.col("docs") + 0.5))
    weighed = each.join(stats.where("term is not null"), "term").select("query_id", "query_digest", F.struct("term", idf.alias("idf")).alias("t"))
    packed = weighed.groupBy("query_id", "query_digest").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    def make() -> Callable[[list], tuple]:
        return lambda ts: (
            np.array([t["term"] for t in ts], np.int64).tobytes(), np.array([t["idf"] for t in ts], np.float64).tobytes()
        )

    fields = [StructField("q_terms", BinaryType()), StructField("q_weights", BinaryType())]
    ready = stored(add_columns(packed, ["ts"], fields, by_row(make)).drop("ts"))
    number = max(1, -(-ready.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("query_id", "query_digest"), F.lit(number)).alias("block")
    queries_of = ready.groupBy(block).agg(F.collect_list(F.struct("query_id", "query_digest", "q_terms", "q_weights")).alias("queries"))
    # a partition for each block
    found = best_of_groups(shards, queries_of.repartitionByRange(number, "block"), k, mean)
    order = Window.partitionBy("query_id", "query_digest").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "doc_id", "rank", "score")
