"""Alignment of the tokens of two vocabularies over the same bytes.

Both tokenisations of a text cut the same bytes, so each is told by the offsets
at which its tokens end, and the alignment by the offsets that both have.  Where
tokens are alike, the two end arrays are equal at a fixed index shift, a diagonal:
runs of doubling length are compared at once, and halved again where one differs.
Between two runs the lesser end is moved on until both agree, which gives the new
shift.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from canvass.llm.arrow import Recent, held, stored
from canvass.llm.pieces import MARK
from canvass.llm.trie_bpe import MergeTable, read_vocabulary, stretches

# A pack of rows, whose links are numbered together, ends at this number of rows or bytes of text.
PACK_ROWS = 4096
PACK_BYTES = 16 << 20
# Texts that are encoded at a time.
TEXTS = 512
# Bytes that the known stretches of one worker may take, and what one takes besides its characters.
TABLE_BYTES = 128 << 20
ENTRY_BYTES = 420


def runs_of(ends: np.ndarray, other: np.ndarray) -> list[tuple[int, int, int]]:
    """Irregular groups, each with the run of tokens alike behind it: (i, j, length).

    Tokens i of the first and j of the second end together and close a group; the
    next `length` tokens of both end together one by one.  Both arrays ascend and
    have the same last end; a text that begins with a run has (-1, -1, length) first.
    """
    n, m = len(ends), len(other)
    one, two = ends.tolist(), other.tolist()
    raw, raw_other = ends.astype("<i4").tobytes(), other.astype("<i4").tobytes()
    out = []
    i = j = 0
    group = (-1, -1)
    while True:
        # along the diagonal: double the step while all ends agree, then halve it
        begin = i
        if i < n and j < m and one[i] == two[j]:
            i += 1
            j += 1
            step, growing = 1, True
            while step:
                there, there_other = i + step, j + step
                if there <= n and there_other <= m and raw[4 * i : 4 * there] == raw_other[4 * j : 4 * there_other]:
                    i, j = there, there_other
                    step = step + step if growing else step >> 1
                else:
                    growing = False
                    step >>= 1
        out.append((*group, i - begin))
        if i >= n or j >= m:
            return out
        # an irregular group: move the lesser end on until both agree, which is the new shift
        a, b = one[i], two[j]
        while a != b:
            if a < b:
                i += 1
                a = one[i]
            else:
                j += 1
                b = two[j]
        group = (i, j)
        i += 1
        j += 1


def common_ends(runs: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Indices, in each array, of the ends that both have."""
    i, j, length = np.array(runs, np.int64).T
    ends = np.cumsum(length + 1)
    along = np.arange(ends[-1]) - np.repeat(ends - length - 1, length + 1)
    at, at_other = np.repeat(i, length + 1) + along, np.repeat(j, length + 1) + along
    return (at[1:], at_other[1:]) if runs[0][0] < 0 else (at, at_other)


def group_texts(names: list[str], names_other: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The groups that end at the common ends: `a1,a2|b1`."""
    out = []
    x = y = 0
    for i, j, length in runs:
        if i >= 0:
            out.append(",".join(names[x : i + 1]) + "|" + ",".join(names_other[y : j + 1]))
        x, y = i + 1 + length, j + 1 + length
        if length:
            out += map("|".join, zip(names[i + 1 : x], names_other[j + 1 : y]))
    return out


# What is known of a stretch: tokens of both, links, groups, and packed id pairs of the links; False if its
# bytes are not those of its tokens.
Aligned = tuple[int, int, int, str, bytes]


class Aligner:
    """Encodes with both vocabularies and aligns; each stretch once as long as it is remembered.

    A stretch begins with a blank between two other characters: no token of either
    vocabulary reaches over its start.
    """

    def __init__(self, byte_file: bytes, pattern: str, piece_file: bytes) -> None:
        import sentencepiece
        import tiktoken

        table = MergeTable(json.loads(byte_file))
        # tiktoken joins what gives a token, whatever the two parts; as long as each token's bytes
        # are encoded as that token, no other parts of it ever meet than those that its merge joins
        if not all(table.stands(t) for t in table.made):
            raise ValueError("only vocabularies that encode the bytes of each token as this token")
        self.of_rank = [*table.of_byte, *table.made]
        ranks = {table.bytes[t]: rank for rank, t in enumerate(self.of_rank)}
        self.byte = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        self.tokens = table.bytes
        self.pieces = [
            bytes([int(p[3:5], 16)]) if self.processor.is_byte(i) else p.replace(MARK, " ").encode("utf-8")
            for i in range(self.processor.get_piece_size()) for p in (self.processor.id_to_piece(i),)
        ]
        self.sizes, self.piece_sizes = (np.array([len(t) for t in x]) for x in (self.tokens, self.pieces))
        self.names, self.piece_names = ([str(i) for i in range(len(x))] for x in (self.tokens, self.pieces))
        self.known = Recent(TABLE_BYTES, lambda s, a: ENTRY_BYTES + 2 * len(s) + (len(a[3]) + len(a[4]) if a else 0))

    def align(self, texts: list[str]) -> list[list[Aligned] | None]:
        """The stretches of each text, or None for an empty text and one that the tokens do not give back."""
        # a blank and the text: the first stretch is empty, or has that blank in front of other white space
        split = [stretches(" " + t) if t else ("", []) for t in texts]
        whole = [[*([head[1:]] if head else []), *rest] for head, rest in split]
        for ss in whole:
            if len(ss) > 1 and not ss[-1]:  # a blank at the end stays with what is before it
                ss[-2:] = [ss[-2] + " "]
        new = self.known.absent(lambda known: {s for ss in whole for s in ss if s not in known})
        for s, found in zip(new, self.learn([" " + s for s in new])):
            self.known.put(s, found)
        known, out = self.known.young, []
        for ss in whole:
            found = [known[s] for s in ss]
            out.append(found if found and False not in found else None)
        return out

    def learn(self, texts: list[str]) -> list[Aligned | bool]:
        """Stretches with their first blank, aligned together as one run of bytes."""
        raw = [t.encode("utf-8") for t in texts]
        encode, of_rank = self.byte.encode_ordinary, self.of_rank
        coded = [[of_rank[r] for r in encode(t)] for t in texts]
        pieces = self.processor.encode([t[1:] for t in texts], num_threads=1) if texts else []
        good = [
            k for k, (r, a, b) in enumerate(zip(raw, coded, pieces))
            if b"".join([self.tokens[i] for i in a]) == r == b"".join([self.pieces[i] for i in b])
        ]
        out: list[Aligned | bool] = [False] * len(texts)
        if not good:
            return out
        one, two = [i for k in good for i in coded[k]], [i for k in good for i in pieces[k]]
        ids, other = np.array(one, np.int64), np.array(two, np.int64)
        ends = self.sizes[ids].cumsum()
        runs = runs_of(ends, self.piece_sizes[other].cumsum())
        at, at_other = common_ends(runs)
        groups = group_texts([self.names[i] for i in one], [self.piece_names[i] for i in two], runs)
        pairs = ((ids[at] << SECOND_BITS) | other[at_other]).astype("<i8").tobytes()
        last = np.searchsorted(ends[at], np.cumsum([len(raw[k]) for k in good]), side="right").tolist()
        for k, begin, end in zip(good, [0, *last], last):
            out[k] = (len(coded[k]), len(pieces[k]), end - begin, ";".join(groups[begin:end]), pairs[8 * begin : 8 * end])
        return out


# Bits of a pair number that hold its second id.
SECOND_BITS = 31

FIELDS = ["n_a", "n_b", "n_groups", "n_links"]


def align_tokens(df: DataFrame, vocabulary: str, model: str, text: str = "text", with_groups: bool = False) -> DataFrame:
    """How the tokens of a byte-level BPE file and of a SentencePiece BPE model align in each text.

    The first encodes a blank and the text, the second the text, to which it adds
    that blank itself; special tokens inside texts are plain text.  New columns:
    `n_a`, `n_b` (tokens), `n_groups` (cut where tokens of both end), `n_links` (pairs of
    tokens that end together), `n_best` (links whose id pair is linked as often, in the
    whole table, as any with the same second id), `count_sum` (sum over the links of
    how often their id pair is linked), `groups_sha256`, and with `with_groups` also `groups`.

    Null and empty texts, and texts that the tokens of either do not give back (such as
    one with the mark that stands for a blank), have no tokens: zeros, and ''.
    Equal rows get a row each and all count.  Very long texts are aligned whole.  An empty
    table gives no rows.  All columns but the text are kept; one named like a result is replaced.

    Rows are packed; the links of a pack are numbered, and a pack asks for each of its id
    pairs once.  So what is shuffled are id pairs of packs and two bytes or four for each link.
    """
    spark = df.sparkSession
    with open(model, "rb") as f:
        shared = spark.sparkContext.broadcast((*read_vocabulary(vocabulary), f.read()))
    made = [StructField(c, LongType()) for c in FIELDS] + [StructField("groups_sha256", StringType())]
    made += [StructField("groups", StringType())] if with_groups else []
    told = {f.name for f in made} | {"n_best", "count_sum"}
    kept = [c for c in df.columns if c != text and c.lower() not in told]
    source = df.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(kept)])
    carried = source.schema.fields[1:]
    schema = StructType([
        *carried, *made, StructField("__pack", LongType()), StructField("__at", BinaryType()), StructField("__times", BinaryType()),
        StructField("__pairs", ArrayType(LongType())), StructField("__counts", ArrayType(LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        data, pattern, pieces = shared.value
        key = tuple(hashlib.sha256(x).digest() for x in (data, pieces))
        known = held("alignment", key, lambda: Aligner(data, pattern, pieces))
        arrow = to_arrow_schema(schema)
        pack = Pack(known, arrow, len(carried), with_groups)
        for batch in batches:
            for part in (batch.slice(at, TEXTS) for at in range(0, batch.num_rows, TEXTS)):
                pack.add(part)
                if pack.full():
                    yield from pack.end()
        yield from pack.end()

    packed = stored(source.mapInArrow(run, schema))
    rows = packed.where("__pairs is null").drop("__pairs", "__counts")
    asked = packed.where("__pairs is not null").select(
        "__pack", F.posexplode(F.arrays_zip(F.col("__pairs").alias("p"), F.col("__counts").alias("c"))).alias("place", "of")
    ).select("__pack", "place", F.col("of.p").alias("pair"), F.col("of.c").alias("c"))
    counts = stored(asked.groupBy("pair").agg(F.sum("c").alias("n")))
    most = counts.groupBy(second(F.col("pair")).alias("__b")).agg(F.max("n").alias("most"))
    ranked = counts.withColumn("__b", second(F.col("pair"))).join(most, "__b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )
    answers = asked.select(F.col("__pack").alias("__of"), "place", "pair").join(ranked, "pair").select("__of", "place", "n", "best")
    sums = StructType([*carried, *made[:4], StructField("n_best", LongType()), StructField("count_sum", LongType()), *made[4:]])
    whole = rows.groupBy("__pack").cogroup(answers.groupBy("__of")).applyInArrow(sum_up, sums)
    back = [F.col(f"__{i}").alias(c) for i, c in enumerate(kept)]
    return whole.select(*back, *FIELDS, "n_best", "count_sum", *[f.name for f in made[4:]])


def second(pair: Column) -> Column:
    """The second id of a pair number."""
    return pair.bitwiseAND(F.lit((1 << SECOND_BITS) - 1))


class Pack:
    """Rows with their links, until the pack ends and its id pairs are numbered."""

    def __init__(self, known: Aligner, schema: pa.Schema, carried: int, with_groups: bool) -> None:
        self.known, self.schema, self.carried, self.with_groups = known, schema, carried, with_groups
        self.clear()

    def clear(self) -> None:
        self.parts: list[pa.RecordBatch] = []
        self.links: list[tuple[np.ndarray, np.ndarray]] = []
        self.told: list[tuple] = []
        self.bytes = 0

    def add(self, part: pa.RecordBatch) -> None:
        texts = [t or "" for t in part.column(0).to_pylist()]
        for text, found in zip(texts, self.known.align(texts)):
            self.bytes += len(text)
            n_a, n_b, n_links, groups, pairs = zip(*found) if found else ((),) * 5
            self.links.append(np.unique(np.frombuffer(b"".join(pairs), "<i8"), return_counts=True))
            whole, links = ";".join(groups), sum(n_links)
            digest = hashlib.sha256(whole.encode()).hexdigest() if found else ""
            self.told.append((sum(n_a), sum(n_b), links, links, digest, *([whole] if self.with_groups else [])))
        self.parts.append(part.select(list(range(1, part.num_columns))) if part.num_columns > 1 else part.select([]))

    def full(self) -> bool:
        return len(self.told) >= PACK_ROWS or self.bytes >= PACK_BYTES

    def end(self) -> Iterator[pa.RecordBatch]:
        """The rows, each link numbered by its place among the pack's id pairs, and a row of these pairs."""
        if not self.told:
            return
        number = uuid.uuid4().int >> 65  # written once, by the attempt that is committed
        pairs, place = np.unique(np.concatenate([p for p, _ in self.links]), return_inverse=True)
        times = np.concatenate([t for _, t in self.links])
        counts = np.bincount(place, times, len(pairs)).astype(np.int64) if len(pairs) else np.empty(0, np.int64)
        wide = "<u2" if len(pairs) <= 1 << 16 else "<u4"
        place, n = place.astype(wide), len(self.told)
        borders = np.cumsum([len(p) for p, _ in self.links])[:-1]
        carried = pa.Table.from_batches(self.parts).combine_chunks() if self.carried else None
        columns = {f.name: carried.column(k).combine_chunks() for k, f in enumerate(list(self.schema)[: self.carried])} if carried else {}
        made = self.schema.names[self.carried : -5]
        columns |= {name: [t[k] for t in self.told] for k, name in enumerate(made)}
        columns |= {
            "__pack": [number] * n, "__at": [a.tobytes() for a in np.split(place, borders)],
            "__times": [t.astype("<u4").tobytes() for _, t in self.links],
            "__pairs": pa.nulls(n, self.schema.field("__pairs").type), "__counts": pa.nulls(n, self.schema.field("__counts").type),
        }
        yield self.batch(columns, n)
        if len(pairs):
            alone = {name: pa.nulls(1, self.schema.field(name).type) for name in self.schema.names}
            yield self.batch(alone | {"__pack": [number], "__pairs": [pairs], "__counts": [counts]}, 1)
        self.clear()

    def batch(self, columns: dict, n: int) -> pa.RecordBatch:
        arrays = []
        for f in self.schema:
            value = columns[f.name]
            if isinstance(value, pa.ChunkedArray):
                value = pa.concat_arrays(value.chunks) if value.num_chunks else pa.nulls(0, f.type)
            arrays.append(value.cast(f.type) if isinstance(value, pa.Array) else pa.array(value, f.type))
        return pa.RecordBatch.from_arrays(arrays, names=self.schema.names)


def sum_up(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums over the links of each row of a pack."""
    n = np.zeros(answers.num_rows, np.int64)
    best = np.zeros(answers.num_rows, np.int64)
    place = answers["place"].to_numpy()
    n[place] = answers["n"].to_numpy()
    best[place] = answers["best"].to_numpy().astype(np.int64)
    wide = "<u2" if len(n) <= 1 << 16 else "<u4"
    found = []
    for at, times in zip(rows["__at"].to_pylist(), rows["__times"].to_pylist()):
        at, times = np.frombuffer(at, wide), np.frombuffer(times, "<u4").astype(np.int64)
        found.append((int(best[at] @ times), int(n[at] @ times)))
    kept = rows.drop_columns(["__pack", "__at", "__times"])
    where = kept.schema.get_field_index("n_links") + 1
    for name, values in zip(("count_sum", "n_best"), ([f[1] for f in found], [f[0] for f in found])):
        kept = kept.add_column(where, name, pa.array(values, pa.int64()))
    return kept
