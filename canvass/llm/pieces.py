"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

A text is encoded as the library does it: blanks become the piece mark, one
mark is put in front, and neighbouring symbols are merged in the order of the
score of their union, the leftmost first among equals.  No piece of a
vocabulary that is accepted here has a mark after another character, so merges
never cross the start of a run of marks, and each distinct chunk is encoded once
per task, many of one length together.  Every distinct chunk is also given to the library; a difference is
an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import sys
from array import array
from collections import defaultdict
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from canvass.llm.arrow import Recent, SliceFunction, add_columns, held

MARK = "▁"
# Bytes that the known chunks, and the known parts of chunks, of one worker may take, and what one takes besides its characters.
CHUNK_BYTES, PART_BYTES, ENTRY_BYTES = 64 << 20, 16 << 20, 200
# Up to so many symbols the agenda is a plain list; searching it is then cheaper than a heap.
SHORT = 48
# From so many parts of one length on, they are merged together as rows of a matrix.
TOGETHER = 24

CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class MergeVocabulary:
    """Pieces with scores and ids, read through the library's public accessors."""

    def __init__(self, processor) -> None:
        self.ids: dict[str, int] = {}
        self.cost: dict[str, float] = {}
        self.byte_ids = [-1] * 256
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (processor.is_control(i) or processor.is_unknown(i)):
                if processor.is_unused(i):
                    raise ValueError("vocabularies with unused pieces are not supported")
                self.ids[piece] = i
                self.cost[piece] = -processor.get_score(i)
        self.side_by_side = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a mark after another character")
        if -1 in self.byte_ids:
            raise ValueError("the vocabulary has no byte fallback")
        self.number_pairs(processor.get_piece_size())
        probe = "A é́ ﬁ　Å\t."
        if processor.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("only vocabularies that leave characters as they are")

    def number_pairs(self, size: int) -> None:
        """Symbols as numbers, the id of a piece or `size` and the code point, and the pairs of them that make a piece."""
        self.size, self.width = size, size + 0x110000
        letters = sorted((ord(p), i) for p, i in self.ids.items() if len(p) == 1)
        self.letters, self.letter_ids = np.array(letters, np.int64).reshape(-1, 2).T.copy()

        def number(symbol: str) -> int | None:
            return self.ids.get(symbol, size + ord(symbol) if len(symbol) == 1 else None)

        pairs = sorted(
            (a * self.width + b, i) for p, i in self.ids.items() for at in range(1, len(p))
            if (a := number(p[:at])) is not None and (b := number(p[at:])) is not None
        )
        keys, made = np.array(pairs, np.int64).reshape(-1, 2).T
        cost = np.full(size, np.inf)
        cost[list(self.ids.values())] = [self.cost[p] for p in self.ids]
        # the last pair is none
        self.pairs, self.made, self.pair_cost = np.r_[keys, -1], np.r_[made, -1], np.r_[cost[made], np.inf]
        self.find = pd.Index(keys).get_indexer

    def symbols(self, chunk: str) -> list[str]:
        return self._short(chunk) if len(chunk) <= SHORT else self._long(chunk)

    def _short(self, chunk: str) -> list[str]:
        """The agenda is the list of the costs of all adjacent pairs."""
        cost, none = self.cost.get, float("inf")
        parts = list(chunk)
        agenda = [cost(a + b, none) for a, b in zip(parts, parts[1:])]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            parts[i] += parts.pop(i + 1)
            agenda.pop(i)
            if i < len(agenda):
                agenda[i] = cost(parts[i] + parts[i + 1], none)
            if i:
                agenda[i - 1] = cost(parts[i - 1] + parts[i], none)
        return parts

    def _long(self, chunk: str) -> list[str]:
        """The agenda is a heap of pairs; entries of symbols that changed meanwhile are passed over."""
        cost = self.cost.get
        parts: list[str] = list(chunk)
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        agenda = [(c, i, parts[i] + parts[i + 1]) for i in range(len(parts) - 1)
                  if (c := cost(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, union = heapq.heappop(agenda)
            j = right[i]
            if not parts[i] or j < 0 or len(parts[i]) + len(parts[j]) != len(union) or parts[i] + parts[j] != union:
                continue
            parts[i], parts[j] = union, ""
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (c := cost(parts[a] + parts[b])) is not None:
                    heapq.heappush(agenda, (c, a, parts[a] + parts[b]))
        return [p for p in parts if p]

    def cut(self, chunk: str) -> list[str]:
        """The chunk between all neighbours that no piece has side by side; no merge can join those."""
        side_by_side = self.side_by_side
        borders = [i for i, pair in enumerate(map(add, chunk, chunk[1:]), 1) if pair not in side_by_side]
        return [chunk[a:b] for a, b in zip([0, *borders], [*borders, len(chunk)])] if borders else [chunk]

    def encode_parts(self, parts: list[str]) -> dict[str, bytes]:
        """Packed ids of distinct parts; many of one length are merged together."""
        of_length = defaultdict(list)
        for part in parts:
            of_length[len(part)].append(part)
        out: dict[str, bytes] = {}
        for length, own in of_length.items():
            if len(own) < TOGETHER or length > SHORT:
                out.update((part, self.encode_part(part)) for part in own)
            else:
                self.encode_together(own, length, out)
        return out

    def encode_together(self, parts: list[str], length: int, out: dict[str, bytes]) -> None:
        """Adds the packed ids of parts of one length: in each round every row merges its cheapest pair, the leftmost among equals."""
        points = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        symbols = np.where(self.letters[at] == points, self.letter_ids[at], self.size + points).reshape(-1, length)
        rows = np.arange(len(parts))
        pairs = self.find((symbols[:, :-1] * self.width + symbols[:, 1:]).ravel()).reshape(len(parts), length - 1)
        costs = self.pair_cost[pairs]
        while len(rows):
            n, width = symbols.shape
            here = np.arange(n)
            best = costs.argmin(axis=1) if width > 1 else np.zeros(n, np.int64)
            going = costs[here, best] < np.inf if width > 1 else np.zeros(n, bool)
            if not going.all():
                self.finish(parts, rows[~going], symbols[~going], out)
                rows, symbols, pairs, costs, best = rows[going], symbols[going], pairs[going], costs[going], best[going]
                n, here = len(rows), np.arange(len(rows))
                if not n:
                    return
            symbols[here, best] = self.made[pairs[here, best]]
            keep = np.ones((n, width), bool)
            keep[here, best + 1] = False
            symbols = symbols[keep].reshape(n, width - 1)
            keep[here, best + 1] = True
            keep[here, best] = False
            pairs, costs = pairs[keep[:, :-1]].reshape(n, width - 2), costs[keep[:, :-1]].reshape(n, width - 2)
            for row, left in ((here[best > 0], best[best > 0] - 1), (here[best < width - 2], best[best < width - 2])):
                pairs[row, left] = found = self.find(symbols[row, left] * self.width + symbols[row, left + 1])
                costs[row, left] = self.pair_cost[found]

    def finish(self, parts: list[str], rows: np.ndarray, symbols: np.ndarray, out: dict[str, bytes]) -> None:
        plain = (symbols < self.size).all(axis=1)
        data, step = symbols[plain].astype("<u4").tobytes(), 4 * symbols.shape[1]
        out.update((parts[row], data[i * step : i * step + step]) for i, row in enumerate(rows[plain].tolist()))
        for row, own in zip(rows[~plain].tolist(), symbols[~plain].tolist()):
            ids = array("I")
            for symbol in own:
                if symbol < self.size:
                    ids.append(symbol)
                else:
                    ids.extend(self.byte_ids[b] for b in chr(symbol - self.size).encode("utf-8"))
            out[parts[row]] = packed(ids)

    def encode_part(self, part: str) -> bytes:
        out = array("I")
        for symbol in self.symbols(part):
            i = self.ids.get(symbol)
            if i is None:
                out.extend(self.byte_ids[b] for b in symbol.encode("utf-8"))
            else:
                out.append(i)
        return packed(out)


class Encoder:
    """Encodes texts chunk by chunk; each new chunk is compared with the library.

    A chunk is kept without its first mark, which is also how the library is
    asked for it: it puts that mark in front itself.
    """

    def __init__(self, processor) -> None:
        self.processor = processor
        self.vocabulary = MergeVocabulary(processor)
        self.known, self.parts = Recent(CHUNK_BYTES, taken, all_taken), Recent(PART_BYTES, taken, all_taken)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids without begin and end."""
        split = [self.words(t) for t in texts]
        new = self.known.absent(lambda known: set().union(*split).difference(known))
        self.learn(new)
        find = self.known.young.__getitem__
        return [b"".join(map(find, words)) for words in split]

    @staticmethod
    def words(text: str) -> list[str]:
        words = text.split(" ") if text else []
        if "" in words or MARK in text:
            words = [c[1:] for c in CHUNK.findall(MARK + text.replace(" ", MARK))]
        return words

    def learn(self, words: list[str]) -> None:
        vocabulary = self.vocabulary
        # most words are letters alone, which few cuts would divide; they are kept as words and not as parts, too
        letters = [w for w in words if w.isalpha()]
        others = [w for w in words if not w.isalpha()]
        cuts = [vocabulary.cut(MARK + w) for w in others]
        new = self.parts.absent(lambda known: set().union(*cuts).difference(known))
        found = vocabulary.encode_parts([*{MARK + w for w in letters}.union(new)])
        self.parts.put_all({p: found[p] for p in new})
        self.known.put_all({w: found[MARK + w] for w in letters})
        find = self.parts.young.__getitem__
        self.known.put_all({w: b"".join(map(find, own)) for w, own in zip(others, cuts)})
        plain = [w for w in words if w and w[0] != MARK]
        self.check(" ".join(plain), plain)
        for w in words:
            if w[:1] == MARK:
                self.check(w.replace(MARK, " "), [w])

    def check(self, text: str, words: list[str]) -> None:
        known = self.known.young
        if words and b"".join([known[w] for w in words]) != packed(array("I", self.processor.encode(text))):
            for w in words:
                told = self.processor.encode(w.replace(MARK, " "))
                if unpacked(known[w]) != told:
                    raise ValueError(f"encoding of {w!r} differs from the library: {unpacked(known[w])} and {told}")
            raise ValueError("the encoding of words together differs from the library")


def taken(chunk: str, ids: bytes) -> int:
    return ENTRY_BYTES + 2 * len(chunk) + len(ids)


def all_taken(new: dict[str, bytes]) -> int:
    return ENTRY_BYTES * len(new) + 2 * sum(map(len, new)) + sum(map(len, new.values()))


def encoder_of(model: bytes) -> Encoder:
    """The worker's encoder of a vocabulary, so that its tables outlive a task."""
    import sentencepiece

    return held(
        "pieces", hashlib.sha256(model).digest(), lambda: Encoder(sentencepiece.SentencePieceProcessor(model_proto=model))
    )


def piece_columns(
    df: DataFrame, model: str, text: str = "text", begin: bool = True, end: bool = True
) -> DataFrame:
    """`df` with `token_ids` (packed little-endian unsigned 32-bit ids), `n_tokens` and `decoded`.

    `model` is the path of a vocabulary file, read once on the driver: its size
    is that of the vocabulary, not of the data.  A null text is encoded like an
    empty one: begin and end only.  A row's result depends on its text
    alone, so repeated rows give repeated results, and very long texts are encoded
    whole, chunk by chunk.  An empty table gives no rows.  Columns of `df` named like a result are
    replaced, all others are kept.
    """
    with open(model, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def make() -> SliceFunction:
        encoder = encoder_of(shared.value)
        processor = encoder.processor
        head = packed(array("I", [processor.bos_id()] if begin else []))
        tail = packed(array("I", [processor.eos_id()] if end else []))

        def encode(values: list[str | None]) -> list[tuple]:
            found = [head + ids + tail for ids in encoder.encode([v or "" for v in values])]
            return [(ids, len(ids) // 4, processor.decode(unpacked(ids))) for ids in found]

        return encode

    fields = [StructField("token_ids", BinaryType()), StructField("n_tokens", LongType()), StructField("decoded", StringType())]
    return add_columns(df, [text], fields, make)


def packed(ids: array) -> bytes:
    if sys.byteorder != "little":
        ids = ids[:]
        ids.byteswap()
    return ids.tobytes()


def unpacked(data: bytes) -> list[int]:
    """The ids of a packed column value."""
    return np.frombuffer(data, dtype="<u4").tolist()
