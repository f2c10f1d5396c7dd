"""Byte-level BPE encoding and decoding over a trie of the distinct words.

In an encoding every prefix that ends with a token is encoded by the tokens up to
there, and tokens side by side stay apart exactly if no merge crosses the border
between the two.  So a prefix has one last token: the one that ends it and stays
apart from the last token of what is before it.  The words of a slice of texts
are put into a trie in byte order, which is depth first; each new node gets the
last token of its prefix and the node before that token, once for all words that
begin alike.  A word's ids are read back along these nodes.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array

from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from canvass.llm.arrow import Recent, SliceFunction, add_columns, held
from canvass.llm.pieces import packed, unpacked

# Bytes that the known stretches of one worker may take.
TABLE_BYTES = 96 << 20
# What an entry of that table takes besides its characters and ids.
ENTRY_BYTES = 230
# Pairs of tokens for which it is remembered whether they stay apart, before a slice.
NEIGHBOURS = 400_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is visible in Latin-1, else the next of those from 256."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


@functools.lru_cache(maxsize=1)
def character_classes() -> tuple[str, str]:
    """Letters and numbers as bodies of character classes.

    Characters that Python's tables do not know yet are asked of the tokenizers
    library, whose tables may be newer.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    kinds = {"L": [], "N": []}
    unknown = []
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] in kinds:
            kinds[kind[0]].append(code)
        elif kind == "Cn" and code < 0x40000:
            unknown.append(code)
    # "a" and a letter, or "1" and a number, are one word
    told = ByteLevel(add_prefix_space=False).pre_tokenize_str("".join(f"a{chr(c)}!1{chr(c)}!" for c in unknown))
    starts = {span[0] for _, span in told}
    for at, code in enumerate(unknown):
        if 6 * at + 1 not in starts:
            kinds["L"].append(code)
        elif 6 * at + 4 not in starts:
            kinds["N"].append(code)
    return class_body(sorted(kinds["L"])), class_body(sorted(kinds["N"]))


def class_body(codes: list[int]) -> str:
    """Sorted code points as ranges of a character class."""
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def word_pattern() -> str:
    """Contractions, words, numbers, other signs, and white space, each with one blank in front at most (fixed rule of the vocabulary)."""
    letters, numbers = character_classes()
    # white space of Unicode; Python's own \s also takes four control characters
    blank = r"\t-\r \x85\xa0  -     　"
    return (
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{blank}{letters}{numbers}]+"
        f"|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


class MergeTable:
    """Tokens of a vocabulary file with the merge that makes each."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        before, after = spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
        plain = (
            model.get("type") == "BPE" and before.get("type") == after.get("type") == "ByteLevel"
            and not before.get("add_prefix_space") and before.get("use_regex", True) and not spec.get("normalizer")
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                               "byte_fallback", "ignore_merges"))
        )
        if not plain:
            raise ValueError("only byte-level BPE vocabularies without normalisation are supported")
        value = {letter: b for b, letter in enumerate(byte_letters())}
        vocabulary: dict[str, int] = model["vocab"]
        added = spec.get("added_tokens") or []
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in added):
            raise ValueError("only added tokens that are matched as they are")
        self.special = {t["content"]: t["id"] for t in added}
        size = 1 + max([*vocabulary.values(), *self.special.values()])
        self.bytes = [b""] * size
        for token, i in vocabulary.items():
            if token not in self.special:
                self.bytes[i] = bytes(value[c] for c in token)
        # the decoder reads an added token like any other, and as it stands if it has other letters
        for token, i in self.special.items():
            known = all(c in value for c in token)
            self.bytes[i] = bytes(value[c] for c in token) if known else token.encode("utf-8")
        self.of_byte = [vocabulary[letter] for letter in byte_letters()]
        # rank of the merge that makes a token (-1: a byte), and its two parts
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[int, int] = {}
        self.width = size
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            parts, made = (vocabulary[a], vocabulary[b]), vocabulary[a + b]
            if self.rank[made] >= 0 or any(self.rank[p] < 0 and len(self.bytes[p]) > 1 for p in parts):
                raise ValueError("only vocabularies in which one merge of earlier tokens makes each token")
            self.rank[made], (self.left[made], self.right[made]) = rank, parts
            self.merge[parts[0] * size + parts[1]] = rank
            self.made.append(made)
        # every end of a token, with the token if it is a whole one
        self.tails: dict[bytes, int] = {}
        for i in sorted(vocabulary.values()):
            token = self.bytes[i]
            if i in self.special.values() or not token:
                continue
            for at in range(1, len(token)):
                self.tails.setdefault(token[at:], -1)
            self.tails[token] = i
        self.whole: dict[int, bool] = {}
        self.neighbours: dict[int, bool] = {}

    def apart(self, one: int, other: int) -> bool:
        """Whether no merge crosses the border between two tokens side by side.

        Goes back in time from the finished tokens: the part that was made last
        comes apart first (of equal merges the right one, as the left is made
        first).  Two parts that touch the border merge if their merge comes
        before each of them is used up.
        """
        merge, rank, width = self.merge.get, self.rank, self.width
        until = until_other = 1 << 60
        while True:
            crossing = merge(one * width + other)
            if crossing is not None and crossing < until and crossing <= until_other:
                return False
            if rank[one] > rank[other]:
                until, one = rank[one], self.right[one]
            elif rank[other] >= 0:
                until_other, other = rank[other], self.left[other]
            else:
                return True

    def stands(self, token: int) -> bool:
        """Whether the bytes of a token are encoded as this token."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self.plain(self.bytes[token]) == [token]
        return known

    def plain(self, word: bytes) -> list[int]:
        """Merges in order of rank, the leftmost first: what the trie has to agree with."""
        parts = [self.of_byte[b] for b in word]
        while len(parts) > 1:
            ranks = [self.merge.get(a * self.width + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [self.made[best]]
        return parts

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of distinct words, by one walk over their trie.

        A node is the prefix of a word: `last` is the last token of its encoding,
        `back` the node in front of that token.  In byte order a word shares
        with the trie just what it shares with the word before it, so new nodes
        are always added below the rightmost path, which is `path`.
        """
        tails, width = self.tails, self.width
        if len(self.neighbours) > NEIGHBOURS:
            self.neighbours.clear()
        known = self.neighbours
        last, back, path, nodes = [-1], [-1], [0], 1
        out: dict[bytes, array] = {}
        before = b""
        for word in sorted(words):
            shared, limit = 0, min(len(word), len(before))
            while shared < limit and word[shared] == before[shared]:
                shared += 1
            del path[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                start = end - 1
                while True:  # every end of the prefix that is a token, the shortest first
                    token = tails[word[start:end]]
                    if token >= 0:
                        node = path[start]
                        if start:
                            pair = last[node] * width + token
                            fits = known.get(pair)
                            if fits is None:
                                fits = known[pair] = self.apart(last[node], token)
                        else:
                            fits = self.stands(token)
                        if fits:
                            break
                    start -= 1
                path.append(nodes)
                last.append(token)
                back.append(node)
                nodes += 1
            ids, node = array("I"), path[-1]
            while node:
                ids.append(last[node])
                node = back[node]
            ids.reverse()
            out[word] = packed(ids)
            before = word
        return out


class Encoder:
    """Encodes texts stretch by stretch; a stretch lies between single blanks that stand between other characters.

    No word of the pattern reaches over such a blank but the one that begins with it, so
    stretches are independent of each other, and one is encoded once as long as it is remembered.
    """

    def __init__(self, table: MergeTable, pattern: str, special: bool) -> None:
        self.table = table
        self.words = re.compile(pattern)
        listed = sorted(table.special, key=len, reverse=True) if special else []
        self.special = re.compile("(" + "|".join(map(re.escape, listed)) + ")") if listed else None
        # ids of stretches that begin with a blank, by what is behind it, and of first ones
        self.blank_first, self.bare = Recent(TABLE_BYTES, taken), Recent(TABLE_BYTES // 8, taken)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        runs = [self.runs(t) for t in texts]
        plain = [r for rs in runs for r in rs if not isinstance(r, bytes)]
        blank_first = self.blank_first.absent(lambda known: {s for _, rest in plain for s in rest if s not in known})
        bare = self.bare.absent(lambda known: {head for head, _ in plain if head not in known})
        ids = self.encode_stretches([" " + s for s in blank_first] + bare)
        for table, new, found in ((self.blank_first, blank_first, ids), (self.bare, bare, ids[len(blank_first) :])):
            for s, data in zip(new, found):
                table.put(s, data)
        behind, first = self.blank_first.young, self.bare.young
        return [
            b"".join([d for r in rs for d in ([r] if isinstance(r, bytes) else [first[r[0]], *[behind[s] for s in r[1]]])])
            for rs in runs
        ]

    def runs(self, text: str) -> list:
        """Ids of special tokens, and what is between them as (first stretch, others without their blank)."""
        if self.special is None or not self.special.search(text):
            return [stretches(text)] if text else []
        found = []
        for at, part in enumerate(self.special.split(text)):
            if at % 2:
                found.append(packed(array("I", [self.table.special[part]])))
            elif part:
                found.append(stretches(part))
        return found

    def encode_stretches(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts that are independent of each other, by one trie of all their words."""
        find = self.words.findall
        split = [find(t) for t in texts]
        distinct = {w.encode("utf-8"): w for words in split for w in words}
        ids = {distinct[word]: data for word, data in self.table.encode_words(list(distinct)).items()}
        return [ids[words[0]] if len(words) == 1 else b"".join([ids[w] for w in words]) for words in split]


def taken(stretch: str, data: bytes) -> int:
    return ENTRY_BYTES + 2 * len(stretch) + len(data)


# A blank beside other white space.
DOUBTFUL = re.compile(r" \s|\s ")


def stretches(text: str) -> tuple[str, list[str]]:
    """First stretch of a text, and the others without their blank."""
    parts = text.split(" ")
    if not DOUBTFUL.search(text):
        return parts[0], parts[1:]
    kept, joined, last = [], [parts[0]], parts[0]
    for part in parts[1:]:
        if last and part and not last[-1].isspace() and not part[0].isspace():
            kept.append(" ".join(joined))
            joined = [part]
        else:
            joined.append(part)
        last = part
    kept.append(" ".join(joined))
    return kept[0], kept[1:]


def read_vocabulary(path: str) -> tuple[bytes, str]:
    """A vocabulary file and the word pattern, for the tasks."""
    with open(path, "rb") as f:
        return f.read(), word_pattern()


def make_encoder(data: bytes, pattern: str, special: bool) -> Encoder:
    return Encoder(MergeTable(json.loads(data)), pattern, special)


def bpe_columns(df: DataFrame, vocabulary: str, text: str = "text", special: bool = True) -> DataFrame:
    """`df` with `token_ids` (packed little-endian unsigned 32-bit ids), `n_tokens` and `decoded`.

    `vocabulary` is the path of a byte-level BPE file of the tokenizers library,
    read once on the driver: its size is that of the vocabulary, not of the data.
    With `special` the strings of added tokens inside texts become these tokens, as
    the library does it by default, without it they are plain text.  A null or
    empty text has no ids and decodes to ''.  A row's result depends on its text
    alone, so repeated rows give repeated results, and very long texts are encoded
    whole.  An empty table gives no rows.  Columns of `df` named like a result
    are replaced, all others are kept.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def make() -> SliceFunction:
        data, pattern = shared.value
        key = (hashlib.sha256(data).digest(), special)
        encoder = held("trie_bpe", key, lambda: make_encoder(data, pattern, special))
        token = encoder.table.bytes

        def encode(values: list[str | None]) -> list[tuple]:
            found = encoder.encode([v or "" for v in values])
            return [
                (ids, len(ids) // 4, b"".join([token[i] for i in unpacked(ids)]).decode("utf-8", "replace")) for ids in found
            ]

        return encode

    fields = [StructField("token_ids", BinaryType()), StructField("n_tokens", LongType()), StructField("decoded", StringType())]
    return add_columns(df, [text], fields, make)
