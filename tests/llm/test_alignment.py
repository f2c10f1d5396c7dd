"""Alignment against a plain walk over both tokenisations of whole texts, and on odd rows."""

import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from canvass.llm import alignment, queries
from canvass.llm.alignment import Aligner, align_tokens, common_ends, runs_of
from canvass.llm.trie_bpe import byte_letters, read_vocabulary

BYTES = tokenizers.Tokenizer.from_file(queries.BYTE_BPE)
BYTES.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
VALUE = {letter: b for b, letter in enumerate(byte_letters())}
ALIGNER = Aligner(*read_vocabulary(queries.BYTE_BPE), queries.piece_model())
SCHEMA = "doc_id long, text string, n_links string, extra int"


def plain(text):
    """Groups of (ids, ids) of a whole text, one byte offset after the other."""
    whole = (" " + (text or "")).encode()
    a, b = BYTES.encode(" " + (text or ""), add_special_tokens=False).ids, PIECES.encode(text or "")
    sizes = [bytes(VALUE[c] for c in BYTES.id_to_token(i)) for i in a]
    pieces = [bytes([int(PIECES.id_to_piece(i)[3:5], 16)]) if PIECES.is_byte(i) else PIECES.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not text or b"".join(sizes) != whole or b"".join(pieces) != whole:
        return 0, 0, []
    ends, other = ({e: k for k, e in enumerate(accumulate(map(len, parts)))} for parts in (sizes, pieces))
    groups, i, j = [], 0, 0
    for at in sorted(ends.keys() & other.keys()):
        groups.append((a[i : ends[at] + 1], b[j : other[at] + 1]))
        i, j = ends[at] + 1, other[at] + 1
    return len(a), len(b), groups


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def expected(texts):
    told = [plain(t) for t in texts]
    counts = Counter((a[-1], b[-1]) for _, _, groups in told for a, b in groups)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for n_a, n_b, groups in told:
        of = [counts[a[-1], b[-1]] for a, b in groups]
        best = sum(counts[a[-1], b[-1]] == most[b[-1]] for a, b in groups)
        digest = hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""
        out.append((n_a, n_b, len(groups), len(groups), best, sum(of), digest))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=200), st.sets(st.integers(0, 199)), st.sets(st.integers(0, 199)))
def test_runs(sizes, drop, drop_other):
    ends = np.cumsum(sizes)
    one, two = ([e for k, e in enumerate(ends.tolist()) if k not in d or k == len(sizes) - 1] for d in (drop, drop_other))
    at, other = common_ends(runs_of(np.array(one), np.array(two)))
    shared = sorted(set(one) & set(two))
    assert [one[i] for i in at] == shared == [two[j] for j in other]


def test_long_runs_take_few_comparisons():
    class Counted(bytes):
        compared = 0

        def __eq__(self, other):
            Counted.compared += 1
            return bytes.__eq__(self, other)

    ends = np.arange(1, 100_001)
    two = np.concatenate([ends[:50_000:1], ends[50_001:]])
    assert [r[2] for r in runs_of(ends, two)] == [50_000, 49_998]


@settings(max_examples=150, deadline=None)
@given(st.one_of(
    st.text(alphabet="ab e▁ th\n0.<>x漢é&%' \t", max_size=60), st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30)))
def test_text(text):
    found = ALIGNER.align([text])[0]
    n_a, n_b, groups = plain(text)
    if found is None:
        assert (n_a, n_b, groups) == (0, 0, [])
    else:
        assert (sum(f[0] for f in found), sum(f[1] for f in found)) == (n_a, n_b)
        assert ";".join(f[3] for f in found) == written(groups)


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(alignment, "PACK_ROWS", 3)
    long = "many words, some of them invented: velkorath, 12345. " * 3000
    texts = [None, "", long, long, " a  b \n c", "mark ▁ inside", "<|endoftext|> <s> plain", "x", "漢字かな 🤖", "a b", "a b a b"]
    rows = [(i // 2 if i else None, t, "x", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    out = align_tokens(df, queries.BYTE_BPE, queries.PIECES, with_groups=True)
    assert out.columns == ["doc_id", "extra", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    got = {r.extra: tuple(r)[2:9] for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == expected(texts)
    assert got[2] == got[3] and got[5] == (0, 0, 0, 0, 0, 0, "")


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert align_tokens(empty, queries.BYTE_BPE, queries.PIECES).count() == 0
    alone = spark.createDataFrame([(None,), ("",)], "text string")
    assert [tuple(r) for r in align_tokens(alone, queries.BYTE_BPE, queries.PIECES).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_token_alignment(spark, sf).collect()}
    docs = [r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = expected([d.text for d in docs])
    assert len(got) == len(docs)
    for d, w in zip(docs, want):
        assert got[d.doc_id] == w
