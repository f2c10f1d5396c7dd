"""Encoding and decoding against the library."""

import hashlib
import struct
from collections import Counter

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from canvass.llm import queries
from canvass.llm.pieces import SHORT, TOGETHER, Encoder, piece_columns, taken, unpacked

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
ENCODER = Encoder(LIBRARY)
SCHEMA = "doc_id long, text string, n_tokens string, extra int"


@settings(max_examples=300, deadline=None)
@given(st.one_of(
    st.text(alphabet="ab e▁ th\n0.<>x漢é&%", max_size=80),
    st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40),
))
def test_text(text):
    assert unpacked(ENCODER.encode([text])[0]) == LIBRARY.encode(text)


def test_long_chunks():
    for text in ("a" * 500, "thereof" * 200, " " * 90 + "x", "漢字" * 100, "e" * (SHORT - 1), "e" * SHORT, "e" * (SHORT + 1)):
        assert ENCODER.vocabulary._short("▁" + text) == ENCODER.vocabulary._long("▁" + text)
        assert unpacked(ENCODER.encode([text])[0]) == LIBRARY.encode(text)


def test_parts_together():
    """Parts of one length are merged as rows of a matrix; letters that are no piece become bytes."""
    words = sorted({w for d in ("thereof another ▁the 12,345.67 été 漢字かな 𝒳𝒴𝒵a ", "ab" * 30) for a in range(len(d)) for n in (1, 2, 5, 9, 48, 60) if (w := d[a : a + n])})
    parts = words + [f"{w}{c}" for w in words for c in "aé漢𝒳0"]
    vocabulary = ENCODER.vocabulary
    assert max(Counter(map(len, set(parts))).values()) >= TOGETHER
    assert vocabulary.encode_parts([*set(parts)]) == {p: vocabulary.encode_part(p) for p in parts}


def test_words_are_kept_once():
    """A word of letters alone is not also kept as a part, and both tables count what they hold."""
    encoder = Encoder(LIBRARY)
    encoder.encode(["plain words and x86 of 12 letters"] * 3)
    assert set(encoder.known.young) == {"plain", "words", "and", "x86", "of", "12", "letters"}
    assert not any("plain" in part for part in encoder.parts.young)
    for table in (encoder.known, encoder.parts):
        assert table.taken == sum(taken(k, v) for k, v in table.young.items())


def test_rows(spark):
    long = "many words, one after the other. " * 6000
    rows = [(1, None, "x", 1), (2, "", None, 2), (3, long, "x", None), (3, long, "x", None), (None, " a  b ", "x", 4)]
    out = piece_columns(spark.createDataFrame(rows, SCHEMA), queries.PIECES).collect()
    assert out[0].__fields__ == ["doc_id", "text", "extra", "token_ids", "n_tokens", "decoded"]
    assert len(out) == len(rows)
    for row in out:
        want = LIBRARY.encode(row.text or "", add_bos=True, add_eos=True)
        assert unpacked(row.token_ids) == want and row.n_tokens == len(want)
        assert row.decoded == LIBRARY.decode(want) == (row.text or "")


def test_empty_table(spark):
    assert piece_columns(spark.createDataFrame([], SCHEMA), queries.PIECES).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op10_sentencepiece(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = LIBRARY.encode(d.text or "", add_bos=True, add_eos=True)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
