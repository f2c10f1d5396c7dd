"""Byte-level BPE against the library, against plain merging, and on odd rows."""

import hashlib
import json
import struct

import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from canvass.llm import queries
from canvass.llm.arrow import Recent
from canvass.llm.pieces import unpacked
from canvass.llm.trie_bpe import bpe_columns, make_encoder, read_vocabulary, stretches, taken

LIBRARY = tokenizers.Tokenizer.from_file(queries.BYTE_BPE)
PLAIN = tokenizers.Tokenizer.from_file(queries.BYTE_BPE)
PLAIN.encode_special_tokens = True
ENCODERS = {special: make_encoder(*read_vocabulary(queries.BYTE_BPE), special) for special in (True, False)}
SCHEMA = "doc_id long, text string, n_tokens string, extra int"

TEXTS = st.one_of(
    st.text(alphabet="ab e th\n\t0.<>x漢é&%' s\x1c\x85\xa0", max_size=80),
    st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40),
)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_text(text):
    assert unpacked(ENCODERS[True].encode([text])[0]) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.just("<|endoftext|>"), st.just(" ")), max_size=6))
def test_special_tokens(parts):
    text = "".join(parts)
    assert unpacked(ENCODERS[True].encode([text])[0]) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert unpacked(ENCODERS[False].encode([text])[0]) == PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=30), min_size=1, max_size=8))
def test_trie_agrees_with_plain_merging(words):
    table = ENCODERS[True].table
    got = table.encode_words(list(dict.fromkeys(words)))
    assert {w: unpacked(ids) for w, ids in got.items()} == {w: table.plain(w) for w in words}


def test_common_prefixes_are_encoded_once(monkeypatch):
    table = ENCODERS[True].table
    words = [b"prefix" * 30 + bytes([c]) for c in range(97, 107)]
    tested = []
    monkeypatch.setattr(table, "neighbours", type("Asked", (dict,), {"get": lambda self, k: tested.append(k) or dict.get(self, k)})())
    table.encode_words(words[:1])
    alone = len(tested)
    table.encode_words(words)
    assert len(tested) - alone < alone + 10 * 20


def test_every_character_is_in_its_class():
    # two of a kind, and two with a letter, a number and a sign in between
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or 0xA000 <= c < 0x20000)]
    words = ENCODERS[True].words
    split = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    for at in range(0, len(codes), 20000):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)}! " for c in codes[at : at + 20000])
        assert [m.span() for m in words.finditer(text)] == [span for _, span in split.pre_tokenize_str(text)]


def test_long_words():
    for text in ("a" * 3000, " " * 500, "thereof" * 300, "漢字" * 200, "\n" * 300 + "x", "0" * 999, "x " * 3000):
        assert unpacked(ENCODERS[True].encode([text])[0]) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_stretches_are_cut_at_single_blanks():
    assert stretches("a b") == ("a", ["b"])
    assert stretches("a  b c \nd") == ("a  b", ["c \nd"])
    assert stretches(" a b ") == (" a", ["b "]) or stretches(" a b ") == ("", ["a", "b", ""])


def test_forgetting():
    table = Recent(2000, taken)
    for k in range(200):
        keys = {"kept", f"w{k}"}
        for key in table.absent(lambda known, keys=keys: {x for x in keys if x not in known}):
            table.put(key, b"")
        assert table.young.keys() >= keys
        assert len(table.young) + len(table.old) < 14


def test_rows(spark):
    long = "many words, one after the other. " * 6000
    rows = [(1, None, "x", 1), (2, "", None, 2), (3, long, "x", None), (3, long, "x", None), (None, " a <|endoftext|> b ", "x", 4)]
    out = bpe_columns(spark.createDataFrame(rows, SCHEMA), queries.BYTE_BPE).collect()
    assert out[0].__fields__ == ["doc_id", "text", "extra", "token_ids", "n_tokens", "decoded"]
    assert len(out) == len(rows)
    for row in out:
        want = LIBRARY.encode(row.text or "", add_special_tokens=False).ids
        assert unpacked(row.token_ids) == want and row.n_tokens == len(want)
        assert row.decoded == LIBRARY.decode(want, skip_special_tokens=False) == (row.text or "")


def test_empty_table(spark):
    assert bpe_columns(spark.createDataFrame([], SCHEMA), queries.BYTE_BPE).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op13_trie_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = LIBRARY.encode(d.text or "", add_special_tokens=False).ids
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_other_vocabularies_are_refused():
    with open(queries.BYTE_BPE, "rb") as f:
        spec = json.load(f)
    spec["model"]["unk_token"] = "?"
    try:
        make_encoder(json.dumps(spec).encode(), "x", True)
    except ValueError:
        return
    raise AssertionError
