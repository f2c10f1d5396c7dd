"""Stages one by one, and the whole run against its parts in plain Python."""

from collections import Counter

import sentencepiece
from test_jaccard import brute

import corpus_pipeline
from canvass.llm.language import words_of
from canvass.llm.pieces import unpacked
from canvass.llm.secret_scan import Scanner, redacted

SF = "/root/testdata/sf0.001"
SCANNER = Scanner()


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "secrets", "mixture", "tokens"]


def test_columns_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != "tokens":
            assert out.columns == docs.columns


def test_run(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    worded = {i: d for i, d in docs.items() if words_of(d.text or "")}
    assert len(worded) >= 0.98 * len(docs)
    component = {i: c for i, _, c in brute([(d.doc_id, d.text) for d in worded.values()], 5, 80, 100)}
    copies = Counter(r.doc_id for r in out)
    assert set(copies) == {i for i, c in component.items() if i == c}
    assert set(copies.values()) <= {1, 2} and 1 in copies.values()
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECES)
    for r in out:
        before = docs[r.doc_id]
        text = redacted(before.text, SCANNER.spans(before.text))
        assert r.text == text and (r.lang, r.source) == (before.lang, before.source)
        assert unpacked(r.token_ids) == library.encode(text, add_bos=True, add_eos=True) and r.n_tokens == len(unpacked(r.token_ids))
