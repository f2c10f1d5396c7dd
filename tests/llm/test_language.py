"""Language identification: sums over all segmentations, learning, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest

from canvass.llm import queries
from canvass.llm.language import (
    MARK, UNDETERMINED, Model, Scorer, Vocabulary, expected, held_out, learn_model, predict_languages, reject_undetermined,
    word_counts, words_of,
)

BYTES = queries.piece_model()
VOCABULARY = Vocabulary(BYTES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def cuts(word):
    """All segmentations as lists of ids."""
    if not word:
        return [[]]
    out = []
    for size in range(1, len(word) + 1):
        i = VOCABULARY.ids.get(word[:size], VOCABULARY.unknown if size == 1 else None)
        if i is not None:
            out += [[i, *rest] for rest in cuts(word[size:])]
    return out


def chances(languages=2):
    c = np.random.default_rng(0).random((VOCABULARY.size, languages))
    return c / c.sum(axis=0)


def test_forward_sums_all_segmentations():
    c = chances()
    scorer = Scorer(Model(["a", "b"], np.array([0.5, 0.5]), c, BYTES))
    words = ["the", "schön", "ñandú", "q", "ꙮꙮ", "thering", "der"]
    got = scorer.score_words(words)
    for w, row in zip(words, got):
        want = [np.log(sum(np.prod(c[s, k]) for s in cuts(MARK + w))) for k in range(2)]
        assert np.allclose(row, want)


def test_long_words_do_not_underflow():
    scorer = Scorer(Model(["a", "b"], np.array([0.5, 0.5]), chances(), BYTES))
    assert np.isfinite(scorer.score_words(["ꙮ" * 64, "a" * 64])).all()


def test_expected_counts():
    c = np.vstack([chances(1), np.zeros((1, 1))])[:, 0]
    totals = np.zeros(VOCABULARY.size + 1)
    expected(VOCABULARY.lattice([MARK + "then", MARK + "thin"]), c, np.array([2.0, 3.0]), totals)
    want = np.zeros_like(totals)
    for word, n in (("then", 2), ("thin", 3)):
        ways = cuts(MARK + word)
        weights = np.array([np.prod(c[s]) for s in ways])
        for s, weight in zip(ways, weights / weights.sum()):
            np.add.at(want, s, n * weight)
    totals[-1] = 0
    assert np.allclose(totals, want)


def rare_letters():
    return "".join(sorted(p for p in VOCABULARY.ids if len(p) == 1 and "\u4e00" <= p <= "\u9fff")[:64])


def test_expected_counts_of_rare_letters():
    letters = rare_letters()
    c = np.append(np.full(VOCABULARY.size, 2e-6), 0.0)
    totals = np.zeros(VOCABULARY.size + 1)
    expected(VOCABULARY.lattice([MARK + letters]), c, np.array([3.0]), totals)
    assert np.isfinite(totals).all()
    ids = [VOCABULARY.ids[x] for x in letters]
    assert len(ids) == 64 and (totals[ids] <= 3.0 + 1e-9).all() and totals[ids].sum() > 64


def test_rare_letters_in_a_row_do_not_spoil_a_language(spark):
    df = spark.createDataFrame(
        [(1, "there that is the thing " * 60_000 + rare_letters(), "en"), (2, "der die das und nicht eine zeit " * 50, "de")],
        "doc_id long, text string, lang string")
    model = learn_model(df, BYTES, "doc_id", "text", "lang")
    assert np.isfinite(model.chances).all() and (model.chances > 0).all() and np.allclose(model.chances.sum(axis=0), 1)
    assert [lang for lang, _ in Scorer(model).predict(["that is the thing", "das und die"])] == ["en", "de"]


def test_words():
    assert words_of("Ab-c1D_é²\n" + "x" * 130) == ["ab", "c", "d", "é²", "x" * 64, "x" * 64, "xx"]


def rows():
    out = []
    for i in range(120):
        out.append((i, "the thing that is there and here with them", "en", "s", None, "x"))
        out.append((1000 + i, "der die das und nicht eine schöne zeit", "de", None, 3, "x"))
    return out


def test_rows(spark):
    odd = [
        (5001, None, "en", "s", 1, "x"), (5002, "", None, None, 0, None), (5003, "12 +-*/ ²½ _", "de", "s", 9, "x"),
        (None, "that thing", None, "s", 9, "x"), (5004, "das und die", None, "s", 9, "x"), (5004, "das und die", None, "s", 9, "x"),
        (5005, "there that is the thing " * 20000, None, "s", 9, "x"),
    ]
    df = spark.createDataFrame(rows() + odd, SCHEMA)
    model = learn_model(df.where(~held_out()), BYTES, "doc_id", "text", "lang")
    assert model.languages == ["de", "en"] and np.allclose(model.chances.sum(axis=0), 1)
    out = predict_languages(df, model).collect()
    assert out[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "score"]
    assert all(r.lang == r.lang_pred for r in out if r.doc_id is not None and r.doc_id < 5000)
    got = sorted((str(r.doc_id), r.lang_pred) for r in out if r.doc_id is None or r.doc_id > 5000)
    assert got == [("5001", "und"), ("5002", "und"), ("5003", "und"), ("5004", "de"), ("5004", "de"), ("5005", "en"), ("None", "en")]
    assert all(0 <= r.score <= 1 for r in out) and all(r.score == 0 for r in out if r.lang_pred == UNDETERMINED)
    kept = reject_undetermined(df, BYTES)
    assert kept.schema == df.schema
    left = kept.collect()
    assert len(left) == 240 + 4 and all(r.lang for r in left)


def test_label_and_source_do_not_matter(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    model = learn_model(df.where(~held_out()), BYTES, "doc_id", "text", "lang")
    other = df.selectExpr("-doc_id as doc_id", "text", "'de' as lang", "'t' as source")
    a = {r.text: (r.lang_pred, r.score) for r in predict_languages(df, model).collect()}
    b = {r.text: (r.lang_pred, r.score) for r in predict_languages(other, model).collect()}
    assert a == b


@pytest.mark.parametrize("labelled", [False, True])
def test_empty(spark, labelled):
    df = spark.createDataFrame([(1, "some words", None, "s", 1, "x")] if labelled else [], SCHEMA)
    model = learn_model(df, BYTES, "doc_id", "text", "lang")
    assert model.languages == []
    assert [(r.lang_pred, r.score) for r in predict_languages(df, model).collect()] == [("und", 0.0)] * labelled


def test_word_counts(spark):
    df = spark.createDataFrame([(1, "a B a", "x"), (2, "b", "x"), (3, "a", "y")], "doc_id long, text string, lang string")
    got = {(r.lang, r.word): r.n for r in word_counts(df, "text", "lang").collect()}
    assert got == {("x", "a"): 2, ("x", "b"): 2, ("y", "a"): 1}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op6_language(spark, sf).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unseen = [r for r in got if r.held_out and docs[r.doc_id].lang and docs[r.doc_id].text]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in unseen) >= 0.97 * len(unseen) > 0
