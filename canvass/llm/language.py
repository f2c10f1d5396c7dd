"""Language identification with segmentation-marginalised unigrams.

Each language has one probability for every piece of a fixed public vocabulary.
The probability of a word is the sum over all ways to cut it into pieces of the
product of their probabilities, by the forward algorithm; that of a text is
the product over its words.  Probabilities are learned by expectation
maximisation over the same segmentations (forward and backward sums), so no
segmentation is ever chosen.

Words are lower-cased runs of letters, cut every 64 letters; each is scored
once per task.  A letter outside the vocabulary counts as one unknown piece.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from canvass.llm.arrow import SliceFunction, add_columns, held, stored

MARK = "▁"
WORD = re.compile(r"[^\W\d_]{1,64}")
# Labelled texts of each language used for learning, in expectation; more change little.
SAMPLE = 1000
ROUNDS = 3
# Added to the expected count of each piece.
SMOOTHING = 0.05
# Languages times pieces that a model may have; it is sent to every task.
CELLS = 50_000_000
# Words whose scores are kept in one task.
CACHED_WORDS = 400_000
UNDETERMINED = "und"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Vocabulary:
    """Lower-case pieces of letters, with and without the mark of a word's start; the last id is the unknown letter."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = {processor.id_to_piece(i) for i in range(processor.get_piece_size())}
        fit = sorted(p for p in pieces if (q := p.removeprefix(MARK)) == q.lower() and (q.isalpha() or p == MARK))
        self.ids = {p: i for i, p in enumerate(fit)}
        self.unknown = len(fit)
        self.size = len(fit) + 1
        self.longest = max(map(len, fit))

    def lattice(self, words: list[str]) -> list[list[tuple[int, np.ndarray]]]:
        """For words of one length: the pieces that end at each place, as (length, id in each word or -1)."""
        get, unknown, out = self.ids.get, self.unknown, []
        for end in range(1, len(words[0]) + 1):
            here = []
            for size in range(1, min(self.longest, end) + 1):
                a = end - size
                ids = np.array([get(w[a:end], -1) for w in words], np.int64)
                if size == 1:
                    ids[ids < 0] = unknown
                if size == 1 or ids.max() >= 0:
                    here.append((size, ids))
            out.append(here)
        return out


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places and words, marked, in groups of one length and bounded size."""
    groups = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    for places in groups.values():
        for at in range(0, len(places), 20_000):
            part = places[at : at + 20_000]
            yield np.array(part), [MARK + words[i] for i in part]


def forward(lattice: list, chances: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language; `chances` ends with a row of zeros for id -1."""
    n = len(lattice[0][0][1])
    sums = [np.ones((n, chances.shape[1]))]
    scale = np.zeros_like(sums[0])
    for end, pieces in enumerate(lattice, 1):
        sums.append(sum(sums[end - size] * chances[ids] for size, ids in pieces))
        if end % 16 == 0:
            unit = sums[end]
            scale += np.log(unit)
            for k in range(max(0, end - 16), end + 1):
                sums[k] = sums[k] / unit
    return scale + np.log(sums[-1])


def expected(lattice: list, chances: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> None:
    """Add each piece's expected number in words that occur `counts` times; for one language.

    Sums ahead are logarithms; the way back holds the share of segmentations that pass a place, so nothing underflows.
    """
    n, length = len(counts), len(lattice)
    with np.errstate(divide="ignore"):
        logs = np.log(chances)
    ahead, passed = [np.zeros(n)], [np.zeros(n) for _ in range(length)] + [np.ones(n)]
    for end, pieces in enumerate(lattice, 1):
        ahead.append(np.logaddexp.reduce([ahead[end - size] + logs[ids] for size, ids in pieces]))
    for end in range(length, 0, -1):
        for size, ids in lattice[end - 1]:
            share = passed[end] * np.exp(ahead[end - size] + logs[ids] - ahead[end])
            passed[end - size] += share
            totals += np.bincount(np.where(ids < 0, len(totals) - 1, ids), counts * share, len(totals))


class Model:
    """Languages, their shares among labelled texts, and piece probabilities."""

    def __init__(self, languages: list[str], shares: np.ndarray, chances: np.ndarray, vocabulary: bytes) -> None:
        self.languages, self.shares, self.chances, self.vocabulary = languages, shares, chances, vocabulary


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.vocabulary = Vocabulary(model.vocabulary)
        self.chances = np.vstack([model.chances, np.zeros((1, len(model.languages)))])
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.scores = np.zeros((CACHED_WORDS, len(self.model.languages)))

    def score_words(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.model.languages)))
        for places, group in by_length(words):
            out[places] = forward(self.vocabulary.lattice(group), self.chances)
        return out

    def learn(self, words: list[str]) -> None:
        """Numerals that look like letters are left out of a word; what remains without letters scores nothing."""
        letters = [w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in words]
        scores = np.zeros((len(words), len(self.model.languages)))
        real = [i for i, w in enumerate(letters) if w]
        scores[real] = self.score_words([letters[i] for i in real])
        at = len(self.places)
        if at + len(words) > len(self.scores):
            self.scores = np.vstack([self.scores, np.zeros((len(words), scores.shape[1]))])
        self.scores[at : at + len(words)] = scores
        self.places.update((w, at + i) for i, w in enumerate(words))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language and its posterior probability; the alphabetically first among equals."""
        split = [words_of(t or "") for t in texts]
        if not self.model.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        new = {w for words in split for w in words if w not in self.places}
        if new:
            if len(self.places) + len(new) > CACHED_WORDS:
                self.clear()
                new = {w for words in split for w in words}
            self.learn(list(new))
        return [self.best(words) for words in split]

    def best(self, words: list[str]) -> tuple[str, float]:
        if not any(map(str.isalpha, "".join(words))):
            return UNDETERMINED, 0.0
        places = self.places
        total = self.scores[[places[w] for w in words]].sum(axis=0) + np.log(self.model.shares)
        best = int(np.argmax(total))
        return self.model.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def word_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """Columns lang, word, n: counted within each batch, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            for i in range(batch.num_rows):
                counts[batch.column(0)[i].as_py()].update(filter(str.isalpha, words_of(batch.column(1)[i].as_py())))
            rows = [(k, w, n) for k, c in counts.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])

    found = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(run, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn_model(df: DataFrame, vocabulary: bytes, id_col: str, text: str, lang: str, sample: int = SAMPLE) -> Model:
    """Model from the labelled rows of `df` (text and label not null).

    All labelled rows count for the shares of languages; `sample` of each language's rows,
    chosen by a hash of the id, in expectation, give the probabilities of pieces.
    """
    spark = df.sparkSession
    labelled = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = labelled.groupBy(F.col(lang).alias("lang")).count().orderBy("lang").collect()
    languages = [r.lang for r in rows]
    pieces = Vocabulary(vocabulary).size
    if len(languages) * pieces > CELLS:
        raise ValueError(f"{len(languages)} languages times {pieces} pieces are more than {CELLS}")
    chances = np.full((pieces, len(languages)), 1.0 / pieces)
    if not languages:
        return Model([], np.zeros(0), chances, vocabulary)
    part = F.create_map(*[F.lit(x) for r in rows for x in (r.lang, min(1.0, sample / r["count"]))])
    draw = F.pmod(F.xxhash64(F.lit("language sample"), F.col(id_col)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    counts = stored(word_counts(labelled.where(draw < F.element_at(part, F.col(lang))), text, lang))
    number = {k: i for i, k in enumerate(languages)}
    for _ in range(ROUNDS):
        totals = np.full_like(chances, SMOOTHING)
        for r in expected_counts(counts, vocabulary, number, chances).collect():
            totals[r.piece, r.lang] += r.n
        chances = totals / totals.sum(axis=0)
    shares = np.array([r["count"] for r in rows], float)
    return Model(languages, shares / shares.sum(), chances, vocabulary)


def expected_counts(counts: DataFrame, vocabulary: bytes, number: dict[str, int], chances: np.ndarray) -> DataFrame:
    """Columns lang, piece, n: at most one row for each language and piece."""
    shared = counts.sparkSession.sparkContext.broadcast((vocabulary, number, chances))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, numbers, now = shared.value
        pieces = Vocabulary(model)
        now = np.vstack([now, np.zeros((1, now.shape[1]))])
        totals = np.zeros((now.shape[1], len(now)))
        for batch in batches:
            lang, word, n = (c.to_pylist() for c in batch.columns)
            of = np.array([numbers[k] for k in lang])
            for k in set(of.tolist()):
                mine = np.flatnonzero(of == k)
                for places, group in by_length([word[i] for i in mine]):
                    times = np.array([n[mine[i]] for i in places], float)
                    expected(pieces.lattice(group), now[:, k], times, totals[k])
        totals[:, -1] = 0
        langs, ids = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.int32()), pa.array(ids, pa.int32()), pa.array(totals[langs, ids])], names=["lang", "piece", "n"])

    partial = counts.mapInArrow(run, "lang int, piece int, n double")
    return partial.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def predict_languages(df: DataFrame, model: Model, text: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """`df` with the language of the whole text and its probability among the learned languages.

    A null text, one without a letter, and any text if no language was learned are
    `und` with probability 0.  Only the text counts: repeated rows get repeated results; very long
    texts are scored whole.  An empty table gives no rows; columns named like a result are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make() -> SliceFunction:
        # its words outlive a task; the scorer holds the model, so no other has its address meanwhile
        return held("language", id(shared.value), lambda: Scorer(shared.value)).predict

    return add_columns(df, [text], [StructField(into, StringType()), StructField(score, DoubleType())], make)


def held_out(id_col: str = "doc_id"):
    """Third of the rows that is never learned from; a null id counts like an empty one."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def reject_undetermined(docs: DataFrame, vocabulary: bytes, least: float = 0.5) -> DataFrame:
    """`docs` without texts whose language stays open: no letter, or no language at `least` probable.

    The model is learned from the labelled rows that are not held out; a missing label is filled in.  Columns stay.
    """
    model = learn_model(docs.where(~held_out()), vocabulary, "doc_id", "text", "lang")
    told = predict_languages(docs, model, into="__lang", score="__score")
    kept = told.where((F.col("__lang") != UNDETERMINED) & (F.col("__score") >= least))
    return kept.withColumn("lang", F.coalesce("lang", "__lang")).select(*[f"`{c}`" for c in docs.columns])
