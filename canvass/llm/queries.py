"""Registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.alignment import align_tokens
from canvass.llm.chat import format_trees, learned_texts, threads, turns_of
from canvass.llm.fingerprint import fingerprint_columns, paired_with_next
from canvass.llm.jaccard import similar_rows
from canvass.llm.language import held_out, learn_model, predict_languages
from canvass.llm.mixing import WORDS, Target, mixture
from canvass.llm.negatives import hard_negatives
from canvass.llm.pieces import piece_columns
from canvass.llm.search import search
from canvass.llm.secret_scan import BASE, secret_spans
from canvass.llm.sharding import shard_rows
from canvass.llm.trie_bpe import bpe_columns
from canvass.llm.urls import Rule, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def piece_model() -> bytes:
    with open(PIECES, "rb") as f:
        return f.read()


def query(sql: str | None = None) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


URL_RULES = [
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
]


@query()
def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on every page's url, by the rules or by what they teach."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


JACCARD_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
  ), lambda w: w <> '') AS ws FROM documents
), sets AS (
  SELECT doc_id, list_sort(CASE
    WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
  END) AS s FROM split
), classes AS (
  SELECT min(doc_id) AS c, len(s) AS n, s FROM sets WHERE len(s) > 0 GROUP BY s
), shingles AS (
  SELECT c, n, unnest(s) AS t FROM classes
), links AS (
  SELECT a.c AS x, b.c AS y FROM shingles a JOIN shingles b ON a.t = b.t AND a.c <> b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT c AS x, c AS y FROM classes
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), component AS (
  SELECT x AS c, min(y) AS component_id FROM reach GROUP BY x
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(k.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON s.s = c.s LEFT JOIN component k ON k.c = c.c
"""


@query(JACCARD_SQL)
def op2_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Component of every document under links of at least 0.85 on 4-word shingles."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = similar_rows(docs, size=4, part=85, whole=100)
    return rows.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id")


SHARD_BYTES = 1 << 20

SHARD_SQL = f"""
WITH rows AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents
), buckets AS (
  SELECT d, h >> (60 - d) AS p, sum(bytes) AS bytes, count(*) AS n, min(h) = max(h) AS one
  FROM rows, range(0, 61) r(d) GROUP BY 1, 2
), ends AS (
  SELECT h, min(d) AS depth FROM (SELECT DISTINCT h FROM rows) JOIN buckets ON p = h >> (60 - d)
  WHERE bytes <= {SHARD_BYTES} OR one OR d = 60 GROUP BY h
)
SELECT r.doc_id, CASE WHEN e.depth = 0 THEN '' ELSE right(CAST(CAST(b.p AS BIT) AS VARCHAR), CAST(e.depth AS INTEGER)) END AS shard,
  CAST(e.depth AS INTEGER) AS depth, CAST(b.bytes AS BIGINT) AS shard_bytes, b.n AS shard_rows, b.bytes <= {SHARD_BYTES} AS fits
FROM rows r JOIN ends e USING (h) JOIN buckets b ON b.d = e.depth AND b.p = r.h >> (60 - e.depth)
"""


@query(SHARD_SQL)
def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Shard of every document, of 1 MiB of text at most."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return shard_rows(docs, SHARD_BYTES).drop("text")


CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
    (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')) AS own(conv_id, turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<x\1|', 'g')) + 11) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


@query(CHAT_SQL)
def op4_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations as formatted text, described by what is read back from it."""
    control = "'<|im_end|><|im_start|>assistant ok'"
    own = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', {control}), (-1L, 1L, 'assistant', {control}) AS own(conv_id, turn, role, text)")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    read = format_trees(threads(rows, "conv_id", "turn", "role", "text")).select(
        F.col("tree").alias("conv_id"), F.length("formatted").cast("long").alias("formatted_chars"),
        turns_of("formatted").alias("turns"), F.array_join(learned_texts("formatted", "loss"), "").alias("learned"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.encode("learned", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars",
    )


@query()
def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """As many words as there are, drawn from flatter weights: 97 % of the highest entropy, no source more than four times."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    budget = docs.agg(F.sum(F.regexp_count("text", F.lit(WORDS)))).first()[0] or 0
    mixed = mixture(docs, Target(entropy=0.97, repeats=4.0, budget=float(budget)))
    return mixed.select("doc_id", "source", "epoch", F.round("progress", 9).alias("progress"), F.round("weight", 9).alias("weight"))


@query()
def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = learn_model(docs.where(~held_out()), piece_model(), "doc_id", "text", "lang")
    told = predict_languages(docs.drop("lang"), model)
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query()
def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, digest and list of the secrets of every document."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = secret_spans(docs)

    def of(*kinds: str):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(listed(of(*BASE)), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'
  )) AS t FROM documents
), tf AS (SELECT doc_id, t, count(*) AS n FROM words GROUP BY ALL
), len AS (SELECT doc_id, sum(n) AS dl FROM tf GROUP BY doc_id
), whole AS (SELECT (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM words) / (SELECT count(*) FROM documents) AS mean
), idf AS (SELECT t, ln(1 + (any_value(total) - count(*) + 0.5) / (count(*) + 0.5)) AS w FROM tf, whole GROUP BY t
), scored AS (
  SELECT q.doc_id AS query_id, d.doc_id, round(sum(d.n * 2.2 / (d.n + 1.2 * (0.25 + 0.75 * dl / mean)) * w), 9) AS score
  FROM tf q JOIN tf d USING (t) JOIN idf USING (t) JOIN len ON len.doc_id = d.doc_id, whole
  WHERE q.doc_id % 50 = 0 GROUP BY 1, 2
)
SELECT query_id, doc_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, round(score, 6) AS score
FROM scored QUALIFY rank <= 10
"""


@query(SEARCH_SQL)
def op8_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best documents for the text of every fiftieth."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = search(docs, docs.where("doc_id % 50 = 0"), 10)
    return found.withColumn("score", F.round("score", 6))


@query()
def op9_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    paired = paired_with_next(docs, "doc_id", "text", "next", ranges).withColumn("n_chars", F.length("text").cast("long"))
    half = "int(n_chars div 2)"
    edited = paired.withColumn("edited", F.expr(f"concat(left(text, int(n_chars) - {half}), left(next, {half}))"))
    prints = fingerprint_columns(
        edited, {"text": "fingerprint", "edited": "edited_fingerprint", "next": "next_fingerprint"},
        likeness={"near_edited": ("fingerprint", "edited_fingerprint"), "near_next": ("fingerprint", "next_fingerprint")},
    )
    return prints.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@query()
def op10_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document, and what they decode to."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return piece_columns(docs, PIECES).select(
        "doc_id", "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i])), 0) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query(NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of every fiftieth vector."""
    vectors = table(spark, sf, "embeddings")
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where("label IS NOT NULL AND embedding IS NOT NULL").where(finite).select(
        F.col("vec_id").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform(doubles, lambda x: F.floor(x * 256)).alias("vector"),
    )
    return hard_negatives(rows, F.col("id") % 50 == 0)


@query()
def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """How byte-level and SentencePiece tokens of every document align."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return align_tokens(docs, BYTE_BPE, PIECES)


@query()
def op13_trie_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Byte-level BPE ids of every document, and what they decode to."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe_columns(docs, BYTE_BPE).select(
        "doc_id", "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
