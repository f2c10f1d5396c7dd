"""URL filter: rules by host and path, then naive Bayes on segmented names.

Names (runs of letters in host and path) are cut into words by a unigram Viterbi
search.  The words and their counts come from the pages' own text.  A name's candidates are found by
joining its substrings with the counts, so the vocabulary is never sent to a task as a
whole.  URLs that a rule judges teach a multinomial naive Bayes model, which
judges the others by the words of their names.  Pages with the same names are counted and scored once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField

from canvass.llm.arrow import SLICE, add_columns, by_row, small, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """allow or block for a host with all its subdomains, where the path begins with `path`."""

    verdict: str
    host: str
    path: str


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host after the first ://, A-Z lower-cased, and the path after it; both empty without ://."""
    url = F.col(url) if isinstance(url, str) else url
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule], give: Callable[[Rule], str]) -> Column:
    """What `give` says of the longest rule that fits; null if none does."""

    def fits(rule: Rule) -> Column:
        return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))

    ordered = sorted(rules, key=lambda r: -len(r.host + r.path))
    return F.coalesce(*[F.when(fits(r), F.lit(give(r))) for r in ordered], F.lit(None).cast("string"))


def names(kind: str, text: Column) -> Column:
    """Names in a text, marked by kind; a number counts by its length."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\p{N}+)"), F.lit(1))
    return F.transform(
        found, lambda t: F.concat(F.lit(kind), F.when(F.rlike(t, F.lit(r"^\p{N}")), F.concat(F.lit("#"), F.length(t))).otherwise(t))
    )


# Letters by which words of the vocabulary are looked up.
HEAD = 24
WORD = re.compile(r"[^\W\d_]+")
TAGS = re.compile(r"<(?:script|style)\b.*?</(?:script|style)\s*>|<[^>]*>", re.S | re.I)


def page_words(pages: DataFrame, html: str) -> DataFrame:
    """Columns word, n: lower-case words outside of tags, counted within each slice, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            counts: Counter = Counter()
            for value in part.column(0).to_pylist():
                counts.update(w for w in WORD.findall(TAGS.sub(" ", value or "").lower()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )

    return pages.select(html).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(name: str, candidates: dict[tuple[int, int], int], total: int) -> list[str]:
    """Likeliest words that make up the name; `candidates` maps place and length of words of the vocabulary to counts.

    A piece outside the vocabulary, of any length, costs tenfold more with every letter.  Of equal
    ways, the one with the longer last word is taken.
    """
    rare, letter = math.log(10 / max(total, 1)), math.log(10)
    ending: dict[int, list[int]] = {}
    for begin, size in candidates:
        ending.setdefault(begin + size, []).append(size)
    best: list[tuple[float, int]] = [(0.0, 0)]
    unknown = 0  # where the best piece outside the vocabulary that ends here begins
    for end in range(1, len(name) + 1):
        # a letter more costs every piece the same, so only a new one can be better than the last
        ways = [(best[begin][0] + rare - (end - begin) * letter, begin) for begin in {unknown, end - 1}]
        score, unknown = max(ways, key=lambda w: (w[0], -w[1]))
        ways = [(score, unknown)]
        ways += [(best[end - n][0] + math.log(candidates[end - n, n] / total), end - n) for n in ending.get(end, ())]
        best.append(max(ways, key=lambda w: (w[0], -w[1])))
    words, end = [], len(name)
    while end:
        begin = best[end][1]
        words.append(name[begin:end])
        end = begin
    return words[::-1]


def segmented(distinct: DataFrame, counts: DataFrame) -> DataFrame:
    """Columns name, words: for distinct names of letters and a table of word counts."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    starts = distinct.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("i"))
    left = F.length("name") - F.col("i") + 1
    pieces = starts.withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.lit(HEAD), left)))).withColumn(
        "word", F.substring("name", F.col("i"), F.col("size"))
    )
    length = F.length("word")
    hits = pieces.join(counts.where(length <= HEAD), "word").select("name", "i", "size", "n")
    # longer words are found by their first letters and compared where these occur
    longer = counts.where(length > HEAD).select(F.substring("word", 1, HEAD).alias("head"), F.col("word").alias("whole"), "n")
    heads = pieces.where(F.col("size") == HEAD).select("name", "i", F.col("word").alias("head")).join(longer, "head")
    long_hits = heads.where(F.substring("name", F.col("i"), F.length("whole")) == F.col("whole"))
    hits = hits.unionByName(long_hits.select("name", "i", F.length("whole").alias("size"), "n"))
    found = hits.groupBy("name").agg(F.collect_list(F.struct("i", "size", "n")).alias("found"))

    def make() -> Callable[..., tuple]:
        def row(name: str, found: list | None) -> tuple:
            return (viterbi(name, {(f["i"] - 1, f["size"]): f["n"] for f in found or []}, total),)

        return row

    both = distinct.join(found, "name", "left")
    return add_columns(both, ["name", "found"], [StructField("words", ArrayType(StringType()))], by_row(make)).drop("found")


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html") -> DataFrame:
    """`pages` with columns host, path, rule (null if none fits), verdict and score.

    The score is the logarithm of the odds for allow under the learned model, the verdict that of the rule or else of the
    score (allow from 0 on).  A null url, and one without ://, has empty host and path; it is judged
    by the shares of the learned verdicts alone.  Null and empty pages teach no words.  Repeated rows
    count and are judged alike.  An empty table gives no rows; columns named like a result are replaced.
    """
    clashing = {"host", "path", "rule", "verdict", "score"}
    kept = [c for c in pages.columns if c.lower() not in clashing]
    host, path = host_and_path(pages[url])
    parts = pages.select(*[pages[f"`{c}`"] for c in kept], host.alias("host"), path.alias("path"))
    parts = parts.withColumns({
        "rule": matching_rule(F.col("host"), F.col("path"), rules, lambda r: r.host + r.path),
        "__told": matching_rule(F.col("host"), F.col("path"), rules, lambda r: r.verdict),
        "__names": F.concat(names("h:", F.col("host")), names("p:", F.col("path"))),
    })
    # urls with the same names
    alike = parts.groupBy("__names").agg(F.count_if(F.col("__told") == "allow").alias("allow"), F.count_if(F.col("__told") == "block").alias("block"))
    alike = stored(alike.withColumnRenamed("__names", "names"))
    tokens = alike.select("names", "allow", "block", F.explode("names").alias("t")).select(
        "names", "allow", "block", F.substring("t", 1, 2).alias("kind"), F.substring("t", 3, 2**30).alias("name")
    )
    letters = tokens.where(~F.startswith("name", F.lit("#"))).select("name").distinct()
    words = stored(segmented(letters, stored(page_words(pages, html))).withColumnRenamed("name", "cut"))
    spelled = tokens.join(small(words, 128), F.col("name") == F.col("cut"), "left").select(
        "names", "allow", "block", F.explode(F.coalesce("words", F.array("name"))).alias("word"), "kind"
    ).withColumn("token", F.concat("kind", "word"))
    counts = stored(spelled.groupBy("token").agg(F.sum("allow").alias("a"), F.sum("block").alias("b")).where("a + b > 0"))
    kinds, a, b = counts.agg(F.count("*"), F.sum("a"), F.sum("b")).first()
    allowed, blocked = alike.agg(F.sum("allow"), F.sum("block")).first()
    odds = F.log((F.col("a") + 1) / F.lit((a or 0) + kinds)) - F.log((F.col("b") + 1) / F.lit((b or 0) + kinds))
    prior = math.log(((allowed or 0) + 1) / ((blocked or 0) + 1))
    learned = counts.select(F.col("token").alias("known"), odds.alias("odds"))
    sums = spelled.join(small(learned, 64), F.col("token") == F.col("known")).groupBy("names").agg(F.sum("odds").alias("odds"))
    scores = stored(alike.select(F.col("names").alias("n")).join(sums, F.col("n") == F.col("names"), "left").select(
        "n", F.round(F.lit(prior) + F.coalesce("odds", F.lit(0.0)), 9).alias("score")
    ))
    judged = parts.join(small(scores, 256), F.col("__names") == F.col("n"), "left")
    own = F.when(F.col("score") >= 0, "allow").otherwise("block")
    return judged.select(*[F.col(f"`{c}`") for c in kept], "host", "path", "rule", F.coalesce("__told", own).alias("verdict"), "score")
