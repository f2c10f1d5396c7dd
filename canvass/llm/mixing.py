"""Temperature mixing of sources, realised as budgeted block permutations.

A source with share p of all tokens gets a weight proportional to p ** exponent.
The exponent is bisected to meet a target entropy of the weights, or to keep the
repetition of the most repeated source within a limit.  A source is then read
epoch after epoch until its part of the budget is spent: its documents are dealt into blocks by a
hash, each epoch orders the blocks anew, and the last epoch ends with
the last document that still fits.  Everything is a function of ids and texts, so a lost task gives the same rows again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.llm.arrow import small, stored

WORDS = r"[^\x20\x09-\x0D]+"
# Words of a source in one block, in expectation.
BLOCK_TOKENS = 100_000
# Exponents tried at once (five halvings), and how often: the exponent is known to 2 ** -30 of the range.
SECTIONS, SEARCHES = 32, 6
# Entropies that differ by less are equal.
TOLERANCE = 1e-12
# Ranges of the block order over which running totals are summed first.
CHUNKS = 1024


@dataclass(frozen=True)
class Target:
    """What the weights have to meet.

    entropy: of the weights, as a share of the entropy of equal weights.  repeats: how often a source may
    be read at most; it wins over the entropy.  budget: tokens of the mixture; without
    one the source that is repeated least is read exactly once.
    """

    entropy: float | None = None
    repeats: float | None = None
    budget: float | None = None


def token_rows(docs: DataFrame, id_col: str, text: str, source: str) -> DataFrame:
    """Columns id, digest, source, tokens: the light rows on which all is decided."""
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("tokens"),
    )


def measures(sizes: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float]]:
    """For each exponent: entropy of the weights in nats, and the highest repetition."""
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(a)).alias("a")) for i, a in enumerate(exponents)]))
    each = sizes.select("x", "total", at.alias("e")).select("x", "total", "e.i", "e.a", F.exp(F.col("e.a") * F.col("x")).alias("w"))
    per = F.exp((F.col("a") - 1) * F.col("x"))  # weight for each token, up to a factor
    rows = each.groupBy("i", "a", "total").agg(
        F.sum("w").alias("z"), F.sum(F.col("w") * F.col("x")).alias("wx"), F.max(per).alias("most"), F.min(per).alias("least")
    ).select(
        "i", (F.log("z") - F.col("a") * F.col("wx") / F.col("z")).alias("entropy"),
        (F.col("most") / F.col("least") if budget is None else F.lit(float(budget)) * F.col("most") / (F.col("z") * F.col("total"))).alias("repeats"),
    ).orderBy("i").collect()
    return [(r.entropy, r.repeats) for r in rows]


def bisected(sizes: DataFrame, low: float, high: float, below, budget: float | None) -> float:
    """Smallest exponent (nearly) from which `below` holds; every job halves the range five times."""
    for _ in range(SEARCHES):
        tried = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
        holds = [below(*m) for m in measures(sizes, tried, budget)]
        first = holds.index(True) if True in holds else SECTIONS
        low, high = tried[max(0, first - 1)], tried[first]
    return high


def bracket(sizes: DataFrame, wanted: float, budget: float | None) -> tuple[float, float]:
    """Exponents between which the entropy falls to the wanted one.

    The steeper the weights, the fewer sources count; the largest ones stay equal, so
    their number bounds the entropy from below, and asking for less is an error.
    """
    largest = sizes.where("x = 0").count()
    if wanted < math.log(largest) - TOLERANCE:
        raise ValueError(f"{largest} sources are the largest alike: no exponent gives an entropy of {wanted}")
    low = 0.0
    while True:
        tried = [max(low, 1.0) * 2.0**k for k in range(SECTIONS)]
        for exponent, (entropy, _) in zip(tried, measures(sizes, tried, budget)):
            if entropy <= wanted + TOLERANCE:
                return low, exponent
            low = exponent


def find_exponent(sizes: DataFrame, target: Target) -> float:
    """Exponent for sizes (columns x: log of the share of the largest, total: the largest): 1 if nothing is asked for."""
    sources = sizes.count()
    if not sources:
        return 1.0
    exponent = 1.0
    if target.entropy is not None:
        wanted = target.entropy * math.log(sources)
        exponent = bisected(sizes, *bracket(sizes, wanted, target.budget), lambda h, r: h <= wanted + TOLERANCE, target.budget)
    if target.repeats is not None:
        least = bisected(sizes, 0.0, 1.0, lambda h, r: r <= target.repeats + 1e-9, target.budget)
        exponent = max(exponent, least) if target.entropy is not None else least
    return exponent


def weigh(rows: DataFrame, target: Target) -> DataFrame:
    """Columns source, tokens, weight, epochs (with a fraction): one row for each source with tokens."""
    sums = stored(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"))
    total = sums.agg(F.max("tokens")).first()[0] or 0
    # sizes as shares of the largest, so that no steep weight vanishes from all of them
    sizes = sums.select("source", "tokens", F.log(F.col("tokens") / F.lit(float(total or 1))).alias("x"), F.lit(float(total)).alias("total"))
    exponent = find_exponent(sizes, target)
    w = sizes.withColumn("w", F.exp(F.lit(exponent) * F.col("x")))
    z, least = w.agg(F.sum("w"), F.min(F.col("w") / F.col("tokens"))).first()
    weight = F.col("w") / F.lit(z or 1.0)
    epochs = F.col("w") / F.col("tokens") / F.lit(least or 1.0) if target.budget is None else weight * F.lit(float(target.budget)) / F.col("tokens")
    return w.select("source", "tokens", weight.alias("weight"), epochs.alias("epochs"))


def draw(seed: int, *of: Column | str) -> Column:
    """Number from 0 to 2 ** 62 drawn by a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 2)


def block_of(id_col: Column, digest: Column, tokens: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), id_col, digest), F.ceil(tokens / F.lit(BLOCK_TOKENS))).cast("long")


def mixture(
    docs: DataFrame, target: Target, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0
) -> DataFrame:
    """`docs` repeated as the weights ask, with columns epoch (from 0), progress and weight.

    Rows sorted by progress (0 to 1) read all sources side by side.  Tokens are words.  A null source is a source.  Sources
    without tokens, and so tables without text, are read once.  Within an epoch a row occurs once, so
    a row that is repeated in `docs` is repeated in each.  The last epoch of a source
    stops before the budget is exceeded.  An empty table gives no rows; columns named like a result are replaced.
    """
    rows = stored(token_rows(docs, id_col, text, source))
    weights = weigh(rows, target)
    # rounding must not lose the epoch that a source has in full
    whole = F.floor(F.col("epochs") + F.lit(1e-6)).cast("int")
    plan = weights.select(
        F.col("source").alias("s"), F.col("tokens").alias("size"), "weight", F.greatest("epochs", whole).alias("epochs"), whole.alias("whole"),
    ).withColumn("rest", F.floor((F.col("epochs") - F.col("whole")) * F.col("size")).cast("long"))
    few = small(stored(plan), 64)
    dealt = rows.join(few, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", block_of(F.col("id"), F.col("digest"), F.col("size")))
    blocks = dealt.groupBy("s", "block", "whole", "rest").agg(F.sum("tokens").alias("tokens"))
    blocks = stored(blocks.withColumn("o", draw(seed, "s", "whole", "block")).withColumn("chunk", F.expr(f"cast(o div {2**62 // CHUNKS} as int)")))
    # tokens before each block: before its chunk, and in its chunk
    by_chunk = Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = blocks.groupBy("s", "chunk").agg(F.sum("tokens").alias("t")).select(
        F.col("s").alias("cs"), F.col("chunk").alias("cc"), F.coalesce(F.sum("t").over(by_chunk), F.lit(0)).alias("ahead")
    )
    inside = Window.partitionBy("s", "chunk").orderBy("o", "block").rowsBetween(Window.unboundedPreceding, -1)
    begun = blocks.join(chunks, F.col("s").eqNullSafe(F.col("cs")) & (F.col("chunk") == F.col("cc"))).withColumn(
        "begin", F.col("ahead") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    )
    end = F.col("begin") + F.col("tokens")
    last = F.when((end <= F.col("rest")) & (F.col("rest") > 0), 1).when(F.col("begin") < F.col("rest"), 2).otherwise(0)
    ends = stored(begun.select(F.col("s").alias("bs"), F.col("block").alias("bb"), "begin", last.alias("last")))

    # documents of the one block of a source in which its budget ends; repeated rows go together
    cut = dealt.join(small(ends.where("last = 2"), 64), F.col("s").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb")))
    cut = cut.groupBy("s", "block", "whole", "begin", "rest", "id", "digest").agg(F.sum("tokens").alias("tokens"))
    in_block = Window.partitionBy("s", "block").orderBy(draw(seed, "id", "digest", "whole"), "id", "digest")
    stop = F.col("begin") + F.sum("tokens").over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    extra = stored(cut.withColumn("stop", stop).where("stop <= rest").select(
        F.col("s").alias("xs"), F.col("id").alias("xi"), F.col("digest").alias("xd"), F.lit(True).alias("fits")
    ))
    named = {c.lower() for c in ("epoch", "progress", "weight")}
    kept = [c for c in docs.columns if c.lower() not in named]
    own = docs.select(F.struct(*[f"`{c}`" for c in kept]).alias("row"), F.col(id_col).alias("id"), F.col(source).alias("source"), F.xxhash64(text).alias("digest"))
    found = (
        own.join(few, F.col("source").eqNullSafe(F.col("s")), "left")
        .withColumn("block", block_of(F.col("id"), F.col("digest"), F.col("size")))
        .join(small(ends, 64), F.col("s").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb")), "left")
        .join(small(extra, 64), (F.col("last") == 2) & F.col("s").eqNullSafe(F.col("xs")) & F.col("id").eqNullSafe(F.col("xi")) & (F.col("digest") == F.col("xd")), "left")
    )
    some = F.when(F.col("last") == 1, 1).when((F.col("last") == 2) & F.col("fits").isNotNull(), 1).otherwise(0)
    times = F.coalesce(F.col("whole") + some, F.lit(1))
    read = found.withColumn("epoch", F.explode(F.sequence(F.lit(0), times))).where(F.col("epoch") < times)
    share = draw(seed, "s", "epoch", "block") / F.lit(float(2**62))
    progress = F.coalesce((F.col("epoch") + share) / F.greatest(F.col("epochs"), F.col("epoch") + F.lit(1.0)), F.lit(0.0))
    return read.select("row.*", "epoch", progress.alias("progress"), F.coalesce("weight", F.lit(0.0)).alias("weight"))


def mix_sources(docs: DataFrame, repeats: float = 2.0) -> DataFrame:
    """`docs` as a mixture in which the largest source is read once and none more than `repeats` times.  Columns stay."""
    whole = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("document"), "doc_id", "text", "source")
    return mixture(whole, Target(repeats=repeats)).select("document.*")
