"""Rows paired with a table of patterns: candidates by literal pieces, then the pattern itself.

Every match of most patterns holds some text literally.  One piece of that text, the one with the
rarest run of three characters, is looked up whole in the rows by an equi-join, so a row is tested
against the few patterns whose piece it holds, however many patterns and rows there are.  What cannot be told safely is taken as not literal:
groups, classes, escapes and everything that a quantifier may leave out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import quoted

# Length of the runs that are indexed.
RUN = 3
# Longest stretch of literal text that is looked up.
KEY = 16
# Parts that patterns are read in.
PARTS = 16
# Texts and patterns of one key that a task pairs at a time.
TEXTS, PATTERNS = 512, 512
# Stands for whatever is not literal; no pattern that holds it is indexed.
GAP = "\u0001"
# Nested groups that are looked into; a pattern with deeper ones counts as not literal.
DEPTH = 5

ESCAPE = (
    r"\\(x\{[0-9A-Fa-f]+\}|x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|0[0-7]{1,3}|[pP](\{[^}]*\}|.)|N\{[^}]*\}|k<[^>]*>|c.|[1-9][0-9]*|.)"
)
CLASS = r"\[\^?\]?[^\[\]]*\]"
GROUP = r"\((\?:)?[^()]*\)"
MAYBE = r".([?*]|\{[^}]*\})[?+]?"
REPEAT = r"(.)\+[?+]?"
# flags, looks, quoted stretches
UNSAFE = r"\(\?[^:]|\\Q|" + GAP


def runs(text: Column) -> Column:
    """All runs of a text, once each; found in one pass over it."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * RUN}))"), F.lit(1)))


def literal_pieces(pattern: Column) -> Column:
    """For every alternative of a pattern the pieces that its matches must hold; NULL if that cannot be told."""
    steps = [(f"(?s){ESCAPE}", GAP)]
    steps += [(f"(?s){CLASS}", GAP)] * 2
    # what a group holds is left out; alternatives inside it are then no alternatives of the pattern
    steps += [(f"(?s){GROUP}", GAP)] * DEPTH
    plain = reduce(lambda p, s: F.regexp_replace(p, s[0], s[1]), steps, pattern)
    odd = pattern.rlike(UNSAFE) | plain.rlike(r"[\[\]()]")
    told = [(f"(?s){MAYBE}", GAP), (f"(?s){REPEAT}", "$1" + GAP), (r"[.^$]", GAP)]
    plain = reduce(lambda p, s: F.regexp_replace(p, s[0], s[1]), told, plain)
    return F.when(~odd, F.transform(F.split(plain, r"\|"), lambda a: F.split(a, GAP)))


def keys(text: Column) -> Column:
    """The text itself, or all its stretches of KEY characters if it is longer; none if it is shorter than a run."""
    long = F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * KEY}))"), F.lit(1))
    return F.when(F.length(text) > KEY, F.array_distinct(long)).otherwise(F.filter(F.array(text), lambda t: F.length(t) >= RUN))


def with_keys(patterns: DataFrame) -> DataFrame:
    """`patterns` with _alternatives: for every alternative the keys of its pieces; NULL if an alternative has none.

    Exploded arrays of one value are what filters are not moved through, which would split the patterns again.
    """
    cut = F.transform(literal_pieces(F.col("_pattern")), lambda a: F.array_distinct(F.flatten(F.transform(a, keys))))
    cut = patterns.select("*", F.explode(F.array(cut)).alias("_cut"))
    told = F.when(F.forall("_cut", lambda a: F.size(a) > 0), F.col("_cut"))
    return cut.select("*", F.explode(F.array(told)).alias("_alternatives")).drop("_cut")


def _asking(held: DataFrame, patterns: DataFrame) -> DataFrame:
    """(_pattern, _run, _before): one key for every alternative, the one whose rarest run the fewest texts hold.

    A pattern is tested at the first of its keys that the text holds, those `_before` being looked for as well.  Frequent ones are first.
    """
    wanted = patterns.select("_pattern", F.posexplode("_alternatives").alias("_at", "_alternative"))
    wanted = wanted.select("_pattern", "_at", F.explode("_alternative").alias("_run"))
    often = held.groupBy("_start").count()
    # a run that no text holds cannot be in a match: it counts 0 and is the rarest
    rarity = wanted.withColumn("_start", F.explode(runs(F.col("_run")))).join(often, "_start", "left")
    rarity = rarity.groupBy("_pattern", "_at", "_run").agg(F.min(F.coalesce("count", F.lit(0))).alias("_count"))
    order = F.struct("_count", -F.length("_run"), "_run")
    best = rarity.groupBy("_pattern", "_at").agg(F.min_by(F.struct(-F.col("_count"), "_run"), order).alias("_key"))
    keys_of = F.transform(F.array_sort(F.collect_set("_key")), lambda k: k["_run"]).alias("_keys")
    # dealt out anew, so that all that is made of this table shares one shuffle
    chosen = best.groupBy("_pattern").agg(keys_of).repartition(PARTS, "_keys")
    asking = chosen.select("*", F.posexplode("_keys").alias("_at", "_run"))
    return asking.select("_pattern", "_run", F.slice("_keys", F.lit(1), F.col("_at")).alias("_before"))


def _candidates(df: DataFrame, text: Column, patterns: DataFrame) -> DataFrame:
    """Rows (_row, _text) with each of `patterns` (_pattern, _labels) of which the text holds a key, once each.

    Texts and patterns of one key meet in parts, by a task each, so that no task has more than TEXTS x PATTERNS pairs of it, but for
    uneven hashes.  Patterns come one after the other for all texts of a part, so each is compiled once there.
    """
    rows = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("_row"), text.alias("_text")).filter("_text is not null")
    hashed = rows.withColumn("_hash", F.xxhash64("_text"))
    held = hashed.select("_hash", F.explode(runs(F.col("_text"))).alias("_start"))
    asking = _asking(held, with_keys(patterns.select("_pattern")))
    # the filter keeps the count and its column, without which this would not be the same table everywhere
    asked = asking.groupBy("_run").agg(F.count("_pattern").alias("count")).filter("count > 0")

    starts = asked.groupBy(F.left("_run", F.lit(RUN)).alias("_start")).agg(F.collect_set(F.length("_run")).alias("_sizes"))
    stretches = F.array_distinct(F.regexp_extract_all("_text", F.lit(f"(?s)(?=(.{{{RUN},{KEY}}}))"), F.lit(1)))
    stretch = hashed.select("_hash", F.explode(stretches).alias("_stretch"))
    stretch = stretch.withColumn("_start", F.left("_stretch", F.lit(RUN))).join(starts, "_start")
    stretch = stretch.select("_hash", "_stretch", F.explode("_sizes").alias("_size")).filter("length(_stretch) >= _size")
    hits = stretch.select("_hash", F.left("_stretch", F.col("_size")).alias("_run")).distinct()

    held_by = hits.groupBy("_run").agg(F.count("*").alias("_texts"))
    spread = asked.join(held_by, "_run").select(
        "_run", F.ceil(F.col("_texts") / TEXTS).cast("int").alias("_m"), F.ceil(F.col("count") / PATTERNS).cast("int").alias("_n")
    )

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def part(at: Column, of: Column) -> Column:
        return (at * F.col("_n") + of).cast("int").alias("_part")

    texts = hits.join(spread, "_run").withColumn("_of", all_of("_n"))
    texts = texts.select("_hash", "_run", part(F.pmod("_hash", F.col("_m")), F.col("_of"))).join(hashed, "_hash")
    whose = asking.join(spread, "_run").join(patterns, "_pattern").withColumn("_to", all_of("_m"))
    whose = whose.select("_pattern", "_labels", "_run", "_before", part(F.col("_to"), F.pmod(F.xxhash64("_pattern"), F.col("_n"))))
    # by number, as small rows that make many pairs must not be put together
    number = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whose, texts = (side.repartition(number, "_run", "_part") for side in (whose, texts))
    pairs = whose.hint("merge").join(texts, ["_run", "_part"])
    first = (F.size("_before") == 0) | ~F.exists("_before", lambda k: F.contains(F.col("_text"), k))
    return pairs.filter(F.contains("_text", F.col("_run")) & first)


def candidates(df: DataFrame, patterns: DataFrame, column: str, name: str = "name") -> DataFrame:
    """Pairs of text hash and pattern that `matches` tests, besides patterns without a literal run."""
    known = _given(patterns.select(quoted(name).alias("_pattern"), F.lit(None).cast("string").alias("_label")))
    return _candidates(df, quoted(column), known).select("_hash", "_pattern").distinct()


def _given(patterns: DataFrame) -> DataFrame:
    """(_pattern, _labels): each pattern with its labels, as often as they are given."""
    known = patterns.filter("_pattern is not null").repartition(PARTS, "_pattern")
    return known.groupBy("_pattern").agg(F.collect_list(F.struct("_label")).alias("_labels"))


def matches(
    df: DataFrame, patterns: DataFrame, column: str, name: str = "name", label: str = "label", open_limit: int = 1000
) -> DataFrame:
    """Rows with name and label of every pattern found in the column; rows without a match drop.

    A missing text matches nothing, a missing pattern is found nowhere, the empty one in every text.
    Patterns given twice match twice, repeated rows stay.  Patterns without a literal run of three
    characters are a stated set that every row is tested against; more than `open_limit` of them
    are an error.  A pattern that is no regular expression is an error once a text is tested against it.
    """
    text = quoted(column)
    given = _given(patterns.select(quoted(name).alias("_pattern"), quoted(label).alias("_label")))

    # rlike compiles a pattern anew for every row, this keeps the last one
    found = _candidates(df, text, given).filter(F.regexp_instr("_text", F.col("_pattern")) > 0)
    found = found.select("_row", "_pattern", F.inline("_labels")).select("_row.*", F.col("_pattern").alias(name), F.col("_label").alias(label))

    columns = [quoted(c) for c in df.columns]
    few = with_keys(given).filter("_alternatives is null").select("_pattern", F.inline("_labels")).limit(open_limit + 1)
    pair = F.struct(F.col("_pattern").alias(name), F.col("_label").alias(label))
    listed = few.agg(F.collect_list(pair).alias("ps")).select(
        F.when(F.size("ps") > open_limit, F.raise_error(F.lit(f"more than {open_limit} patterns hold no literal text")))
        .otherwise(F.col("ps"))
    )
    every = df.withColumn("_patterns", listed.scalar())
    hits = F.filter("_patterns", lambda p: F.rlike(text, p[name]))
    return found.union(every.select(*columns, F.inline(hits)))
