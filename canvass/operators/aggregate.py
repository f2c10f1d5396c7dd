"""Aggregations of cleaned survey tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import (
    any3,
    as_col,
    n_distinct,
    quoted,
    strict_sum,
    sum_or_zero,
    to_double,
    yes,
)
from .joins import lookup
from .privacy import MIN_CELL, suppress_small
from .ranges import quantiles


def counts(df: DataFrame, by: str | Sequence[str], name: str = "n") -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def add_count(df: DataFrame, by: str | Sequence[str], name: str = "n") -> DataFrame:
    """Group size attached to every row.

    Counted first and joined back, so a hot group is never gathered in one task.
    """
    by = [by] if isinstance(by, str) else list(by)
    return lookup(df, counts(df, by, name), by, null_safe=True)


def share(
    df: DataFrame, by: str | Sequence[str], of: Column, name: str = "n", share_name: str = "share"
) -> DataFrame:
    """Counts per group over a fixed denominator (a scalar subquery or literal)."""
    out = counts(df, by, name)
    return out.withColumn(share_name, F.col(name) / of)


def all_rows(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


def respondents(df: DataFrame, ids: str | Sequence[str]) -> Column:
    """Number of distinct entities as a scalar subquery."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    key = quoted(ids[0]) if len(ids) == 1 else F.struct(*[quoted(i) for i in ids])
    return df.agg(F.count_distinct(key)).scalar()


def share_of_group(
    df: DataFrame, by: str | Sequence[str], value: str = "n", name: str = "share", closed: bool = False
) -> DataFrame:
    """Value over the total of its group.

    Totals are aggregated and joined back, so that a hot group is split.  Counts
    of a `closed` question have a row for each level of the form, so a window
    over them stays small whatever the number of answers.
    """
    by = [by] if isinstance(by, str) else list(by)
    if closed:
        return df.withColumn(name, F.col(value) / F.sum(value).over(Window.partitionBy(*by)))
    totals = df.groupBy(*by).agg(F.sum(value).alias("_total"))
    out = lookup(df, totals, by, null_safe=True)
    return out.withColumn(name, F.col(value) / F.col("_total")).drop("_total")


def likert_summary(
    df: DataFrame,
    by: str | Sequence[str],
    value: str = "value",
    agree_above: float = 3,
) -> DataFrame:
    """Answers, mean, and number and share of answers above the middle."""
    by = [by] if isinstance(by, str) else list(by)
    v = F.col("_v")
    return (
        df.select(*by, to_double(value).alias("_v"))
        .groupBy(*by)
        .agg(
            F.count(v).alias("total_non_na"),
            F.avg(v).alias("average"),
            F.count_if(v > agree_above).alias("zustimmung"),
        )
        .withColumn(
            "zustimmung_perc",
            F.try_divide(F.col("zustimmung"), F.col("total_non_na")),
        )
    )


def group_mean_suppressed(
    df: DataFrame,
    by: str | Sequence[str],
    value: str,
    name: str = "avg",
    k: int = MIN_CELL,
) -> DataFrame:
    """Rounded mean and size per group; the mean is withheld for small groups."""
    by = [by] if isinstance(by, str) else list(by)
    out = df.groupBy(*by).agg(
        F.bround(F.avg(value)).alias(name), F.count(F.lit(1)).alias("n")
    )
    return suppress_small(out, [name], "n", k)


def headcounts_from_people(
    people: DataFrame, by: Sequence[str], responsible: str = "verantwortung_janein", more: Sequence[Column] = ()
) -> DataFrame:
    """Staff, participants and total per group, estimated from people's answers."""
    staff = yes(responsible)
    return people.groupBy(*by).agg(
        F.count_if(staff).alias("anzahl_ma_leitung"),
        F.count_if(~staff).alias("anzahl_tn"),
        F.count(F.lit(1)).alias("anzahl_insg"),
        *more,
    )


def totals(
    df: DataFrame, by: Sequence[str], sums: Sequence[str], distinct: Mapping[str, str] | None = None
) -> DataFrame:
    """Missing-safe sums and distinct counts per group."""
    cols = [n_distinct(c).alias(n) for n, c in (distinct or {}).items()]
    cols += [sum_or_zero(s).alias(s) for s in sums]
    return df.groupBy(*by).agg(*cols)


def weighted_mean(value: str | Column, weight: str | Column) -> Column:
    """Aggregate expression: mean over rows where value and weight are both known."""
    v, w = as_col(value), as_col(weight)
    both = v.isNotNull() & w.isNotNull()
    return F.try_divide(F.sum(F.when(both, v * w)), F.sum(F.when(both, w)))


def yearly(
    df: DataFrame,
    metrics: Mapping[str, Column],
    by: Sequence[str] = (),
    year: str = "year",
) -> DataFrame:
    """One row per edition (and group): a single pass over all editions."""
    return df.groupBy(year, *by).agg(*[m.alias(n) for n, m in metrics.items()])


def yes_rate(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Yes, no, rows, and percent yes of those who answered."""
    c = F.col(column)
    return df.groupBy(*by).agg(
        F.count_if(c == "Ja").alias("anz_ja"),
        F.count_if(c == "Nein").alias("anz_nein"),
        F.count(F.lit(1)).alias("anz_total"),
        (F.avg((c == "Ja").cast("int")) * 100).alias("pct_ja"),
    )


def percent_by_year(
    df: DataFrame, column: str, choices: Sequence[str], years: Sequence[int], year: str = "year"
) -> DataFrame:
    """Percent of each choice per edition, editions side by side.

    Strict: one missing answer makes that edition's percentages unknown.
    """
    choice = F.explode(F.array(*[F.lit(c) for c in choices])).alias("choice")
    aggs = []
    for y in years:
        here = F.col(year) == y
        rows, known = F.count_if(here), F.count_if(here & F.col(column).isNotNull())
        for i, c in enumerate(choices):
            hit = F.count_if(here & (F.col(column) == c))
            aggs.append(
                F.when((rows > 0) & (rows == known), hit * 100 / rows).alias(f"y{y}_{i}")
            )
    one_row = df.filter(F.col(year).isin(list(years))).agg(*aggs)
    cells = [
        F.struct(F.lit(c).alias("choice"), *[F.col(f"y{y}_{i}").alias(f"pct_{y}") for y in years])
        for i, c in enumerate(choices)
    ]
    return one_row.select(F.inline(F.array(*cells))) if cells else one_row.select(choice)


def mean_of_sums(
    df: DataFrame, ids: Sequence[str], value: str, by: Sequence[str] = (), name: str = "avg", digits: int = 1
) -> DataFrame:
    """Sum per entity, then the rounded mean of these sums."""
    per_entity = df.groupBy(*dict.fromkeys([*by, *ids])).agg(sum_or_zero(value).alias("_sum"))
    return per_entity.groupBy(*by).agg(F.bround(F.avg("_sum"), digits).alias(name))


def top_value(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value; equal counts go to the smallest value."""
    c = counts(df, [*by, column])
    if not by:
        return c.orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(1)
    # max n first, then the smallest value among those
    top = c.groupBy(*by).agg(F.max("n").alias("_max"))
    hit = lookup(c, top, list(by), null_safe=True).filter(F.col("n") == F.col("_max"))
    return hit.groupBy(*by).agg(F.min(column).alias(column), F.max("n").alias("n"))


def top_values(
    counted: DataFrame, by: str | Sequence[str], value: str = "n"
) -> DataFrame:
    """All rows that reach their group's maximum, ties kept."""
    by = [by] if isinstance(by, str) else list(by)
    best = counted.groupBy(*by).agg(F.max(value).alias("_max"))
    hit = lookup(counted, best, by, null_safe=True)
    return hit.filter(F.col(value) == F.col("_max")).drop("_max")


def any_per_id(df: DataFrame, ids: Sequence[str], test: Column, name: str) -> DataFrame:
    """Three-valued any per entity; entities with unknown result are dropped."""
    return df.groupBy(*ids).agg(any3(test).alias(name)).filter(F.col(name).isNotNull())


def item_stats(df: DataFrame, by: Sequence[str], value: str, closed: bool = False) -> DataFrame:
    """Median, mean, sd and range of a number per item.

    Answers are first reduced to one row per (item, value).  The exact median of a
    `closed` scale, with a few values, is taken from these frequencies in one
    aggregate; that of an open number by ranges, so that no task holds an item's values.
    """
    v, n = F.col(value), F.col("_n")
    freq = (
        df.filter(v.isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    x = v.cast("double")
    total, s1, s2 = F.sum(n), F.sum(x * n), F.sum(x * x * n)
    var = F.try_divide(s2 - s1 * s1 / total, total - 1)
    known = freq.groupBy(*by).agg(
        *([F.percentile(v, 0.5, n).alias("median_bedarf")] if closed else []),
        F.try_divide(s1, total).alias("bedarf_mean"),
        F.when(total > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("sd"),
        (F.max(v) - F.min(v)).alias("range"),
    )
    items = df.select(*by).distinct()
    out = lookup(items, known, list(by), null_safe=True)
    if closed:
        return out
    told = quantiles(df, value, [0.5], by).select(*by, F.col("quantiles")[0].alias("median_bedarf"))
    return lookup(out, told, list(by), null_safe=True)


# Sentences by level and spread of a need; four have two blanks inside.
NEED_SENTENCES = {
    ("hoch", "konstant"): "Der Bedarf ist hoch und über die Ortsgruppen hinweg relativ einheitlich.",
    ("hoch", "variierend"): "Der Bedarf ist hoch aber variiert zwischen den Ortsgruppen.",
    ("mittel", "konstant"): "Der Bedarf ist mittel  und über die Ortsgruppen hinweg relativ einheitlich.",
    ("mittel", "variierend"): "Der Bedarf ist mittel  aber variiert zwischen den Ortsgruppen.",
    ("gering", "konstant"): "Der Bedarf ist gering  und über die Ortsgruppen hinweg relativ einheitlich.",
    ("gering", "variierend"): "Der Bedarf ist gering  aber variiert zwischen den Ortsgruppen.",
}
NOT_ENOUGH = "Nicht genug Informationen *"


def need_bands(stats: DataFrame) -> DataFrame:
    """Verbal bands of mean and spread, and one explaining sentence."""
    mean, spread = F.col("bedarf_mean"), F.col("range")
    level = (
        F.when((mean > 0) & (mean <= 1), "gering")
        .when((mean > 1) & (mean <= 2), "mittel")
        .when((mean > 2) & (mean <= 3), "hoch")
    )
    even = F.when((spread >= 0) & (spread <= 1), "konstant").when(
        (spread > 1) & (spread <= 3), "variierend"
    )
    out = stats.withColumns({"bedarf_label": level, "sd_label": even})
    known = [
        F.when((F.col("bedarf_label") == need) & (F.col("sd_label") == spread), sentence)
        for (need, spread), sentence in NEED_SENTENCES.items()
    ]
    return out.withColumn("erklaerung", F.coalesce(*known, F.lit(NOT_ENOUGH)))


def frequency_table(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts and shares of the known values."""
    c = counts(df.filter(F.col(value).isNotNull()), [*by, value])
    if by:
        return share_of_group(c, by, "n", "percent")
    return c.withColumn("percent", F.col("n") / c.agg(F.sum("n")).scalar())


def share_at_least(value: str | Column, limit: float) -> Column:
    """Aggregate expression: share of known values at or above the limit."""
    v = as_col(value)
    return F.try_divide(F.count_if(v >= limit), F.count(v))


def word_frequency(df: DataFrame, word: str, above: int = 4, by: Sequence[str] = ()) -> DataFrame:
    """Free-text words given more often than the threshold."""
    return counts(df, [*by, word], "freq").filter(F.col("freq") > above)


def matrix_totals(df: DataFrame, by: Sequence[str], value: str = "n") -> DataFrame:
    """Strict totals per matrix cell."""
    return df.groupBy(*by).agg(strict_sum(value).alias("total"))


def distribution_within(df: DataFrame, group: Sequence[str], value: str, name: str = "percent") -> DataFrame:
    """Distribution of a value inside each group."""
    return share_of_group(counts(df, [*group, value]), list(group), "n", name)
