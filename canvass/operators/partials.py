"""Aggregates that merge: sums with their known and all counts, and distinct counts as bitmaps.

A state holds, for the finest groups, what every coarser level can be computed from:
totals, how many values were known, how many rows there were, and which of the
densely numbered entities occurred.  Levels are then grouping sets over the states,
not new passes over the rows, and states of other editions are simply added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import quoted
from .joins import lookup
from .ranges import ranks

NUMBER, BUCKET, BITS = "_number", "_bucket", "_bits"


def numbered(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows with the dense number, from 1, of the entity in `column` (in each group of `by`); NULL has none."""
    values = df.select(*[quoted(b).alias(b) for b in by], quoted(column).alias(column)).distinct()
    told = ranks(values.filter(quoted(column).isNotNull()), [column], by, rank="_rank", dense_rank=NUMBER).drop("_rank")
    return lookup(df, told, [*by, column], null_safe=True)


def states(
    df: DataFrame, by: Sequence[str], sums: Sequence[str] = (), weighted: Mapping[str, tuple[str, str]] | None = None,
    counted: Mapping[str, Column] | None = None,
) -> DataFrame:
    """States of the groups `by`: a row for each bucket of entity numbers (see `numbered`).

    `sums` are columns to be added, `weighted` maps a name to value and weight of
    a weighted mean, `counted` a name to a condition.  Without numbers in `df` no
    distinct counts are kept.
    """
    number = F.col(NUMBER) if NUMBER in df.columns else F.lit(None).cast("long")
    rows = df.withColumn(BUCKET, F.bitmap_bucket_number(number))
    aggs = [
        F.count(F.lit(1)).alias("_rows"),
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS),
    ]
    for c in sums:
        aggs += [F.sum(quoted(c)).alias(f"_sum_{c}"), F.count(quoted(c)).alias(f"_known_{c}")]
    for name, (value, weight) in (weighted or {}).items():
        both = quoted(value).isNotNull() & quoted(weight).isNotNull()
        aggs += [
            F.sum(F.when(both, quoted(value) * quoted(weight))).alias(f"_over_{name}"),
            F.sum(F.when(both, quoted(weight))).alias(f"_under_{name}"),
        ]
    aggs += [F.count_if(test).alias(f"_count_{name}") for name, test in (counted or {}).items()]
    return rows.groupBy(*[quoted(b) for b in by], BUCKET).agg(*aggs)


def merged(state: DataFrame, levels: Mapping[str, Sequence[str]], level: str = "level") -> DataFrame:
    """States added up for every level, in one aggregate.

    `levels` names the grouping sets; columns that a level does not group by are NULL, and
    `level` tells them from NULL in the data.
    """
    by = list(dict.fromkeys(c for cols in levels.values() for c in cols))
    kept = [c for c in state.columns if c.startswith("_") and c not in (BUCKET, BITS)]
    grouped = state.groupingSets(
        [[*[quoted(c) for c in cols], F.col(BUCKET)] for cols in levels.values()], *[quoted(c) for c in by], F.col(BUCKET)
    ).agg(
        F.grouping_id().alias("_id"), F.bitmap_or_agg(BITS).alias(BITS), *[F.sum(c).alias(c) for c in kept],
    )
    # a bit of the id for each column that is not grouped by, the first column in the highest; the bucket always is
    ids = {sum(2 << i for i, c in enumerate(reversed(by)) if c not in cols): name for name, cols in levels.items()}
    if len(ids) < len(levels):
        raise ValueError("two levels group by the same columns")
    name = F.coalesce(*[F.when(F.col("_id") == i, F.lit(n)) for i, n in ids.items()])
    return grouped.groupBy(name.alias(level), *by).agg(
        F.sum(F.when(F.col(BUCKET).isNotNull(), F.bitmap_count(BITS)).otherwise(0)).alias("_distinct"),
        F.sum(F.when(F.col(BUCKET).isNull(), F.col("_rows")).otherwise(0)).alias("_without"),
        *[F.sum(c).alias(c) for c in kept],
    )


def entities(null_counts: bool = True) -> Column:
    """Distinct entities of a merged state; NULL is one more if it occurs, as in `n_distinct`."""
    known = F.col("_distinct")
    return known + F.when(F.col("_without") > 0, 1).otherwise(0) if null_counts else known


def strict_total(c: str) -> Column:
    """Sum of a merged state, unknown if one value was."""
    return F.when(F.col(f"_known_{c}") == F.col("_rows"), F.col(f"_sum_{c}"))


def known_total(c: str) -> Column:
    """Sum of the known values of a merged state, 0 without any."""
    return F.coalesce(F.col(f"_sum_{c}"), F.lit(0))


def mean_of(name: str) -> Column:
    """Weighted mean of a merged state."""
    return F.try_divide(F.col(f"_over_{name}"), F.col(f"_under_{name}"))


def count_of(name: str) -> Column:
    return F.col(f"_count_{name}")
