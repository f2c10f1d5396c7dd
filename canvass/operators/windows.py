"""Ordered operators.

Windows run only over aggregated rows of one closed question (one row per
answer level) or behind a per-key limit, never over raw answers of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.missing import as_col
from .aggregate import counts
from .ranges import row_numbers
from .reshape import complete


def stacked_positions(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    levels: Sequence[str] | None = None,
    digits: int = 1,
    percent: bool = True,
) -> DataFrame:
    """Counts per answer with what a stacked chart needs.

    csum adds up from the last level, perc is the share of all rows, pos the
    middle of the segment.  With `levels`, unlisted answers count as missing and
    the list gives the order.
    """
    value = F.col(column)
    rows = df.select(*by, column)
    if levels is not None:
        rows = rows.withColumn(column, F.when(value.isin(list(levels)), value))
    return positions_of_counts(counts(rows, [*by, column]), column, by, levels, digits, percent)


def positions_of_counts(
    counted: DataFrame,
    column: str,
    by: Sequence[str] = (),
    levels: Sequence[str] | None = None,
    digits: int = 1,
    percent: bool = True,
    n: str = "n",
) -> DataFrame:
    """Stack positions of levels that are counted already.

    An unknown count makes every sum over it unknown; a position that cannot be
    stacked falls back to the middle of its own segment.
    """
    value, size = F.col(column), F.col(n)
    rank = value if levels is None else level_rank(value, levels)
    w = Window.partitionBy(*by).orderBy(rank.asc_nulls_last())

    def strict(frame: WindowSpec) -> Column:
        known = F.count(F.lit(1)).over(frame) == F.count(n).over(frame)
        return F.when(known, F.sum(n).over(frame))

    whole = strict(Window.partitionBy(*by))
    below = strict(w.rowsBetween(1, Window.unboundedFollowing))
    return counted.withColumns(
        {
            "csum": strict(w.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
            "perc": F.bround(size * 100 / whole, digits) if percent else size / whole,
            "pos": size / 2 + F.coalesce(below, F.lit(0)),
        }
    )


def level_rank(c: str | Column, levels: Sequence[str]) -> Column:
    """Position of a value in its level list, NULL when it is not in the list."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in levels]), as_col(c)), F.lit(0))


def dedup_first(
    df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """First row per key in an explicit order; rows without key are dropped.

    row_number() = 1 is cut to one row per key inside every task before the
    shuffle, so a hot key moves at most one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.dropna(subset=keys)
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def rank_levels(df: DataFrame, level: str, total: str, name: str = "rank") -> DataFrame:
    """Levels numbered by their total, largest first."""
    per_level = df.groupBy(level).agg(F.sum(total).alias("total"))
    return row_numbers(per_level, ["total", level], descending=["total"], name=name).withColumn(name, F.col(name).cast("int"))


def stack_order(df: DataFrame, by: str, level: str, value: str, name: str = "stack_order") -> DataFrame:
    """Min-rank of the value inside each stack, equal values told apart by level."""
    w = Window.partitionBy(by).orderBy(value)
    tie = Window.partitionBy(by).orderBy(value, F.asc_nulls_last(level))
    return df.withColumns({"min_rank": F.rank().over(w), name: F.row_number().over(tie)})


def year_chart(
    df: DataFrame,
    year: str,
    value: str,
    fill: str | None = None,
    levels: Sequence | None = None,
) -> DataFrame:
    """Checked, completed and ranked rows behind a yearly bar chart."""
    missing = [c for c in (year, value, fill) if c is not None and c not in df.columns]
    if missing:
        raise ValueError("Missing columns: " + ", ".join(missing))
    if fill is None:
        return df.select(year, value)
    full = complete(df, [year], fill, levels if levels is not None else df.select(fill).distinct(), value)
    return stack_order(full, year, fill, value)


def number_rows(df: DataFrame, order: str, name: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Row number of form rows in questionnaire order, in each form named by `by`."""
    return row_numbers(df, [order], by, name=name).withColumn(name, F.col(name).cast("int"))


def marker_blocks(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    begin: Column,
    end: Column,
    begin_value: Column,
    name: str = "block",
    chunk: int = 4096,
) -> DataFrame:
    """Rows strictly between a begin marker and the next end marker.

    Each row learns the last marker before it.  That is a running value over the
    rows of a form; to keep any one form from being a single task it is computed
    per chunk of `chunk` order steps, and the last marker of earlier chunks is
    carried over from the much smaller per-chunk summary.
    """
    mark = F.when(begin, F.struct(F.lit(True).alias("open"), begin_value.alias("value"))).when(
        end, F.struct(F.lit(False).alias("open"), begin_value.alias("value"))
    )
    rows = df.withColumns({"_chunk": F.floor(F.col(order) / chunk), "_mark": mark})
    inside = (
        Window.partitionBy(*by, "_chunk")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("_seen", F.last("_mark", ignorenulls=True).over(inside))
    last = rows.groupBy(*by, "_chunk").agg(
        F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col(order))).alias("_last")
    )
    before = (
        Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = last.select(
        *by, "_chunk", F.last("_last", ignorenulls=True).over(before).alias("_carry")
    )
    state = F.coalesce("_seen", "_carry")
    return (
        rows.join(carry, [*by, "_chunk"], "left")
        .withColumn("_state", state)
        .filter(F.col("_mark").isNull() & F.col("_state.open"))
        .withColumn(name, F.col("_state.value"))
        .drop("_chunk", "_mark", "_seen", "_carry", "_state")
    )
