"""Operators that keep published tables from pointing at a person."""

from __future__ import annotations

import secrets
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import quoted
from .joins import lookup

# smallest group whose statistics may be shown
MIN_CELL = 3


def delink(df: DataFrame, column: str, ids: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One answer column in random order, without ids.

    Every call draws a new secret, so the order cannot be computed again by those
    who know ids and answers.  `keep` may name the edition, never anything that
    points at an entity.
    """
    return released(df, column, ids, secrets.token_hex(32), keep)


def released(df: DataFrame, column: str, ids: Sequence[str], secret: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows sorted by a cryptographic hash over the secret, the ids and the answer.

    A task that is run again after a lost executor sorts its rows the same way,
    which rand() would not.  Hashes spread evenly, so one shuffle is enough
    and no task sees the whole column.
    """
    # the column name keeps the orders of two released columns unrelated
    parts = [F.lit(secret), F.lit(column), *[quoted(c).cast("string") for c in ids], quoted(column).cast("string")]
    order = F.sha2(F.to_json(F.array(*parts)).cast("binary"), 256)
    rows = df.select(*keep, quoted(column), order.alias("_order"))
    return rows.repartition("_order").sortWithinPartitions("_order").drop("_order")


def suppress_small(
    df: DataFrame, columns: Sequence[str], size: str = "n", k: int = MIN_CELL
) -> DataFrame:
    """Values of groups smaller than k become NULL."""
    return df.withColumns({c: F.when(F.col(size) >= k, F.col(c)) for c in columns})


def _smallest(cells: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """For each line of a table its two smallest inner cells above 0, as an array of `value`."""
    line = Window.partitionBy(*keys).orderBy("n", value)
    inner = cells.filter(~F.col("row_total") & ~F.col("column_total") & (F.col("n") > 0))
    two = inner.withColumn("_at", F.row_number().over(line)).filter("_at <= 2")
    listed = F.array_sort(F.collect_list(F.struct("_at", value)))
    return two.groupBy(*keys).agg(F.transform(listed, lambda x: x[value]).alias(name))


def _other_than(listed: str, own: str) -> Column:
    """The first of the listed values that is not the cell's own; NULL stands for the total."""
    return F.get(F.filter(F.coalesce(F.col(listed), F.array().cast("array<string>")), lambda v: ~v.eqNullSafe(F.col(own))), F.lit(0))


def protected_totals(
    df: DataFrame, by: Sequence[str], row: str, column: str, size: str = "n", k: int = MIN_CELL
) -> DataFrame:
    """Cells of two-way tables with their totals, of which none that is withheld can be reckoned from the others.

    `df` holds the counted cells of the tables told apart by `by`, one row per `row` and `column` (named,
    turned into text); cells that are left out are 0 for
    everybody to see, unless one becomes a companion and gets a row.  The result has, for every
    cell, row total, column total and grand total (`row_total`: of a row, over its columns;
    `column_total`: of a column, over its rows; both: of the table; the name that does not apply is
    NULL), `released` (NULL where withheld) and `withheld` ("small", "companion" or NULL).

    A count below k is withheld.  Alone in its row or column it would be the difference of a total and the
    other cells, so each such cell gets a rectangle of withheld cells: a companion in its row, one in
    its column, and the cell opposite.  Around a rectangle counts can move by one and all released numbers stay as they
    are; companions are above 0 where they have to go down, so the other solution is a table of counts, too.
    The smallest counts are taken, totals only where nothing else is left.
    """
    keys = list(by)
    named = df.select(*keys, quoted(row).cast("string").alias(row), quoted(column).cast("string").alias(column), F.col(size).alias("n"))
    if named.columns != [*keys, row, column, "n"] or "n" in (*keys, row, column):
        raise ValueError("columns of the table clash with n")
    named = named.filter(F.col(row).isNotNull() & F.col(column).isNotNull())
    sets = [[*keys, row, column], [*keys, row], [*keys, column], keys]
    cells = named.groupingSets([[F.col(c) for c in s] for s in sets], *keys, row, column).agg(
        F.sum("n").alias("n"), (F.grouping(column) == 1).alias("row_total"), (F.grouping(row) == 1).alias("column_total")
    )
    places = [*keys, row, column]

    small = cells.filter(F.col("n") < k)
    in_row = _smallest(cells, [*keys, row], column, "_in_row")
    in_column = _smallest(cells, [*keys, column], row, "_in_column")
    inner = small.filter(~F.col("row_total") & ~F.col("column_total"))
    inner = _attach(_attach(inner, in_row, [*keys, row]), in_column, [*keys, column])
    inner = inner.select(*places, _other_than("_in_row", column).alias("_c"), _other_than("_in_column", row).alias("_r"))

    # a total goes with some cell of its own line, and with another line that has a count to give
    listed = cells.filter(~F.col("row_total") & ~F.col("column_total"))
    of_row = small.filter(F.col("row_total") & ~F.col("column_total"))
    of_row = _attach(of_row, listed.groupBy(*keys, row).agg(F.min_by(column, F.struct("n", column)).alias("_c")), [*keys, row])
    of_row = _attach(of_row, in_column.withColumnRenamed(column, "_c"), [*keys, "_c"])
    of_row = of_row.select(*places, "_c", _other_than("_in_column", row).alias("_r"))
    of_column = small.filter(F.col("column_total") & ~F.col("row_total"))
    of_column = _attach(of_column, listed.groupBy(*keys, column).agg(F.min_by(row, F.struct("n", row)).alias("_r")), [*keys, column])
    of_column = _attach(of_column, in_row.withColumnRenamed(row, "_r"), [*keys, "_r"])
    of_column = of_column.select(*places, _other_than("_in_row", column).alias("_c"), "_r")
    whole = small.filter(F.col("row_total") & F.col("column_total"))
    some = listed.groupBy(*keys).agg(F.min_by(F.struct(F.col(row).alias("r"), F.col(column).alias("c")), F.struct("n", row, column)).alias("_s"))
    whole = _attach(whole, some, keys) if keys else whole.withColumn("_s", some.select("_s").scalar())
    whole = whole.select(*places, F.col("_s.c").alias("_c"), F.col("_s.r").alias("_r"))

    corners = inner.unionByName(of_row).unionByName(of_column).unionByName(whole)
    corner = F.array(
        F.struct(F.col(row).alias("r"), F.col("_c").alias("c")),
        F.struct(F.col("_r").alias("r"), F.col(column).alias("c")),
        F.struct(F.col("_r").alias("r"), F.col("_c").alias("c")),
    )
    taken = corners.select(*keys, F.explode(corner).alias("_p")).select(
        *keys, F.col("_p.r").alias(row), F.col("_p.c").alias(column), F.lit(0).alias("n"),
        F.col("_p.c").isNull().alias("row_total"), F.col("_p.r").isNull().alias("column_total"), F.lit("companion").alias("_why"),
    ).distinct()
    # a companion that had no row gets one; "small" is the later word of the two
    own = cells.withColumn("_why", F.when(F.col("n") < k, "small"))
    told = own.unionByName(taken).groupBy(*places, "row_total", "column_total").agg(F.sum("n").alias("n"), F.max("_why").alias("withheld"))
    return told.select(*places, "row_total", "column_total", F.when(F.col("withheld").isNull(), F.col("n")).alias("released"), "withheld")


def _attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys that may be NULL."""
    return lookup(left, right, keys, null_safe=True)
