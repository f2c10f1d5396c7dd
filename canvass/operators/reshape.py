"""Wide to long, long to wide, and filling of level grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.local import local_table
from ..functions.missing import quoted, to_int
from .ranges import row_numbers


def multiselect_long(
    df: DataFrame, column: str, ids: Sequence[str], name: str | None = None
) -> DataFrame:
    """One row per ticked option of a space-separated answer; NULL answers vanish."""
    return df.select(
        *[quoted(c) for c in ids],
        F.explode(F.split(quoted(column), " ")).alias(name or column),
    )


def columns_long(
    df: DataFrame,
    columns: Sequence[str],
    value: str,
    ids: Sequence[str],
    variable: str = "col_name",
    keep_null: bool = False,
) -> DataFrame:
    """Chosen columns as (variable, value) rows."""
    long = df.unpivot(
        [quoted(c) for c in ids], [quoted(c) for c in columns], variable, value
    )
    return long if keep_null else long.filter(quoted(value).isNotNull())


def rename_block(df: DataFrame, names: Mapping[str, str], ids: Sequence[str]) -> DataFrame:
    """Ids and a block of columns, each path renamed by its own entry."""
    return df.select(
        *[quoted(c) for c in ids], *[quoted(c).alias(n) for c, n in names.items()]
    )


def presence_matrix(
    df: DataFrame, by: str | Sequence[str], option: str, levels: Sequence[str]
) -> DataFrame:
    """One 0/1 column per level; the explicit level list fixes columns and order."""
    by = [by] if isinstance(by, str) else list(by)
    return (
        df.groupBy(*by)
        .pivot(option, list(levels))
        .agg(F.max(F.lit(1)))
        .fillna(0, subset=["`" + c + "`" for c in levels])
    )


def matrix_long(
    matrix: DataFrame,
    by: str | Sequence[str],
    levels: Sequence[str],
    option: str = "option",
    value: str = "has",
) -> DataFrame:
    """Presence matrix back to long, with a mark per cell."""
    by = [by] if isinstance(by, str) else list(by)
    long = columns_long(matrix, levels, value, by, option, keep_null=True)
    return long.withColumn("label", F.when(F.col(value) == 1, "✓").otherwise("✗"))


def named_levels(df: DataFrame, column: str, levels: Sequence[str]) -> Column:
    """Those levels of a form that somebody named, as an array: a scalar subquery that keeps each level once."""
    listed = df.select(column).filter(F.col(column).isin(list(levels)))
    return listed.agg(F.collect_set(column)).scalar()


def with_levels(df: DataFrame, levels: Sequence | Column | DataFrame, name: str) -> DataFrame:
    """Every row of a dimension with every level.

    The levels of a closed question are a list known from the form, or an array
    such as `named_levels` gives.  A table of levels may have any size: see `grid`.
    NULL is not a level.
    """
    if isinstance(levels, DataFrame):
        known = levels.toDF(name).filter(F.col(name).isNotNull())
        return grid(df.drop(name), known)
    if isinstance(levels, Column):
        return df.withColumn(name, F.explode(levels))
    values = list(dict.fromkeys(levels))
    if not values:
        return df.withColumn(name, F.lit(None).cast("string")).filter(F.lit(False))
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def with_rows(df: DataFrame, rows: Sequence[Row]) -> DataFrame:
    """Every row of a dimension with every row of a form's table, known on the driver."""
    listed = [F.struct(*[F.lit(v).alias(k) for k, v in r.asDict().items()]) for r in dict.fromkeys(rows)]
    return df.select("*", F.inline(F.array(*listed))) if listed else df.filter(F.lit(False))


def grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """All combinations of the distinct rows of two dimensions.

    The rows of the right one are numbered, each left row is repeated for all
    numbers, and an equi-join on the number brings the right columns; neither side
    is gathered anywhere.
    """
    numbered = row_numbers(right.distinct(), right.columns, name="_cell")
    last = numbered.agg(F.max("_cell")).scalar()
    cells = left.distinct().withColumn("_cell", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    return cells.join(numbered, "_cell").drop("_cell")


def add_zero_rows(counts: DataFrame, cells: DataFrame, value: str = "n") -> DataFrame:
    """Cells that were never counted, with value 0.

    Zero rows for all cells are added and summed up again: no join, NULL keys
    behave like any other key, and sums combine before the shuffle.
    """
    dtype = counts.schema[value].dataType
    keys = cells.columns
    zeros = cells.withColumn(value, F.lit(0).cast(dtype))
    rows = counts.select(*keys, value).unionByName(zeros)
    return rows.groupBy(*keys).agg(F.sum(value).cast(dtype).alias(value))


def complete(
    counts: DataFrame,
    by: Sequence[str],
    level: str,
    levels: Sequence | Column | DataFrame,
    value: str = "n",
    groups: DataFrame | None = None,
    counted_only: bool = False,
) -> DataFrame:
    """Missing (group, level) pairs with value 0.

    Groups come from the counts themselves, or from a given dimension, which
    saves computing the counts a second time for their groups; counted_only then
    leaves out groups in which nothing was counted.
    """
    base = (groups if groups is not None else counts).select(*by).distinct()
    full = add_zero_rows(counts, with_levels(base, levels, level), value)
    if not counted_only:
        return full
    total = F.sum(value).over(Window.partitionBy(*by))
    return full.withColumn("_total", total).filter(F.col("_total") > 0).drop("_total")


def complete_levels(
    counts: DataFrame, level: str, levels: Sequence | DataFrame, value: str = "n"
) -> DataFrame:
    """Ungrouped variant: every level once, 0 where nothing was counted."""
    if isinstance(levels, DataFrame):
        cells = levels.distinct().toDF(level)
    else:
        rows = [(v,) for v in dict.fromkeys(levels)]
        cells = local_table(counts.sparkSession, rows, T.StructType([counts.schema[level]]))
    return add_zero_rows(counts, cells, value)


def labelled_long(
    df: DataFrame,
    labels: Sequence[tuple[str, Mapping[str, str]]],
    ids: Sequence[str],
    value: str = "value",
    label_names: Sequence[str] = (),
) -> DataFrame:
    """Chosen columns as rows that already carry their labels; NULL answers vanish.

    `labels` lists (column, {label name: label}), worked out from the form before
    the job starts, so no join back to the form is needed.  A column listed twice
    gives two rows.  A block without any column gives no rows; `label_names`
    then tells its label columns.
    """
    if not labels:
        absent = [F.lit(None).cast("string").alias(n) for n in [*label_names, value]]
        return df.select(*[quoted(c) for c in ids], *absent).filter(F.lit(False))
    parts = [
        F.struct(
            *[F.lit(text).cast("string").alias(name) for name, text in about.items()],
            quoted(path).alias(value),
        )
        for path, about in labels
    ]
    long = df.select(*[quoted(c) for c in ids], F.inline(F.array(*parts)))
    return long.filter(quoted(value).isNotNull())


def matrix_cells(
    df: DataFrame,
    cells: Sequence[tuple[str, str, str]],
    ids: Sequence[str],
    row: str,
    col: str,
    value: str = "n",
) -> DataFrame:
    """Matrix block to (row label, column label, whole number)."""
    labels = [(path, {row: r, col: c}) for path, r, c in cells]
    return labelled_long(df, labels, ids, value, [row, col]).withColumn(value, to_int(value))
