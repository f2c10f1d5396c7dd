"""Sorting and set operations on results and level lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sorted_nulls_last(df: DataFrame, by: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """Multi-key sort with missing values at the end."""
    return df.orderBy(
        *[F.desc_nulls_last(c) if c in descending else F.asc_nulls_last(c) for c in by]
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def level_union(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Sorted distinct known values of a column over several tables."""
    parts = [f.select(column).filter(F.col(column).isNotNull()) for f in frames]
    return reduce(DataFrame.union, parts).distinct().orderBy(column)


def level_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values of the left column that the right one lacks."""
    return left.select(column).subtract(right.select(column))
