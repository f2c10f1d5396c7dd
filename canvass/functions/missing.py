"""Expressions with explicit missing-value semantics.

Spark aggregates skip NULL silently.  Survey totals must not: a sum over an
unanswered headcount is unknown unless the caller says otherwise.  The strict
variants return NULL as soon as one input is NULL; the plain Spark functions
stay available for the skipping variants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_ANSWER = "keine Angabe"

# last letters of number spellings that only Java knows: 3d, 3f, inf, NaN, Infinity
_JAVA_ENDINGS = ("d", "f", "n", "y")


def quoted(name: str) -> Column:
    """Column by its literal name; question paths contain '/' and '.'."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_col(c: str | Column) -> Column:
    return quoted(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    """Text to double; anything that is not a finite decimal number becomes NULL."""
    c = as_col(c).cast("string")
    last = F.lower(F.substring(F.trim(c, F.lit(" \t\r\n")), -1, 1))
    number = F.when(~last.isin(*_JAVA_ENDINGS), c).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def to_int(c: str | Column) -> Column:
    """Text to int through double, cutting decimals: "2.7" gives 2."""
    return to_double(c).try_cast("int")


def strict_sum(c: str | Column) -> Column:
    c = as_col(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.coalesce(F.sum(c), F.lit(0)))


def strict_mean(c: str | Column) -> Column:
    c = as_col(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.avg(c))


def strict_max(c: str | Column) -> Column:
    c = as_col(c)
    return F.when(F.count(F.lit(1)) == F.count(c), F.max(c))


def sum_or_zero(c: str | Column) -> Column:
    """NULL-skipping sum that is 0 when nothing is left."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0))


def any3(c: Column) -> Column:
    """Three-valued any: TRUE if one is TRUE, else NULL if one is NULL, else FALSE."""
    return F.when(F.bool_or(c), F.lit(True)).when(
        F.count(F.lit(1)) == F.count(c), F.lit(False)
    )


def n_distinct(c: str | Column) -> Column:
    """Number of distinct values where NULL counts as one value."""
    c = as_col(c)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def no_answer(c: str | Column) -> Column:
    """NULL becomes the reported category."""
    return F.coalesce(as_col(c), F.lit(NO_ANSWER))


def answered(c: str | Column) -> Column:
    """Predicate: neither NULL nor the reported no-answer category."""
    c = as_col(c)
    return c.isNotNull() & (c != NO_ANSWER)


def yes(c: str | Column, value: str = "Ja") -> Column:
    """Boolean proxy of a yes answer; missing counts as no."""
    return F.coalesce(as_col(c) == value, F.lit(False))


def keep_below(c: str | Column, limit: float) -> Column:
    """Values at or above the limit become NULL."""
    c = as_col(c)
    return F.when(c < limit, c)


def drop_above(c: str | Column, limit: float) -> Column:
    """Values above the limit become NULL, the limit itself stays."""
    c = as_col(c)
    return F.when(c <= limit, c)


def empty_to_null(c: str | Column) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def null_to_empty(c: str | Column) -> Column:
    return F.coalesce(as_col(c), F.lit(""))
