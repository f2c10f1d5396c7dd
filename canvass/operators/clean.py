"""Row and column cleaning of raw submissions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import answered, as_col, no_answer, quoted

SYSTEM_PREFIXES = ("_", "meta")
SYSTEM_NAMES = ("formhub/uuid", "start", "end")


def drop_system_columns(
    df: DataFrame,
    prefixes: Sequence[str] = SYSTEM_PREFIXES,
    names: Sequence[str] = SYSTEM_NAMES,
) -> DataFrame:
    """Project away form-server bookkeeping; the scan then never reads it."""
    keep = [c for c in df.columns if not c.startswith(tuple(prefixes)) and c not in names]
    return df.select(*[quoted(c) for c in keep])


def before_deadline(df: DataFrame, year: int | str | Column, end: str = "end") -> DataFrame:
    """Submissions that ended before 1 January of the following year."""
    y = F.lit(year) if isinstance(year, int) else as_col(year)
    return df.filter(quoted(end) < F.make_date(y + 1, F.lit(1), F.lit(1)))


def drop_empty_rows(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Rows in which some column other than the ids has a value."""
    answers = [c for c in df.columns if c not in ids]
    return df.dropna("all", subset=["`" + c + "`" for c in answers]) if answers else df


def add_missing_columns(df: DataFrame, columns: Sequence[str], dtype: str = "string") -> DataFrame:
    """Questions nobody answered are absent from the export; add them as NULL."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(dtype) for c in absent}) if absent else df


def pick(df: DataFrame, columns: Sequence[str] = (), suffix: str = "_id") -> DataFrame:
    """Id columns by suffix, plus the named columns."""
    ids = [c for c in df.columns if c.endswith(suffix) and c not in columns]
    return df.select(*[quoted(c) for c in [*ids, *columns]])


def drop_no_answer(df: DataFrame, column: str) -> DataFrame:
    return df.filter(answered(column))


def fill_no_answer(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: no_answer(c) for c in columns})


def fill_region(name: str, region: str, own_region: str) -> Column:
    """The person's own region answer, where neither name nor region was resolved."""
    name, region = as_col(name), as_col(region)
    return F.when(name.isNull() & region.isNull(), as_col(own_region)).otherwise(region)


def slice_region(
    data: DataFrame,
    tables: Mapping[str, DataFrame],
    region: str,
    ids: Sequence[str],
) -> dict[str, DataFrame]:
    """One region of a set of tables.

    `data` is filtered by region; tables that carry the ids keep the rows of the
    remaining entities, tables without ids are filtered by their own region column.
    """
    kept = data.filter(F.col("region_grouped") == region)
    entity = kept.select(*ids)
    out = {"data": kept}
    for name, table in tables.items():
        if set(ids) <= set(table.columns):
            out[name] = table.join(entity, list(ids), "left_semi")
        else:
            out[name] = table.filter(F.col("region_grouped") == region)
    return out
