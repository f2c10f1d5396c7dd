"""Recoding, lookups and entity filters.

No join here carries a broadcast hint.  Python mappings become literals; for DataFrames Spark's
own size limit (spark.sql.autoBroadcastJoinThreshold, at plan time and again at
run time under adaptive execution) decides between broadcast and shuffle, and
the shuffle path splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import as_col, quoted
from .patterns import matches


class DuplicateKeys(ValueError):
    """A lookup table holds a key twice and would multiply rows."""


def unique_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension itself, after checking that its keys are unique."""
    twice = dim.groupBy(*[quoted(k) for k in keys]).count().filter("count > 1").limit(5).collect()
    if twice:
        raise DuplicateKeys(f"keys {list(keys)} not unique, e.g. {[tuple(r)[:-1] for r in twice]}")
    return dim


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    null_safe: bool = False,
    how: str = "left",
) -> DataFrame:
    """Left join that keeps the left keys and appends the dimension's other columns."""
    if isinstance(on, str):
        on = [on]
    keys = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    renamed = {b: f"_key_{i}" for i, b in enumerate(keys.values())}
    dim = dim.withColumnsRenamed(renamed)
    tests = [
        quoted(a).eqNullSafe(F.col(renamed[b])) if null_safe else quoted(a) == F.col(renamed[b])
        for a, b in keys.items()
    ]
    joined = df.join(dim, reduce(lambda x, y: x & y, tests), how)
    return joined.drop(*renamed.values())


def code_label(
    c: str | Column, mapping: Mapping[str | None, str], null_safe: bool = False
) -> Column:
    """Label of a code, compared as text; an unknown code gives NULL.

    The label of None is that of a missing code, and only used with `null_safe`.
    """
    code = as_col(c).cast("string")
    known = {str(k): v for k, v in mapping.items() if k is not None}
    label = F.lit(None).cast("string")
    if known:
        table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        label = F.try_element_at(table, code)
    if null_safe and None in mapping:
        label = F.when(code.isNull(), F.lit(mapping[None])).otherwise(label)
    return label


def recode(
    df: DataFrame,
    mapping: Mapping[str | None, str] | DataFrame,
    column: str,
    key: str = "name",
    label: str = "label",
    null_safe: bool = False,
    check: bool = True,
) -> DataFrame:
    """Replace the codes of a column by their labels; unmatched codes give NULL.

    Codes are compared as text, and NULL matches a NULL code only with `null_safe`.
    A Python mapping becomes part of the row expression, whatever its length; a
    mapping table is joined, whatever its size, after a check for duplicate
    codes (one pass over it), unless the caller knows it to be unique.
    """
    if isinstance(mapping, Mapping):
        return df.withColumn(column, code_label(column, mapping, null_safe))
    mapping = mapping.select(key, label)
    if check:
        unique_keys(mapping, [key])
    dim = mapping.select(F.col(key).cast("string").alias("_code"), F.col(label).alias("_label"))
    as_text = df.withColumn(column, quoted(column).cast("string"))
    joined = lookup(as_text, dim, {column: "_code"}, null_safe)
    return joined.withColumn(column, F.col("_label")).drop("_label")


def recode_all(
    df: DataFrame, mappings: Mapping[str, Mapping[str | None, str] | DataFrame], null_safe: bool = False
) -> DataFrame:
    """Recode several columns; all Python mappings go into one projection."""
    listed = {c: m for c, m in mappings.items() if isinstance(m, Mapping)}
    if listed:
        df = df.withColumns({c: code_label(c, m, null_safe) for c, m in listed.items()})
    for column, mapping in mappings.items():
        if column not in listed:
            df = recode(df, mapping, column, null_safe=null_safe)
    return df


def attach_other(
    options: DataFrame,
    answers: DataFrame,
    ids: Sequence[str],
    option: str,
    other_code: str,
    text: str,
    name: str,
) -> DataFrame:
    """Free text, attached only to the row of the "other" option."""
    texts = answers.select(
        *ids, F.lit(other_code).alias(option), quoted(text).alias(name)
    ).filter(F.col(name).isNotNull())
    return options.join(texts, [*ids, option], "left")


def multiselect_with_other(
    df: DataFrame,
    column: str,
    text: str,
    ids: Sequence[str],
    option: str,
    name: str,
    other_code: str,
) -> DataFrame:
    """Ticked options plus the free text of the "other" option.

    Both answers sit in the same submission, so no join is needed.
    """
    long = df.select(
        *[quoted(c) for c in ids],
        F.explode(F.split(quoted(column), " ")).alias(option),
        quoted(text).alias(name),
    )
    return long.withColumn(name, F.when(F.col(option) == other_code, F.col(name)))


def regex_join(
    df: DataFrame,
    patterns: Mapping[str, str] | DataFrame,
    column: str,
    name: str = "name",
    label: str = "label",
) -> DataFrame:
    """Rows paired with every pattern found in the column; no match drops the row.

    Patterns come from a form's choice list.  A Python mapping is compiled into
    the row expression.  A table of any size is joined by the literal text of its
    patterns (`patterns.matches`).  Without patterns there are no rows.
    """
    text = quoted(column)
    if isinstance(patterns, DataFrame):
        return matches(df, patterns, column, name, label)
    if not patterns:
        nothing = F.lit(None).cast("string")
        return df.select("*", nothing.alias(name), nothing.alias(label)).filter(F.lit(False))
    hits = F.array(
        *[F.when(text.rlike(p), F.struct(F.lit(p).alias(name), F.lit(v).alias(label))) for p, v in patterns.items()]
    )
    return df.select("*", F.inline(F.array_compact(hits)))


def map_region(df: DataFrame, regions: DataFrame, region: str = "og_region") -> DataFrame:
    """Append the grouped region of each region; the map has one row per region."""
    dim = regions.select(F.col("og_region").alias("_r"), "region_grouped")
    return lookup(df, dim, {region: "_r"}, null_safe=True)


def unmapped(df: DataFrame, dim: DataFrame, column: str, key: str) -> DataFrame:
    """Report of values the dimension does not know, with their row counts."""
    counts = df.filter(quoted(column).isNotNull()).groupBy(quoted(column)).count()
    return counts.join(dim.select(F.col(key).alias(column)), column, "left_anti")


def harmonize(df: DataFrame, spelling: DataFrame, raw: str) -> DataFrame:
    """Raw group names to (og_name, og_region) through the spelling map.

    The map may hold a NULL spelling, which then matches missing names.
    """
    dim = spelling.select(
        F.col("og_name_orig").alias("_raw"), "og_name", "og_region"
    )
    return lookup(df, dim, {raw: "_raw"}, null_safe=True)


def keep_ids(df: DataFrame, entities: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Long rows of surviving entities."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(entities.select(*keys), keys, "left_semi")


def drop_known(df: DataFrame, known: DataFrame, keys: str | Sequence[str], null_known: bool = True) -> DataFrame:
    """Rows whose key is not among the known ones.

    A NULL key is kept unless NULL itself is among the known keys
    (`null_known=True` makes it count); SQL's NOT IN would drop it always.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    seen = known.select(*keys).distinct()
    if not null_known:
        return df.join(seen, keys, "left_anti")
    renamed = seen.toDF(*[f"_known_{k}" for k in keys])
    test = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return df.join(renamed, test, "left_anti")


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all shared columns, NULL matching NULL."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared columns")
    return lookup(left, right, shared, null_safe=True, how="inner")


def suffixed_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str = "_lookup"
) -> DataFrame:
    """Left join; clashing columns of the right side get a suffix."""
    clash = {c: c + suffix for c in right.columns if c in left.columns and c not in on}
    return lookup(left, right.withColumnsRenamed(clash), list(on), null_safe=True)
