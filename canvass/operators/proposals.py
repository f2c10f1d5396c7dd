"""Proposals for names that a spelling map does not know."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import quoted


def _segment(length: Column, at: Column, parts: int) -> tuple[Column, Column]:
    """Start, from 0, and length of one of the even segments of a name of that length; the last ones are longer."""
    base, longer = F.floor(length / parts), length % parts
    start = at * base + F.greatest(F.lit(0), at - (parts - longer))
    return start, base + F.when(at >= parts - longer, 1).otherwise(0)


def _known_keys(name: Column, distance: int) -> Column:
    """Every segment of a known name, with the name's length and the segment's number."""
    length = F.length(name)

    def key(at: Column) -> Column:
        start, size = _segment(length, at, distance + 1)
        return F.struct(length.alias("n"), at.alias("i"), F.substring(name, start + 1, size).alias("s"))

    return F.transform(F.sequence(F.lit(0), F.lit(distance)), key)


def _asked_keys(name: Column, distance: int) -> Column:
    """Stretches of a name that may be an untouched segment of a known one."""
    length = F.length(name)
    shifts = F.sequence(F.lit(-distance), F.lit(distance))

    def of_length(change: Column) -> Column:
        def of_segment(at: Column) -> Column:
            start, size = _segment(length + change, at, distance + 1)

            def shifted(by: Column) -> Column:
                inside = (length + change >= 0) & (start + by >= 0) & (start + by + size <= length)
                part = F.substring(name, start + by + 1, size)
                return F.when(inside, F.struct((length + change).alias("n"), at.alias("i"), part.alias("s")))

            return F.transform(shifts, shifted)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(distance)), of_segment))

    return F.array_distinct(F.array_compact(F.flatten(F.transform(shifts, of_length))))


def propose(names: DataFrame, known: DataFrame, column: str, key: str, distance: int = 2) -> DataFrame:
    """Known names within an edit distance of each name, nearest first.

    `names` has one row per name, as `joins.unmapped` reports them; its columns stay.  Added are
    `proposal`, `distance` and `rank` (ties by the name), NULL where no known name is near.

    A known name is cut into distance + 1 segments.  So many edits leave one of them whole, at most
    that far from its place, so an equi-join on (length, number, segment) finds every near name;
    the number of keys of a name depends on the distance only, not on its length.  A missing name gets no
    proposal, an empty one the known names of up to `distance` characters; known names given twice count once.
    """
    sought = names.select(quoted(column).alias("_name")).filter("_name is not null").distinct()
    sought = sought.select("_name", F.explode(_asked_keys(F.col("_name"), distance)).alias("_key"))
    index = known.select(quoted(key).alias("proposal")).filter("proposal is not null").distinct()
    index = index.select("proposal", F.explode(_known_keys(F.col("proposal"), distance)).alias("_key"))
    pairs = sought.join(index, "_key").select("_name", "proposal").distinct()
    near = pairs.withColumn("distance", F.levenshtein("_name", "proposal", distance)).filter("distance >= 0")
    order = Window.partitionBy("_name").orderBy("distance", "proposal")
    ranked = near.withColumn("rank", F.row_number().over(order))
    return names.join(ranked, quoted(column) == F.col("_name"), "left").drop("_name")
