"""Row numbers, ranks, running sums and quantiles of tables of any size, without a window over all rows.

The order is cut into ranges by borders that a sample of the keys gives.  Rows
are counted for each range, the counts of earlier ranges are carried over, and
windows run inside one range only.  The sample holds, for each of `RANGES` hash
parts, the key with the smallest hash: a function of the data alone, so a
repeated task finds the same ranges, and as large for a small table as for a
large one.  Keys are counted before they are cut, so a value that a third of all
rows share is one row here.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.missing import quoted
from .joins import lookup

# Ranges of one order.  A window inside a range holds about the distinct keys divided by it.
RANGES = 1024


def _comparable(columns: Sequence[str], descending: Sequence[str]) -> tuple[Column, list[bool]]:
    """A key as a struct of structs, one for each run of columns of one direction, and whether a run is descending.

    Two structs are compared by one call; missing values come last, as everywhere in this library.
    """
    parts, ways = [], []
    for down, run in groupby(columns, lambda c: c in descending):
        fields = [f for c in run for f in (quoted(c).isNotNull() if down else quoted(c).isNull(), quoted(c))]
        parts.append(F.struct(*[f.alias(f"f{i}") for i, f in enumerate(fields)]).alias(f"r{len(ways)}"))
        ways.append(down)
    return F.struct(*parts), ways


def _before(one: Column, other: Column, ways: Sequence[bool]) -> Column:
    """Whether one comparable key comes before another."""
    result = F.lit(False)
    for i, down in reversed(list(enumerate(ways))):
        a, b = one[f"r{i}"], other[f"r{i}"]
        result = (a > b if down else a < b) | ((a == b) & result)
    return result


def _borders(keys: DataFrame, columns: Sequence[str], descending: Sequence[str], ranges: int) -> Column:
    """The sampled keys, comparable and in order, as a scalar subquery."""
    hashed = F.xxhash64(*[quoted(c) for c in columns])
    # one value for each column: numbers are then kept in a hash table, a struct would need all keys sorted
    least = [F.min_by(quoted(c), hashed).alias(c) for c in columns]
    sample = keys.groupBy(F.pmod(hashed, F.lit(ranges)).alias("_part")).agg(*least)
    key, ways = _comparable(columns, descending)

    def order(a: Column, b: Column) -> Column:
        return F.when(_before(a, b, ways), -1).when(_before(b, a, ways), 1).otherwise(0)

    return sample.agg(F.array_sort(F.collect_list(key), order)).scalar()


def with_range(
    keys: DataFrame,
    order: Sequence[str],
    descending: Sequence[str] = (),
    name: str = "_range",
    ranges: int = RANGES,
    sampled: DataFrame | None = None,
) -> DataFrame:
    """Number of the range that each key lies in, from 0; equal keys get the same.

    The borders come from `sampled`, if that holds the same keys and is easier to compute.
    They are searched by halving, one plain projection a step: a lambda over the borders
    would not be compiled.
    """
    columns = list(order)
    key, ways = _comparable(columns, descending)
    borders = _borders(keys if sampled is None else sampled, columns, descending, ranges)
    found = keys.withColumns({"_borders": borders, "_key": key, "_reached": F.lit(0)})
    for step in [2**i for i in reversed(range(ranges.bit_length()))]:
        # beyond the last border there is none
        found = found.withColumn("_border", F.get("_borders", F.col("_reached") + (step - 1)))
        reached = F.col("_border").isNotNull() & ~_before(F.col("_key"), F.col("_border"), ways)
        found = found.withColumn("_reached", F.col("_reached") + F.when(reached, step).otherwise(0))
    return found.withColumn(name, F.col("_reached")).drop("_borders", "_border", "_key", "_reached")


def _sorted(order: Sequence[str], descending: Sequence[str]) -> list[Column]:
    return [quoted(c).desc_nulls_last() if c in descending else quoted(c).asc_nulls_last() for c in order]


def _headed(ranged: DataFrame, heads: DataFrame, by: Sequence[str], order: Sequence[Column]) -> tuple[DataFrame, WindowSpec]:
    """Rows of the ranges, each range led by its row of `heads`, and the window of all rows before one.

    What is known of a range reaches its rows by the sort that they need anyway.  A join on the
    range would have Spark follow that column back through every step that found it.
    """
    rows = ranged.unionByName(heads.withColumn("_head", F.lit(True)), allowMissingColumns=True)
    window = Window.partitionBy(*by, "_range").orderBy(F.col("_head").desc_nulls_last(), *order)
    return rows, window.rowsBetween(Window.unboundedPreceding, -1)


def running_sums(
    counted: DataFrame,
    order: Sequence[str],
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: Sequence[str] = (),
    ranges: int = RANGES,
    sampled: DataFrame | None = None,
) -> DataFrame:
    """For each column of `sums` its total over all earlier rows of the group, as `<column>_before`.

    The rows of a group must differ in their order keys.  Groups are cut like
    everything else, so one group may hold most rows.  `sampled` is that of `with_range`.
    """
    ranged = with_range(counted, [*by, *order], descending, ranges=ranges, sampled=sampled)
    # a group has at most `ranges` rows of these
    parts = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    earlier = Window.partitionBy(*[quoted(b) for b in by] or [F.lit(0)]).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = parts.select(
        *by, "_range", *[F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_{s}_carried") for s in sums]
    )
    rows, before = _headed(ranged, carried, by, _sorted(order, descending))
    out = rows.withColumns(
        {f"{s}_before": F.coalesce(F.first(f"_{s}_carried", True).over(before), F.lit(0)) + F.coalesce(F.sum(s).over(before), F.lit(0)) for s in sums}
    )
    return out.filter("_head IS NULL").drop("_range", "_head", *[f"_{s}_carried" for s in sums])


def row_numbers(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    descending: Sequence[str] = (),
    name: str = "row_number",
    ranges: int = RANGES,
) -> DataFrame:
    """Row number inside each group, in an order that is the same in every run.

    Equal order keys are told apart by the other columns, from left to right;
    equal rows are counted, and get one number each.  No task holds a group.
    """
    rest = [c for c in df.columns if c not in order and c not in by]
    rows = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_rows"))
    placed = running_sums(rows, [*order, *rest], ["_rows"], by, descending, ranges, sampled=df)
    number = F.explode(F.sequence(F.col("_rows_before") + 1, F.col("_rows_before") + F.col("_rows")))
    return placed.select(*[quoted(c) for c in df.columns], number.alias(name))


def ranks(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    descending: Sequence[str] = (),
    rank: str = "rank",
    dense_rank: str = "dense_rank",
    ranges: int = RANGES,
) -> DataFrame:
    """Rank and dense rank inside each group.

    Ranks belong to order keys, so the keys are counted, ranked and joined back; the
    join splits a key that many rows share.
    """
    keys = [*by, *order]
    counted = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows"), F.lit(1).cast("long").alias("_keys"))
    placed = running_sums(counted, order, ["_rows", "_keys"], by, descending, ranges, sampled=df)
    told = placed.select(*keys, (F.col("_rows_before") + 1).alias(rank), (F.col("_keys_before") + 1).alias(dense_rank))
    return lookup(df, told, keys, null_safe=True)


def quantiles(
    df: DataFrame, value: str, wanted: Sequence[float], by: Sequence[str] = (), ranges: int = RANGES
) -> DataFrame:
    """Exact quantiles of a number in each group, interpolated between neighbours, as an array `quantiles`, with `n` known values.

    Distinct values are counted, cut into ranges and counted for each range; that
    tells which ranges hold the wanted positions, and only those are sorted.  A
    group without a known value has n = 0 and no quantiles.
    """
    if any(not 0 <= q <= 1 for q in wanted):
        raise ValueError("quantiles lie between 0 and 1")
    ids = [quoted(b).alias(b) for b in by]
    known = df.select(*ids, quoted(value).cast("double").alias("_value")).filter("_value IS NOT NULL")
    counted = known.groupBy(*by, "_value").agg(F.count(F.lit(1)).alias("_rows"))
    ranged = with_range(counted, [*by, "_value"], ranges=ranges, sampled=known)
    # a group has at most `ranges` rows of these
    parts = ranged.groupBy(*by, "_range").agg(F.sum("_rows").alias("_part"))
    group = [quoted(b) for b in by] or [F.lit(0)]
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    placed = parts.withColumns(
        {"_start": F.coalesce(F.sum("_part").over(earlier), F.lit(0)), "_n": F.sum("_part").over(whole)}
    )
    places = F.array(*[_place(q, F.col("_n"), up) for q in wanted for up in (False, True)])
    held = placed.withColumn("_places", F.array_distinct(places)).withColumn(
        "_places", F.filter("_places", lambda p: (p >= F.col("_start")) & (p < F.col("_start") + F.col("_part")))
    ).filter(F.size("_places") > 0)
    rows, before = _headed(ranged, held.select(*by, "_range", "_start", "_n", "_places"), by, _sorted(["_value"], ()))
    chosen = rows.withColumns({c: F.first(c, True).over(before) for c in ("_start", "_n", "_places")} | {"_earlier": F.sum("_rows").over(before)})
    first = F.col("_start") + F.coalesce("_earlier", F.lit(0))
    at = F.filter("_places", lambda p: (p >= F.col("_first")) & (p < F.col("_first") + F.col("_rows")))
    chosen = chosen.filter("_head IS NULL AND _places IS NOT NULL").withColumn("_first", first)
    found = chosen.select(*by, "_n", "_value", F.explode(at).alias("_place"))
    values = found.groupBy(*by, "_n").agg(F.map_from_entries(F.collect_list(F.struct("_place", "_value"))).alias("_at"))
    told = F.array(*[_between(q) for q in wanted])
    out = values.select(*by, told.alias("quantiles"), F.col("_n").alias("n"))
    if not by:
        nothing = df.sparkSession.range(1).select(F.lit(None).cast("array<double>").alias("quantiles"), F.lit(0).cast("long").alias("n"))
        return out.unionByName(nothing).orderBy(F.desc("n")).limit(1)
    groups = df.select(*ids).distinct()
    return lookup(groups, out, list(by), null_safe=True).fillna(0, ["n"])


def _place(q: float, n: Column, up: bool) -> Column:
    """Position, from 0, of the neighbour below or above the wanted one."""
    exact = F.lit(float(q)) * (n - 1)
    return (F.ceil(exact) if up else F.floor(exact)).cast("long")


def _between(q: float) -> Column:
    n = F.col("_n")
    low, high = F.col("_at")[_place(q, n, False)], F.col("_at")[_place(q, n, True)]
    return low + (high - low) * (F.lit(float(q)) * (n - 1) - _place(q, n, False))
