"""Result tables over all editions: one pass over the partitioned tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import n_distinct, strict_sum, sum_or_zero
from ..functions.text import titled
from ..operators.aggregate import likert_summary, yearly
from ..operators.clean import drop_no_answer
from ..operators.joins import lookup
from ..operators.reshape import columns_long
from ..operators.sets import sorted_nulls_last


def groups_per_year(group_totals: DataFrame) -> DataFrame:
    return yearly(group_totals, {"ortsgruppen": n_distinct("og_name")})


def groups_per_year_and_region(group_totals: DataFrame) -> DataFrame:
    """Number of groups for every region and edition, regions by size."""
    known = drop_no_answer(group_totals, "region_grouped")
    n = yearly(known, {"ortsgruppen": n_distinct("og_name")}, ["region_grouped"])
    # from here on there is one row for each region
    entry = F.struct("year", F.col("ortsgruppen").alias("n"))
    regions = n.groupBy("region_grouped").agg(F.collect_list(entry).alias("entries"), F.sum("ortsgruppen").alias("total"))
    everything = F.flatten(F.collect_list(F.col("entries.year")).over(Window.partitionBy()))
    rank = F.row_number().over(Window.orderBy(F.desc("total"), F.asc_nulls_last("region_grouped")))
    editions = F.array_compact(F.array_distinct(everything))
    regions = regions.withColumns({"rank": rank, "editions": editions}).filter("region_grouped IS NOT NULL")
    rows = regions.withColumn("year", F.explode(F.array_union("editions", "entries.year")))
    own = F.filter("entries", lambda e: e["year"].eqNullSafe(F.col("year")))
    counted = F.coalesce(F.get(own, F.lit(0))["n"], F.lit(0)).cast(n.schema["ortsgruppen"].dataType)
    return rows.select("region_grouped", "year", counted.alias("ortsgruppen"), "rank")


def people_per_year(group_totals: DataFrame) -> DataFrame:
    """Strict sums: one unknown head count makes the edition's sum unknown."""
    return yearly(
        group_totals,
        {
            "teilnehmende": strict_sum("anzahl_tn"),
            "mitarbeitende": strict_sum("anzahl_ma_leitung"),
            "insg": strict_sum("anzahl_insg"),
        },
    )


def people_per_year_long(group_totals: DataFrame) -> DataFrame:
    """Participants and staff as rows for a grouped chart."""
    wide = people_per_year(group_totals).select(
        "year", F.col("teilnehmende").alias("Teilnehmende"), F.col("mitarbeitende").alias("Mitarbeitende")
    )
    return columns_long(wide, ["Teilnehmende", "Mitarbeitende"], "anzahl", ["year"], "gruppe", keep_null=True)


def people_per_year_and_region(group_totals: DataFrame, skip_missing: bool = False) -> DataFrame:
    """Active people per region and edition, with the common axis limit.

    One unknown head count makes its sum, and with it the limit, unknown, unless
    skip_missing is set.
    """
    add = sum_or_zero if skip_missing else strict_sum
    out = yearly(group_totals, {"insg": add("anzahl_insg")}, ["region_grouped"])
    # one row for each region and edition is left
    all_of_it = Window.partitionBy()
    top, known = F.max("insg").over(all_of_it), F.count("insg").over(all_of_it) == F.count(F.lit(1)).over(all_of_it)
    return out.withColumn("y_max", top if skip_missing else F.when(known, top))


def shows_per_year(group_data: DataFrame) -> DataFrame:
    return yearly(group_data, {"auftritte": sum_or_zero("auftritte")})


def yes_per_year(people: DataFrame, column: str) -> DataFrame:
    return yearly(people, {"count": F.count_if(F.col(column) == "Ja")})


def agreement_per_year(statements: DataFrame, labels: DataFrame, titles: Mapping[str, str]) -> DataFrame:
    """Agreement per statement over the editions, with chart and tab titles.

    A statement without a title shows its name on the axis and sorts by its label.
    """
    agg = likert_summary(statements, ["year", "aussage"])
    out = lookup(agg, labels.select("aussage", F.col("q_label").alias("label")), "aussage")
    out = out.withColumns(
        {
            "x_label": titled("aussage", titles),
            "sort_title": titled("aussage", titles, "label"),
        }
    )
    return sorted_nulls_last(out, ["sort_title", "year"])


def answer_counts(group_data: DataFrame, people: DataFrame) -> DataFrame:
    """Submissions of both forms per edition, newest edition first."""
    groups = group_data.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    persons = people.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    both = groups.withColumn("form", F.lit("og")).unionByName(persons.withColumn("form", F.lit("tn")))
    return (
        both.groupBy("year")
        .agg(
            sum_or_zero(F.when(F.col("form") == "og", F.col("n"))).alias("n_og"),
            sum_or_zero(F.when(F.col("form") == "tn", F.col("n"))).alias("n_tn"),
            F.sum("n").alias("n_gesamt"),
        )
        .orderBy(F.desc("year"))
    )
