"""Result tables about the whole network."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import answered, no_answer, strict_mean, sum_or_zero
from ..operators.aggregate import (
    counts,
    frequency_table,
    matrix_totals,
    mean_of_sums,
    share_of_group,
    top_value,
    top_values,
    totals,
    yes_rate,
)
from ..operators.clean import drop_no_answer
from ..operators.joins import keep_ids, lookup
from ..operators.reshape import complete, named_levels
from ..operators.sets import sorted_nulls_last, union_all
from ..operators.windows import positions_of_counts, stacked_positions
from .combine import HEADCOUNTS, estimated_groups
from .people import PERSON_IDS

# Answer levels in display order.
COMPLETE_LEVELS = ["ja", "zum Teil", "nein", "keine Angabe"]
CHANGE_LEVELS = ["Genau wie bisher auch", "Auf anderem Weg, und zwar:", "keine Angabe"]
NATIONWIDE = "Deutschlandweit"


def key_figures(group_data: DataFrame, people: DataFrame) -> DataFrame:
    """Groups, participants and staff per edition, as reported by both forms."""
    groups = group_data.groupBy("year").agg(
        F.count(F.lit(1)).alias("og_nach_og"),
        sum_or_zero("anzahl_tn").alias("tn_nach_og"),
        sum_or_zero("anzahl_ma_leitung").alias("leitung_og"),
        sum_or_zero("anzahl_insg").alias("insgesamt_og"),
    )
    persons = people.groupBy("year").agg(
        F.count_distinct(F.when(answered("og_name"), F.col("og_name"))).alias("og_nach_tn"),
        F.count(F.lit(1)).alias("tn_nach_tn"),
        F.count_if(F.col("verantwortung_janein") == "Nein").alias("tn_ohne_verantwortung"),
        F.count_if(F.col("verantwortung_janein") == "Ja").alias("tn_mit_verantwortung"),
    )
    both = union_all([groups, persons])
    figures = [c for c in both.columns if c != "year"]
    return both.groupBy("year").agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in figures])


def region_groups(group_data: DataFrame, people: DataFrame) -> DataFrame:
    """All groups with their head counts: the rows behind the region table."""
    reported = group_data.select(
        "year", "region_grouped", F.col("og_region").alias("og_region_detail"), "og_name", *HEADCOUNTS
    )
    return union_all([reported, estimated_groups(group_data, people, with_region=False)])


def region_table(groups: DataFrame, regions: DataFrame) -> DataFrame:
    """Totals and number of groups per region, with the region's page slug."""
    agg = totals(groups, ["year", "region_grouped"], HEADCOUNTS, {"n_og": "og_name"})
    slugs = regions.select("region_grouped", "slug").distinct()
    return sorted_nulls_last(lookup(agg, slugs, "region_grouped"), ["year", "region_grouped"])


def groups_of_region(groups: DataFrame, region: str, details: bool = False) -> DataFrame:
    """Drill-down of one region; with details the sub-region follows the name."""
    child = groups.filter(F.col("region_grouped") == region)
    if details:
        named = F.concat(F.col("og_name"), F.lit(" ("), F.col("og_region_detail"), F.lit(")"))
        child = child.withColumn("og_name", F.coalesce(named, F.col("og_name")))
    return sorted_nulls_last(child.select("year", "og_name", *HEADCOUNTS), ["year", "og_name"])


def gender_shares(gender: DataFrame) -> DataFrame:
    cells = matrix_totals(gender, ["year", "person_type", "gender"])
    return positions_of_counts(cells, "gender", ["year", "person_type"], n="total")


def age_totals(age: DataFrame, shown: Column | None = None) -> DataFrame:
    """Age classes per person type of the shown editions, with the largest total as common axis limit."""
    rows = age if shown is None else age.filter(shown)
    cells = matrix_totals(rows, ["year", "person_type", "alter"])
    # one row for each cell of the matrix and edition is left
    return cells.withColumn("max_total", F.max("total").over(Window.partitionBy()))


def engagement(
    group_data: DataFrame, people: DataFrame, weekdays: DataFrame, skip_missing: bool = False
) -> DataFrame:
    """Hours, meeting length, favorite day and shows per edition.

    Mean meeting length and mean shows are unknown as soon as one answer is
    missing, unless skip_missing is set.
    """
    mean = F.avg if skip_missing else strict_mean
    groups = group_data.groupBy("year").agg(
        F.bround(F.avg("hauptamt_stunden"), 1).alias("ma_avg_stunden"),
        F.bround(sum_or_zero("hauptamt_stunden") * 52).alias("ma_total_stunden"),
        F.bround(mean(F.col("auftritte")), 1).alias("avg_auftritte"),
    )
    groups = groups.withColumns(
        {"auftritte_von": F.floor("avg_auftritte"), "auftritte_bis": F.ceil("avg_auftritte")}
    )
    persons = people.groupBy("year").agg(
        F.bround(F.avg("stunden_pro_woche"), 1).alias("tn_avg_stunden"),
        F.bround(sum_or_zero("stunden_pro_woche") * 52).alias("tn_total_stunden"),
    )
    meetings = weekdays.groupBy("year").agg(
        F.bround(mean(F.col("stunden")) * 60).alias("avg_dauer_minuten")
    )
    day = top_value(weekdays, "wochentag", ["year"]).select("year", F.col("wochentag").alias("lieblingstag"))
    weekly = mean_of_sums(weekdays, ["year", "og_id"], "stunden", ["year"], "stunden_pro_woche_og")
    weekly = weekly.withColumn("stunden_pro_jahr_og", F.bround(F.col("stunden_pro_woche_og") * 52))
    out = groups
    for part in (persons, meetings, day, weekly):
        out = out.join(part, "year", "left")
    return out


def wanted_help(people: DataFrame, help_long: DataFrame) -> DataFrame:
    """Wanted help of people with and without responsibility, as shares of each."""
    resp = people.select(*PERSON_IDS, "verantwortung_janein")
    long = help_long.join(resp, list(PERSON_IDS), "left").filter(F.col("verantwortung_janein").isNotNull())
    n = counts(long, ["year", "hilfsangebot", "verantwortung_janein"])
    return share_of_group(n, ["year", "verantwortung_janein"], "n", "pct", closed=True)


def responsibility_shares(people: DataFrame) -> DataFrame:
    n = counts(people, ["year", "verantwortung_janein"])
    out = share_of_group(n, "year", "n", "perc", closed=True)
    return out.withColumn("perc", F.bround(F.col("perc") * 100, 1))


def most_wanted_help(help_table: DataFrame) -> DataFrame:
    return top_values(help_table, ["year", "verantwortung_janein"])


def largest_share(table: DataFrame, share: str, years: Sequence[int] | None = None) -> Column:
    """Common axis limit: the largest share over the given editions, as a scalar."""
    rows = table if years is None else table.filter(F.col("year").isin(list(years)))
    return rows.agg(F.max(share)).scalar()


def recommendation(people: DataFrame) -> DataFrame:
    """Distribution of the recommendation score, with the common axis limit."""
    out = frequency_table(people.withColumnRenamed("wahrsch_empfehlung", "value"), "value", ["year"])
    # a few rows for each year are left
    return out.withColumn("y_limit", F.max("percent").over(Window.partitionBy()))


def info_complete(people: DataFrame) -> DataFrame:
    known = people.select("year", no_answer("info_komplett").alias("info_komplett"))
    return stacked_positions(known, "info_komplett", ["year"], COMPLETE_LEVELS, percent=False)


def info_change(people: DataFrame) -> DataFrame:
    known = people.select("year", no_answer("info_wege_aenderung").alias("info_wege_aenderung"))
    return stacked_positions(known, "info_wege_aenderung", ["year"], CHANGE_LEVELS, percent=False)


def info_channels(channels: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Use of every channel of the form that somebody named, as percent of the people who answered."""
    n = counts(channels, ["year", "info_weg"])
    n = complete(n, ["year"], "info_weg", named_levels(n, "info_weg", levels))
    people = channels.groupBy("year").agg(F.count_distinct("tn_id").alias("n_personen"))
    return n.join(people, "year").withColumn("perc", F.col("n") * 100 / F.col("n_personen"))


def participation_by_region(people: DataFrame, column: str) -> DataFrame:
    """Yes and no per region, and the nationwide percentage of all rows."""
    regional = yes_rate(drop_no_answer(people, "region_grouped"), ["year", "region_grouped"], column)
    nation = people.groupBy("year").agg(
        F.bround(F.count_if(F.col(column) == "Ja") * 100 / F.count(F.lit(1)), 1).alias("pct_ja")
    )
    return union_all([regional, nation.withColumn("region_grouped", F.lit(NATIONWIDE))])


def participation_comparison(people: DataFrame) -> DataFrame:
    """National against regional events, missing answers as their own category."""
    parts = []
    for column, title in (
        ("teilnahme_dtlweit", "deutschlandweit"),
        ("teilnahme_og_uebergreifend", "ortsgruppenübergreifend / regional"),
    ):
        pie = stacked_positions(people, column, ["year"])
        parts.append(
            pie.withColumns(
                {
                    "type_veranst": F.lit(title),
                    "teilnahme": no_answer(column),
                    "perc": F.col("perc") / 100,
                }
            ).drop(column)
        )
    return union_all(parts)


def barriers(people: DataFrame, reasons: DataFrame) -> DataFrame:
    """Reasons of people who missed national or regional events, per such person."""
    out = people.filter(
        (F.col("teilnahme_og_uebergreifend") == "Nein") | (F.col("teilnahme_dtlweit") == "Nein")
    ).select(*PERSON_IDS)
    n = counts(keep_ids(reasons, out, PERSON_IDS), ["year", "grund"])
    total = counts(out, "year", "n_personen")
    return n.join(total, "year").withColumn("percent", F.col("n") / F.col("n_personen"))


def need_distribution(needs: DataFrame, ranks: DataFrame) -> DataFrame:
    """Answers per need in plot order, as share of the need's answers."""
    order = ranks.select(F.col("label").alias("bedarf_value"), F.col("rank").alias("order"))
    n = counts(needs, ["year", "bedarf", "bedarf_value"])
    ordered = lookup(n, order, "bedarf_value")
    total = n.groupBy("year", "bedarf").agg(F.sum("n").alias("n_antwort"))
    out = lookup(ordered, total, ["year", "bedarf"], null_safe=True)
    return out.withColumn("prop", F.col("n") / F.col("n_antwort"))
