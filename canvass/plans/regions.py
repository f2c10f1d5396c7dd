"""Result tables of one region or of all regions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import n_distinct, no_answer, sum_or_zero
from ..operators.aggregate import (
    counts,
    item_stats,
    need_bands,
    percent_by_year,
    share_of_group,
    weighted_mean,
)
from ..operators.catalog import form_scale
from ..operators.clean import slice_region
from ..operators.joins import lookup, natural_join, suffixed_join
from ..operators.partials import count_of, entities, known_total, mean_of, merged, numbered, states
from ..operators.privacy import MIN_CELL
from ..operators.reshape import complete, matrix_long, named_levels, presence_matrix, with_rows
from ..operators.sets import sorted_nulls_last, union_all
from .combine import HEADCOUNTS
from .groups import GROUP_IDS
from .people import PERSON_IDS

_GROUP = ["year", "og_name"]


def slice_edition(tables: Mapping[str, DataFrame], region: str) -> dict[str, DataFrame]:
    """One region of all stored tables.

    Group and person tables keep the rows of that region's entities, group
    aggregates are filtered by region, aggregates of people stay whole.  The
    offered workshops know no region; they are left out and can be computed
    again from the sliced tables.
    """
    tables = {n: t for n, t in tables.items() if n != "og.agg.angebote"}
    og = {n: t for n, t in tables.items() if n.startswith("og.") and n != "og.data"}
    tn = {n: t for n, t in tables.items() if n.startswith(("tn.long.", "tn.wide."))}
    out = dict(tables)
    for form, rest, ids in (("og", og, GROUP_IDS), ("tn", tn, PERSON_IDS)):
        part = slice_region(tables[f"{form}.data"], rest, region, ids)
        out[f"{form}.data"] = part.pop("data")
        out.update(part)
    return out


def region_overview(group_totals: DataFrame, group_data: DataFrame, ages: DataFrame) -> DataFrame:
    """Groups with head counts, answers of their own form, and mean age."""
    answers = group_data.select(*_GROUP, "hat_probleme_tn_gewinnung", "hat_hauptamt", "auftritte")
    out = lookup(group_totals, answers, _GROUP, null_safe=True)
    return lookup(out, ages.select(*_GROUP, "avg_alter", "n"), _GROUP, null_safe=True)


def overview_in_one_pass(group_data: DataFrame, people_counts: DataFrame, k: int = MIN_CELL) -> DataFrame:
    """The rows of `region_overview`, from one pass over each form.

    People are counted by group and region first.  These counts and the submissions of
    groups meet in one window for each edition and group, a few rows, which tells whether the group has a
    submission of its own and gives the mean age of its people.
    """
    answers = ["hat_probleme_tn_gewinnung", "hat_hauptamt", "auftritte"]
    where = [*_GROUP, "region_grouped", "og_region"]
    rows = union_all([
        group_data.select(*where, *HEADCOUNTS, *answers, F.lit(True).alias("_own")), people_counts.withColumn("_own", F.lit(False)),
    ])
    group = Window.partitionBy(*_GROUP)
    people = F.sum(F.when(~F.col("_own"), F.col("anzahl_insg"))).over(group)
    known = rows.withColumns({
        "_has": F.max("_own").over(group), "n": people, "_sum": F.sum("_age_sum").over(group), "_known": F.sum("_age_known").over(group),
    }).filter(F.col("_own") | ~F.col("_has"))
    named = F.col("og_name").isNotNull()
    mean = F.bround(F.try_divide(F.col("_sum"), F.col("_known")))
    known = known.withColumns({"avg_alter": F.when(named & (F.col("n") >= k), mean), "n": F.when(named, F.col("n"))})
    labels = {c: F.when(F.col("_own"), F.col(c)).otherwise(no_answer(c)) for c in ("region_grouped", "og_name")}
    # an estimate without an answer can now share a label with a real one
    same = [*where, "_own"]
    rest = [F.max(c).alias(c) for c in [*answers, "avg_alter", "n"]]
    return known.withColumns(labels).groupBy(*same).agg(*[F.sum(c).alias(c) for c in HEADCOUNTS], *rest).drop("_own")


# Levels of the region report: the columns each is grouped by.
LEVELS = {
    "edition": ["year"], "region": ["year", "region_grouped"], "subregion": ["year", "region_grouped", "og_region"], "all": [],
}


def overview_levels(overview: DataFrame, levels: Mapping[str, Sequence[str]] = LEVELS) -> DataFrame:
    """Nation, editions, regions and sub-regions from one aggregate, told apart by `level`.

    Groups are numbered in each edition, so a group counts once for each edition of a level.
    """
    entity = F.when(F.col("og_name").isNotNull(), F.struct("year", "og_name"))
    rows = numbered(overview.withColumn("_entity", entity), "_entity")
    state = states(
        rows, ["year", "region_grouped", "og_region"], [*HEADCOUNTS, "auftritte"], {"avg_alter": ("avg_alter", "n")},
        {"hat_hauptamt": F.col("hat_hauptamt") == "Ja"},
    )
    out = merged(state, levels)
    return out.select(
        "level", *LEVELS["subregion"], entities().alias("n_og"), count_of("hat_hauptamt").alias("hat_hauptamt"),
        *[known_total(c).alias(c) for c in [*HEADCOUNTS, "auftritte"]], F.bround(mean_of("avg_alter")).alias("avg_alter"),
    )


def overview_footer(overview: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """Number of groups, sums, yes counts and the mean age weighted by group size."""
    return overview.groupBy(*by).agg(
        n_distinct("og_name").alias("n_og"),
        F.count_if(F.col("hat_hauptamt") == "Ja").alias("hat_hauptamt"),
        *[sum_or_zero(c).alias(c) for c in [*HEADCOUNTS, "auftritte"]],
        F.bround(weighted_mean("avg_alter", "n")).alias("avg_alter"),
    )


def subregion_table(overview: DataFrame) -> DataFrame:
    """Sub-regions with number of groups, sums and weighted mean age."""
    agg = overview.groupBy("year", "og_region").agg(
        n_distinct("og_name").alias("n_og"),
        *[sum_or_zero(c).alias(c) for c in [*HEADCOUNTS, "auftritte"]],
        weighted_mean("avg_alter", "n").alias("avg_alter"),
    )
    return sorted_nulls_last(agg, ["year", "og_region"])


def offered_workshops(
    group_workshops: DataFrame, people_workshops: DataFrame, group_data: DataFrame, people: DataFrame
) -> DataFrame:
    """Distinct (group, workshop) pairs named by either form; the group may be unknown."""
    by_group = natural_join(
        group_workshops.withColumnRenamed("angebote_vor_ort", "angebot"), group_data.select(*GROUP_IDS, "og_name")
    )
    by_person = natural_join(
        people_workshops.select(*PERSON_IDS, "angebot"), people.select(*PERSON_IDS, "og_name")
    )
    pairs = by_group.select(*_GROUP, "angebot").unionByName(by_person.select(*_GROUP, "angebot"))
    return pairs.distinct()


def workshop_matrix(pairs: DataFrame, levels: Sequence[str]) -> DataFrame:
    """One 0/1 column per workshop, the same columns in every edition."""
    return presence_matrix(pairs.filter(F.col("og_name").isNotNull()), _GROUP, "angebot", levels)


def workshop_presence(pairs: DataFrame, group_totals: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Every group against every workshop of the form that somebody named, marked present or not, with the region."""
    cells = matrix_long(workshop_matrix(pairs, levels), _GROUP, levels, "angebot")
    marked = cells.filter(F.array_contains(named_levels(pairs, "angebot", levels), F.col("angebot")))
    regions = group_totals.select(*_GROUP, "og_region").distinct()
    return lookup(marked, regions, _GROUP, null_safe=True)


def workshop_shares(
    people_workshops: DataFrame,
    people: DataFrame,
    levels: Sequence[str],
    region: str = "og_region",
) -> DataFrame:
    """Participants of each workshop of the form that somebody named, as share of all people of the region."""
    where = people.select(*PERSON_IDS, region)
    placed = people_workshops.join(where, list(PERSON_IDS), "left").filter(F.col(region).isNotNull())
    once = placed.select(*PERSON_IDS, region, "angebot").distinct()
    by = ["year", region]
    people_n = counts(people.filter(F.col(region).isNotNull()), by, "n_tn_region")
    named = named_levels(people_workshops, "angebot", levels)
    n = complete(counts(once, [*by, "angebot"]), by, "angebot", named, groups=people_n, counted_only=True)
    return n.join(people_n, by, "left").withColumn("percent", F.try_divide(F.col("n"), F.col("n_tn_region")))


def workshop_shares_overall(
    people_workshops: DataFrame, people: DataFrame, levels: Sequence[str]
) -> DataFrame:
    """Same without regions: ticks over all people of the edition."""
    ticks = counts(people_workshops.filter(F.col("angebot").isNotNull()), ["year", "angebot"])
    total = counts(people, "year", "n_tn")
    n = complete(ticks, ["year"], "angebot", levels, groups=total)
    return n.join(total, "year").withColumn("percent", F.col("n") / F.col("n_tn"))


def option_share(long: DataFrame, column: str, option: str) -> DataFrame:
    """People who ticked one option among those who answered, rounded share."""
    person = long.groupBy(*PERSON_IDS).agg(F.bool_or(F.col(column) == option).alias("_ticked"))
    out = person.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_gesamt"), F.count_if("_ticked").alias("n_option")
    )
    return out.withColumn("anteil", F.bround(F.col("n_option") / F.col("n_gesamt"), 2))


def _listed(choices: DataFrame, column: str) -> list[str]:
    """Levels of a form's table, on the driver."""
    return [r[column] for r in form_scale(choices.select(column))]


def access_shares(
    access: DataFrame,
    people: DataFrame,
    choices: DataFrame,
    region: str | None = None,
) -> DataFrame:
    """Access routes of the form that somebody named, as share of people, per edition or per region.

    `choices` holds the routes of the form: zugangsweg, label_short, label_manual.
    """
    shown = named_levels(access, "zugangsweg", _listed(choices, "zugangsweg"))
    by = ["year"] + ([region] if region else [])
    if region:
        where = people.select(*PERSON_IDS, region)
        named = access.join(where, list(PERSON_IDS), "left").filter(F.col(region).isNotNull())
        n = counts(named, [*by, "zugangsweg"])
        total = counts(people.filter(F.col(region).isNotNull()), by, "total_n")
        n = complete(n, by, "zugangsweg", shown, groups=total, counted_only=True)
        out = lookup(n, choices, "zugangsweg")
        return out.join(total, by, "left").withColumn("prop", F.try_divide(F.col("n"), F.col("total_n")))
    total = counts(people, by, "total_n")
    n = counts(access.filter(F.col("zugangsweg").isNotNull()), [*by, "zugangsweg"])
    n = complete(n, by, "zugangsweg", shown, groups=total)
    out = n.join(choices, "zugangsweg").join(total, by)
    return out.withColumn("prop", F.try_divide(F.col("n"), F.col("total_n")))


def measure_counts(measures: DataFrame, choices: DataFrame) -> DataFrame:
    """How often each recruiting measure was rated, unused ones with 0.

    `choices` holds the measures of the form: massnahme, label_short.
    """
    rated = measures.filter(F.col("massnahme") != "Insgesamt")
    n = counts(rated, ["year", "massnahme"])
    listed = complete(n, ["year"], "massnahme", _listed(choices, "massnahme"), groups=measures)
    return listed.join(choices, "massnahme")


def measure_success(measures: DataFrame, choices: DataFrame, ratings: DataFrame) -> DataFrame:
    """Grid of measure and rating with shares per measure.

    `ratings` holds the rating scale of the form: erfolg, erfolg_label.
    """
    n = measure_counts(measures, choices).filter(F.col("massnahme") != "Insgesamt")
    rated = measures.filter(F.col("massnahme") != "Insgesamt")
    n_erf = counts(rated, ["year", "massnahme", "erfolg"], "n_erf")
    rows = with_rows(n, form_scale(ratings))
    out = lookup(rows, n_erf, ["year", "massnahme", "erfolg"]).fillna(0, ["n_erf"])
    return out.withColumn("perc", F.when(F.col("n") > 0, F.col("n_erf") / F.col("n")))


def problem_percent(group_data: DataFrame, choices: Sequence[str], years: Sequence[int]) -> DataFrame:
    """Recruiting problems in percent of groups, editions side by side."""
    return percent_by_year(group_data, "hat_probleme_tn_gewinnung", choices, years)


def problems_by_subregion(group_data: DataFrame, group_totals: DataFrame) -> DataFrame:
    """Recruiting problems per sub-region as share of its groups."""
    names = group_totals.select(*_GROUP, "og_region").distinct()
    rows = suffixed_join(
        group_data.filter(F.col("hat_probleme_tn_gewinnung").isNotNull()), names, _GROUP
    ).filter(F.col("og_region").isNotNull())
    n = counts(rows, ["year", "og_region", "hat_probleme_tn_gewinnung"])
    return share_of_group(n, ["year", "og_region"], "n", "perc", closed=True)


def need_table(needs: DataFrame, ranks: DataFrame) -> DataFrame:
    """Median, mean and spread of each need, with verbal bands."""
    order = ranks.select(F.col("label").alias("bedarf_value"), F.col("rank").alias("order"))
    return need_bands(item_stats(lookup(needs, order, "bedarf_value"), ["year", "bedarf"], "order", closed=True))
