"""Cleaning of the group form: one submission per local group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import empty_to_null, quoted, to_double, to_int
from ..functions.text import weekday_name
from ..operators.catalog import (
    Catalog,
    Choices,
    Question,
    form_scale,
    load_catalog,
    load_choices,
    matrix_cell_list,
    matrix_columns,
    matrix_headers,
    rule_option,
)
from ..operators.clean import (
    add_missing_columns,
    before_deadline,
    drop_empty_rows,
    drop_system_columns,
)
from ..operators.joins import harmonize, keep_ids, map_region, recode, recode_all
from ..operators.reshape import labelled_long, matrix_cells, multiselect_long
from ..operators.windows import dedup_first
from .lazy import LazyTables

GROUP_IDS = ("year", "og_id")

# Code of the open option, and the overall rating that has no code.
OTHER_MEASURE = "sonstige"
OVERALL = ("insgesamt", "Insgesamt")


@dataclass
class Form:
    """Everything a cleaning plan needs to know about one form."""

    catalog: Catalog
    choices: Choices
    matrix_headers: Mapping[str, Sequence[tuple[str, str]]]

    def mapping(self, key: str) -> dict[str, str]:
        return self.choices.mapping(self.catalog.list_name(key))

    def blocks(self) -> list[str]:
        """Names of the matrix blocks, which their cell columns carry."""
        return [
            r["name"] for rows in self.catalog.rows.values() for r in rows
            if r["type"] == "begin_kobomatrix"
        ]


def load_form(
    questions: DataFrame, choices: DataFrame, specs: Sequence[Question], max_rows: int | None = None
) -> Form:
    """Search one form's metadata for the questions, options and matrix headers of a plan.

    `max_rows` is the number of rows that questions and choices may have (20,000 if not told).
    """
    headers: dict[str, list[tuple[str, str]]] = {}
    for r in form_scale(matrix_headers(questions).orderBy("ord"), max_rows):
        headers.setdefault(r["matrix"], []).append((r["name"], r["label"]))
    return Form(load_catalog(questions, specs, max_rows), load_choices(choices, max_rows), headers)


def prepare_groups(submissions: DataFrame, form: Form) -> DataFrame:
    """Submissions in time, without system columns, with all questions of the form."""
    raw = before_deadline(submissions, "year").withColumnRenamed("_id", "og_id")
    return add_missing_columns(drop_system_columns(raw), form.catalog.answer_columns())


def weekdays(raw: DataFrame, form: Form) -> DataFrame:
    """Meeting days with their hours.

    Days and hours come from the same submission, so the hours are looked up in
    the row instead of joining two long tables.
    """
    cat = form.catalog
    days = cat.column("wochentag")
    hours: dict[str, str] = {}
    for path in cat.columns("wochentag_stunden"):
        day = path.rsplit("/", 1)[-1].lower().removesuffix("_stunden").capitalize()
        if day in hours:
            raise ValueError(f"two hours questions for {day}")
        hours[day] = path
    day = F.col("wochentag")
    stunden: Column = F.lit(None).cast("int")
    for name, path in hours.items():
        stunden = F.when(day == name, to_int(f"_h_{name}")).otherwise(stunden)
    wide = raw.select(
        *GROUP_IDS, quoted(days).alias("_days"),
        *[quoted(path).alias(f"_h_{name}") for name, path in hours.items()],
    )
    long = wide.withColumn("wochentag", F.explode(F.split("_days", " ")))
    return long.withColumn("wochentag", weekday_name("wochentag")).select(
        *GROUP_IDS, "wochentag", stunden.alias("stunden")
    )


def workshops(raw: DataFrame, form: Form) -> DataFrame:
    long = multiselect_long(raw, form.catalog.column("workshops"), GROUP_IDS, "angebote_vor_ort")
    return recode(long, form.mapping("workshops"), "angebote_vor_ort")


def matrix(raw: DataFrame, form: Form, key: str, option_name: str) -> DataFrame:
    """Matrix block: person type by answer option."""
    begin = form.catalog.one(key)
    cells = matrix_cell_list(
        matrix_columns(raw.columns, begin["name"]),
        form.matrix_headers[begin["kuid"]],
        form.choices.lists[begin["matrix_list"]],
    )
    return matrix_cells(raw, cells, GROUP_IDS, "person_type", option_name)


def measures(raw: DataFrame, form: Form) -> DataFrame:
    """Rated recruiting measures, with the free text of the open measure.

    Which measure a rating column belongs to is known from its skip rule; ticks
    and free text are read from the same row.
    """
    cat = form.catalog
    ticked, text = quoted(cat.column("gewinnung_massnahmen")), quoted(cat.column("gewinnung_massnahmen_sonst"))
    open_text = F.when(F.array_contains(F.split(ticked, " "), OTHER_MEASURE), text)
    rows = raw.withColumn("_open", open_text)
    labels = [
        (r["col_name"], {"massnahme": rule_option(r["relevant"], OVERALL[0])})
        for r in cat.all("gewinnung_erfolg")
    ]
    long = labelled_long(rows, labels, [*GROUP_IDS, "_open"], "_erfolg")
    mapping = form.mapping("gewinnung_massnahmen") | dict([OVERALL])
    named = long.select(
        *GROUP_IDS,
        to_int("_erfolg").alias("erfolg"),
        "massnahme",
        F.when(F.col("massnahme") == OTHER_MEASURE, F.col("_open")).alias("massnahme_sonst"),
    )
    return recode(named, mapping, "massnahme")


def needs(raw: DataFrame, form: Form) -> DataFrame:
    labels = [(r["col_name"], {"bedarf": r["label"]}) for r in form.catalog.all("bedarfe")]
    long = labelled_long(raw, labels, GROUP_IDS, "bedarf_value")
    return recode(long, form.mapping("bedarfe"), "bedarf_value")


def group_data(raw: DataFrame, form: Form, regions: DataFrame) -> DataFrame:
    """One row per submission.

    Where the form offers a list of names the code becomes og_name, otherwise
    the typed name is kept as og_name_orig for later harmonization.
    """
    cat = form.catalog
    names = form.mapping("name")
    name = quoted(cat.column("name"))
    data = raw.select(
        *GROUP_IDS,
        to_int(cat.column("auftritte")).alias("auftritte"),
        quoted(cat.column("hauptamt")).alias("hat_hauptamt"),
        to_double(cat.column("hauptamt_stunden")).alias("hauptamt_stunden"),
        to_int(cat.column("anzahl_ma")).alias("anzahl_ma_leitung"),
        to_int(cat.column("anzahl_tn")).alias("anzahl_tn"),
        quoted(cat.column("gewinnung_probleme")).alias("hat_probleme_tn_gewinnung"),
        quoted(cat.column("bedarfe_weitere")).alias("unterstuetzungsbedarfe_weitere"),
        quoted(cat.column("region")).alias("og_region"),
        name.alias("og_name") if names else empty_to_null(name).alias("og_name_orig"),
    )
    mappings = {
        "hat_hauptamt": form.mapping("hauptamt"),
        "hat_probleme_tn_gewinnung": form.mapping("gewinnung_probleme"),
        "og_region": form.mapping("region"),
    }
    if names:
        mappings["og_name"] = names
    data = map_region(recode_all(data, mappings), regions)
    return data.withColumn("anzahl_insg", F.col("anzahl_tn") + F.col("anzahl_ma_leitung"))


def clean_groups(submissions: DataFrame, form: Form, regions: DataFrame) -> LazyTables:
    """All tables of the group form, planned when they are asked for.

    Only the table with one row per submission has to look for empty forms,
    which means reading every column.  A long table holds answers only, so an
    empty form has no row there and each table scans just its own question.
    """
    raw = prepare_groups(submissions, form)
    return LazyTables({
        "og.data": lambda: group_data(drop_empty_rows(raw, GROUP_IDS), form, regions),
        "og.long.wochentage": lambda: weekdays(raw, form),
        "og.long.angebote_vor_ort": lambda: workshops(raw, form),
        "og.long.gender_by_participant_type": lambda: matrix(raw, form, "geschlecht_begin", "gender"),
        "og.long.alter_by_participant_type": lambda: matrix(raw, form, "alter_begin", "alter"),
        "og.long.tn_gewinnung_massnahmen": lambda: measures(raw, form),
        "og.long.unterstuetzungsbedarfe": lambda: needs(raw, form),
    })


def harmonize_groups(data: DataFrame, spelling: DataFrame, regions: DataFrame) -> DataFrame:
    """Typed group names to unified names and regions, for forms without a name list."""
    data = data.withColumnRenamed("og_region", "og_region_orig").drop("region_grouped")
    return map_region(harmonize(data, spelling, "og_name_orig"), regions)


def first_of_each_group(data: DataFrame, order_by: Sequence[str] = ("og_id",)) -> DataFrame:
    """First submission per group and edition; groups without a name are left out."""
    return dedup_first(data.filter(F.col("og_name").isNotNull()), ["year", "og_name"], order_by)


def first_submissions(
    tables: Mapping[str, DataFrame], order_by: Sequence[str] = ("og_id",)
) -> LazyTables:
    """Keep the first submission per group and edition, in all tables."""
    data = first_of_each_group(tables["og.data"], order_by)
    longs = [name for name in tables if name.startswith("og.long.")]
    return LazyTables(
        {"og.data": lambda: data}
        | {name: (lambda name=name: keep_ids(tables[name], data, GROUP_IDS)) for name in longs}
    )
