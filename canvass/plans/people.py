"""Cleaning of the person form: one submission per person."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.missing import (
    drop_above,
    empty_to_null,
    keep_below,
    null_to_empty,
    quoted,
    to_double,
    to_int,
)
from ..functions.text import plain_code, without_words
from ..operators.aggregate import group_mean_suppressed, headcounts_from_people, likert_summary
from ..operators.catalog import MAX_AGE
from ..operators.clean import (
    add_missing_columns,
    before_deadline,
    drop_system_columns,
    fill_region,
)
from ..operators.joins import harmonize, map_region, multiselect_with_other, recode, recode_all
from ..operators.privacy import delink
from ..operators.reshape import columns_long, labelled_long, multiselect_long, rename_block
from .groups import Form
from .lazy import LazyTables

PERSON_IDS = ("year", "tn_id")

# Codes of the open options, and weekly hours taken as a typing error.
OTHER = {
    "zugangsweg": "sonstiges",
    "angebote": "andere_workshops",
    "huerden": "andere_gr_nde",
    "hilfe": "sonstiges",
    "glaube_kontakt": "ja_andere",
}
MAX_HOURS = 40
# Region whose label differs between the two forms.
REGION_PATCH = {"owl": "Ostwestfalen-Lippe"}


def prepare_people(submissions: DataFrame, form: Form) -> DataFrame:
    raw = before_deadline(submissions, "year").withColumnRenamed("_id", "tn_id")
    raw = drop_system_columns(raw, prefixes=("_",), names=())
    return add_missing_columns(raw, form.catalog.answer_columns())


def words(raw: DataFrame, form: Form) -> DataFrame:
    long = columns_long(raw, form.catalog.columns("worte"), "wort", PERSON_IDS)
    return long.select(*PERSON_IDS, "wort")


def traits(raw: DataFrame, form: Form) -> DataFrame:
    labels = [
        (r["col_name"], {"eig": r["name"], "eig_label": r["label"]})
        for r in form.catalog.all("eigenschaften")
    ]
    return labelled_long(raw, labels, PERSON_IDS, "value")


def open_multiselect(raw: DataFrame, form: Form, key: str, text_key: str, option: str, text: str) -> DataFrame:
    """Multi-select with an open option; codes recoded to labels."""
    cat = form.catalog
    long = multiselect_with_other(
        raw, cat.column(key), cat.column(text_key), PERSON_IDS, option, text, OTHER[key]
    )
    if key == "angebote":
        long = long.withColumn(option, plain_code(option))
    return recode(long, form.mapping(key), option)


def closed_multiselect(raw: DataFrame, form: Form, key: str, option: str) -> DataFrame:
    long = multiselect_long(raw, form.catalog.column(key), PERSON_IDS, option)
    return recode(long, form.mapping(key), option)


def statements_wide(raw: DataFrame, form: Form) -> DataFrame:
    """Likert block; every path is renamed by its own question, not by position."""
    names = {r["col_name"]: r["name"] for r in sorted(form.catalog.all("aussagen"), key=lambda r: r["name"])}
    return rename_block(raw, names, PERSON_IDS)


def statements_long(wide: DataFrame) -> DataFrame:
    names = [c for c in wide.columns if c not in PERSON_IDS]
    return columns_long(wide, names, "value", PERSON_IDS, "aussage", keep_null=True)


def person_rows(
    raw: DataFrame, form: Form, spelling: DataFrame, regions: DataFrame, brand_words: Sequence[str]
) -> DataFrame:
    """One row per person with resolved group and region, and the age."""
    cat = form.catalog
    column = {
        "og_region_orig": "region",
        "teilnahme_og_uebergreifend": "veranst_regional",
        "teilnahme_dtlweit": "veranst_national",
        "verantwortung_janein": "verantwortung",
        "info_komplett": "info_komplett",
        "info_wege_aenderung": "info_aenderung",
    }
    people = raw.select(
        *PERSON_IDS,
        keep_below(to_double(cat.column("stunden")), MAX_HOURS).alias("stunden_pro_woche"),
        empty_to_null(cat.column("name")).alias("og_name_orig"),
        to_double(cat.column("empfehlung")).alias("wahrsch_empfehlung"),
        drop_above(to_int(cat.column("alter")), MAX_AGE).alias("alter"),
        *[quoted(cat.column(key)).alias(name) for name, key in column.items()],
    )
    mappings = {name: form.mapping(key) for name, key in column.items()}
    listed = mappings["og_region_orig"]
    mappings["og_region_orig"] = listed | {c: label for c, label in REGION_PATCH.items() if c in listed}
    people = recode_all(people, mappings).withColumn(
        "og_name_cleaned", without_words(null_to_empty("og_name_orig"), brand_words)
    )
    people = harmonize(people, spelling, "og_name_cleaned")
    people = people.withColumn("og_region", fill_region("og_name", "og_region", "og_region_orig"))
    return map_region(people, regions)


def counts_by_group(people: DataFrame) -> DataFrame:
    """Head counts and age sums of groups, as people told their group and region."""
    by = ["year", "region_grouped", "og_name", "og_region"]
    ages = [F.sum("alter").alias("_age_sum"), F.count("alter").alias("_age_known")]
    return headcounts_from_people(people, by, more=ages)


def age_by_group(people: DataFrame) -> DataFrame:
    """Mean age and size per group; withheld for groups under three people."""
    return group_mean_suppressed(people, ["year", "og_name"], "alter", "avg_alter")


def demographics(
    raw: DataFrame, form: Form, contact: Callable[[], DataFrame]
) -> dict[str, Callable[[], DataFrame]]:
    """Sensitive answers as single columns in random order, without ids."""
    cat = form.catalog

    def answers() -> DataFrame:
        told = raw.select(
            *PERSON_IDS,
            quoted(cat.column("gender")).alias("gender"),
            drop_above(to_int(cat.column("alter")), MAX_AGE).alias("alter"),
            quoted(cat.column("schule")).alias("schule"),
            quoted(cat.column("glaube_kontakt_sonst")).alias("kontakt_chrgl_sonst"),
        )
        return recode_all(told, {"gender": form.mapping("gender"), "schule": form.mapping("schule")})

    def released(column: str) -> DataFrame:
        return delink(answers(), column, PERSON_IDS, ["year"])

    def typed() -> DataFrame:
        known = answers().filter(F.col("kontakt_chrgl_sonst").isNotNull())
        return delink(known, "kontakt_chrgl_sonst", PERSON_IDS, ["year"])

    out = {f"tn.demo.{c}": (lambda c=c: released(c)) for c in ("gender", "alter", "schule")}
    out["tn.demo.kontakt_chrgl_sonst"] = typed
    out["tn.demo.kontakt_chrgl"] = lambda: delink(contact(), "kontaktpunkt", PERSON_IDS, ["year"])
    return out


def clean_people(
    submissions: DataFrame,
    form: Form,
    spelling: DataFrame,
    regions: DataFrame,
    brand_words: Sequence[str] = (),
) -> LazyTables:
    """All tables of the person form, planned when they are asked for."""
    raw = prepare_people(submissions, form)

    def persons() -> DataFrame:
        return person_rows(raw, form, spelling, regions, brand_words)

    def opened(key: str, option: str, text: str, text_key: str | None = None) -> Callable[[], DataFrame]:
        return lambda: open_multiselect(raw, form, key, text_key or f"{key}_sonst", option, text)

    contact = opened("glaube_kontakt", "kontaktpunkt", "kontakt_chrgl_sonst")
    tables: dict[str, Callable[[], DataFrame]] = {
        "tn.data": lambda: persons().drop("alter"),
        "tn.wide.aussagen": lambda: statements_wide(raw, form),
        "tn.agg.aussagen": lambda: likert_summary(statements_long(statements_wide(raw, form)), ["year", "aussage"]),
        "tn.agg.alter_by_og": lambda: age_by_group(persons()),
        "tn.agg.counts_by_og": lambda: counts_by_group(persons()),
        "tn.long.woerter": lambda: words(raw, form),
        "tn.long.eigenschaften": lambda: traits(raw, form),
        "tn.long.zugangsweg": opened("zugangsweg", "zugangsweg", "zugangsweg_sonst"),
        "tn.long.angebote_vor_ort": opened("angebote", "angebot", "angebot_sonst"),
        "tn.long.gruende_dagegen": opened("huerden", "grund", "andere_gruende", "huerden_andere"),
        "tn.long.hilfsangebote": opened("hilfe", "hilfsangebot", "hilfsangebot_sonst"),
        "tn.long.info_wege_aktuell": lambda: closed_multiselect(raw, form, "info_aktuell", "info_weg"),
        "tn.long.info_wege_wunsch": lambda: closed_multiselect(raw, form, "info_wunsch", "info_weg"),
        "tn.long.kontakt_chrgl": contact,
    }
    return LazyTables(tables | demographics(raw, form, contact))
