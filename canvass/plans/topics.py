"""Result tables about statements, traits and faith."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.missing import to_double
from ..operators.aggregate import (
    any_per_id,
    counts,
    distribution_within,
    frequency_table,
    share_at_least,
    word_frequency,
)
from ..operators.catalog import form_scale
from ..operators.joins import lookup
from ..operators.reshape import add_zero_rows, with_rows
from ..operators.windows import stacked_positions
from .people import PERSON_IDS

# Labels of the contact question.
CONTACT = "Kontakt"
NO_CONTACT = "Kein Kontakt"


def statement_distribution(statements: DataFrame, labels: DataFrame, choices: DataFrame) -> DataFrame:
    """Answers per statement as share of everybody asked in the edition.

    `labels` holds aussage and q_label, `choices` value and ch_label.
    """
    n = counts(statements.filter(F.col("value").isNotNull()), ["year", "aussage", "value"])
    asked = statements.groupBy("year").agg(F.count_distinct("tn_id").alias("n_personen"))
    out = lookup(lookup(n, labels, "aussage"), choices, "value")
    return out.join(asked, "year").withColumn("percent", F.col("n") / F.col("n_personen"))


def trait_distribution(traits: DataFrame, choices: DataFrame, pad: bool = True) -> DataFrame:
    """Answers per trait with all scale levels, as share of everybody who rated traits.

    `choices` holds eig, value and choice_label: the scale of each trait.
    """
    n = counts(traits, ["year", "eig", "value"])
    if pad:
        n = add_zero_rows(n, with_rows(traits.select("year").distinct(), form_scale(choices.select("eig", "value"))))
    people = traits.groupBy("year").agg(F.count_distinct("tn_id").alias("n_personen"))
    out = lookup(n, choices, ["eig", "value"]).join(people, "year")
    return out.withColumn("percent", F.col("n") / F.col("n_personen"))


def faith_contact(contact: DataFrame, yes: str = CONTACT, no: str = NO_CONTACT) -> DataFrame:
    """Per person: any contact outside the group; unknown answers are left out."""
    known = any_per_id(contact, PERSON_IDS, F.col("kontaktpunkt").startswith("Ja"), "_any")
    return known.select(
        *PERSON_IDS, F.when(F.col("_any"), yes).otherwise(no).alias("has_kontaktpunkt")
    )


def faith_contact_shares(contact: DataFrame) -> DataFrame:
    return stacked_positions(faith_contact(contact), "has_kontaktpunkt", ["year"])


def faith_rating(statements: DataFrame, contact: DataFrame, statement: str) -> DataFrame:
    """Answers to one statement of people whose contact is known."""
    rated = statements.filter(F.col("aussage") == statement)
    joined = rated.join(faith_contact(contact), list(PERSON_IDS), "left")
    return joined.filter(F.col("has_kontaktpunkt").isNotNull())


def faith_rating_table(rated: DataFrame) -> DataFrame:
    return frequency_table(rated, "value", ["year"])


def faith_rating_high(rated: DataFrame, limit: int = 4) -> DataFrame:
    return rated.groupBy("year").agg(
        share_at_least(to_double("value"), limit).alias("share_eher_yes")
    )


def faith_rating_by_contact(rated: DataFrame) -> DataFrame:
    known = rated.filter(F.col("value").isNotNull())
    return distribution_within(known, ["year", "has_kontaktpunkt"], "value")


def openness_by_contact(traits: DataFrame, contact: DataFrame, trait: str) -> DataFrame:
    rated = traits.filter(F.col("eig") == trait).join(faith_contact(contact), list(PERSON_IDS), "inner")
    return distribution_within(rated, ["year", "has_kontaktpunkt"], "value")


def word_cloud(words: DataFrame, above: int = 4, by: Sequence[str] = ("year",)) -> DataFrame:
    return word_frequency(words.withColumnRenamed("wort", "word"), "word", above, by)


def word_answerers(words: DataFrame) -> DataFrame:
    return words.groupBy("year").agg(F.count_distinct("tn_id").alias("n_personen"))
