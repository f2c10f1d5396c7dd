"""Both forms together: head counts of all groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.missing import no_answer
from ..operators.aggregate import headcounts_from_people
from ..operators.joins import drop_known
from ..operators.sets import union_all

HEADCOUNTS = ["anzahl_insg", "anzahl_tn", "anzahl_ma_leitung"]


def estimated_groups(group_data: DataFrame, people: DataFrame, with_region: bool = True) -> DataFrame:
    """Head counts of groups known only from people's answers.

    People are counted per group first; only these counts meet the anti join
    that removes groups with a submission of their own.
    """
    by = ["year", "region_grouped", "og_name"] + (["og_region"] if with_region else [])
    per_group = headcounts_from_people(people, by)
    unknown = drop_known(per_group, group_data, ["year", "og_name"])
    filled = unknown.withColumns(
        {"region_grouped": no_answer("region_grouped"), "og_name": no_answer("og_name")}
    )
    # a real answer and a missing one can now share a label
    return filled.groupBy(*by).agg(*[F.sum(c).alias(c) for c in HEADCOUNTS])


def combined_totals(group_data: DataFrame, people: DataFrame) -> DataFrame:
    """Reported head counts, and estimates for groups without a submission."""
    reported = group_data.select("year", "region_grouped", "og_region", "og_name", *HEADCOUNTS)
    return union_all([reported, estimated_groups(group_data, people)])
