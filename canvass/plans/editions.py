"""Cleaned editions, as lazy plans or as stored tables.

Stored, cleaning is done once and written; fixes, combined totals and all
reports then start from files in a folder that the caller names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import keep_ids
from ..operators.sets import union_all
from ..sources.editions import read_table_of, write_table
from .combine import combined_totals
from .groups import GROUP_IDS, first_of_each_group, harmonize_groups
from .people import statements_long
from .regions import offered_workshops


def union_editions(parts: Sequence[Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """Cleaned tables of editions whose forms differ, as one set of tables.

    Editions with typed group names are harmonized before; columns only one
    edition has are NULL in the others.
    """
    names = dict.fromkeys(n for part in parts for n in part)
    return {n: union_all([part[n] for part in parts if n in part]) for n in names}


class Plans:
    """Tables of all editions by name, as lazy plans."""

    def __init__(
        self,
        groups: Mapping[str, DataFrame],
        people: Mapping[str, DataFrame],
        regions: DataFrame,
        spelling: DataFrame | None = None,
    ) -> None:
        """`spelling` is given when group names were typed in all editions."""
        self.groups, self.people = groups, people
        self.regions, self.spelling = regions, spelling
        self.known: dict[str, DataFrame] = {}

    def plan(self, name: str) -> DataFrame:
        if name == "og.data":
            data = self.groups["og.data"]
            if self.spelling is not None:
                data = harmonize_groups(data, self.spelling, self.regions)
            return first_of_each_group(data)
        if name in self.groups:
            return keep_ids(self.groups[name], self.table("og.data"), GROUP_IDS)
        if name == "og.agg.total_tn_by_og":
            return combined_totals(self.table("og.data"), self.table("tn.data"))
        if name == "og.agg.angebote":
            return offered_workshops(
                self.table("og.long.angebote_vor_ort"), self.table("tn.long.angebote_vor_ort"),
                self.table("og.data"), self.table("tn.data"),
            )
        if name == "tn.long.aussagen":
            return statements_long(self.table("tn.wide.aussagen"))
        return self.people[name]

    def names(self) -> list[str]:
        return [*self.groups, *self.people, "og.agg.total_tn_by_og", "og.agg.angebote"]

    def table(self, name: str) -> DataFrame:
        if name not in self.known:
            self.known[name] = self.made(name)
        return self.known[name]

    def made(self, name: str) -> DataFrame:
        return self.plan(name)


class Editions(Plans):
    """The same tables, each stored under a root at its first use, so that later steps start from files."""

    def __init__(self, spark: SparkSession, root: str, *tables, **more) -> None:
        super().__init__(*tables, **more)
        self.spark, self.root = spark, root

    def made(self, name: str) -> DataFrame:
        df = self.plan(name)
        if name == "tn.long.aussagen":  # another form of a stored table
            return df
        write_table(df, self.root, name)
        return read_table_of(self.spark, self.root, name, schema=df.schema)

    def build(self) -> None:
        for name in self.names():
            self.table(name)
