"""CSV lookups with survey conventions for missing values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import unique_keys


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header; both NA and the empty string are missing."""
    return (
        spark.read.option("header", True)
        .option("nullValue", "NA")
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Region map: og_region, region_grouped, slug."""
    return unique_keys(read_table(spark, path), ["og_region"])


# Headers of the spelling map.
SPELLING_COLUMNS = {
    "Schreibweise in den Daten": "og_name_orig",
    "Vereinheitlicht": "og_name",
    "Landesverband": "og_region",
}


def read_spelling(
    spark: SparkSession, path: str, columns: Mapping[str, str] = SPELLING_COLUMNS
) -> DataFrame:
    """Spelling map: raw name to unified name and region; comment columns are left out."""
    raw = read_table(spark, path).withColumnsRenamed(dict(columns))
    return unique_keys(raw.select(*columns.values()), ["og_name_orig"])
