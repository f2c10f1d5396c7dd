"""Yearly editions as Parquet tables partitioned by year."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, root: str, name: str, rebalance: bool = True) -> None:
    """Replace the editions contained in df, keep all others.

    Rows are rebalanced by year first: every edition gets files of a useful
    size, and a large edition is split over many tasks.
    """
    out = df.hint("rebalance", "year") if rebalance else df
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(f"{root}/{name}")
    )


def save_bucketed(df: DataFrame, table: str, ids: Sequence[str], buckets: int) -> None:
    """Table bucketed and sorted by entity.

    Long tables saved with the same ids and bucket count join with the entity
    table without a shuffle.
    """
    df.write.mode("overwrite").bucketBy(buckets, *ids).sortBy(*ids).saveAsTable(table)


def write_edition(tables: Mapping[str, DataFrame], root: str) -> None:
    for name, df in tables.items():
        write_table(df, root, name)


def read_table_of(
    spark: SparkSession,
    root: str,
    name: str,
    years: Sequence[int] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One table; a year filter only touches that edition's files.

    With a schema no file is opened to infer it, and a table without rows reads
    as empty.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(f"{root}/{name}")
    return df if years is None else df.filter(F.col("year").isin(list(years)))


def load_edition(spark: SparkSession, root: str, names: Sequence[str], year: int) -> dict[str, DataFrame]:
    return {n: read_table_of(spark, root, n, [year]) for n in names}


def load_all(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: read_table_of(spark, root, n) for n in names}


def editions(df: DataFrame, year: str = "year") -> DataFrame:
    """Available editions in order."""
    return df.select(F.col(year).alias("year")).distinct().orderBy("year")


def edition_years(df: DataFrame, year: str = "year", limit: int = 10_000) -> list[int]:
    """Editions on the driver: one number per survey year; more than `limit` are an error."""
    rows = editions(df, year).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} editions: not a year column")
    return [r["year"] for r in rows if r["year"] is not None]


def current_or_previous(available: DataFrame, year: str = "year") -> Column:
    """Condition: the latest edition or the one before it, found while the query runs."""
    latest = available.agg(F.max("year")).scalar()
    return F.col(year).between(latest - 1, latest)


def current_and_previous(years: Sequence[int], wanted: int | str | None = None) -> tuple[int, int | None]:
    """Requested (default: latest) edition and the one a year before, if present."""
    if not years:
        raise ValueError("no editions found")
    listed = ", ".join(str(y) for y in sorted(years))
    if wanted is None or wanted == "":
        current = max(years)
    else:
        try:
            current = int(wanted)
        except ValueError:
            raise ValueError(f"{wanted!r} is not a valid year. Available: {listed}") from None
    if current not in years:
        raise ValueError(f"edition {current} is not available. Available: {listed}")
    return current, current - 1 if current - 1 in years else None
