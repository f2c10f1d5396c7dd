"""Landed survey submissions, and their raw export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.catalog import form_scale
from ..operators.clean import SYSTEM_NAMES, SYSTEM_PREFIXES, drop_system_columns
from ..operators.sets import union_all
from .forms import answer_schema


def found_columns(spark: SparkSession, path: str, fmt: str = "json", multi_line: bool = False) -> list[str]:
    """Column names of landed submissions.

    CSV and Parquet name them in headers or footers.  For JSON lines the keys are
    collected in one pass; a form has some hundred of them.
    """
    if fmt == "csv":
        return list(dict.fromkeys(c for names in csv_headers(spark, path, multi_line) for c in names))
    if fmt != "json":
        return spark.read.option("mergeSchema", True).format(fmt).load(path).columns
    keys = spark.read.text(path).select(F.explode(F.json_object_keys("value")).alias("key"))
    return sorted(r["key"] for r in form_scale(keys.distinct()))


def csv_headers(spark: SparkSession, path: str, multi_line: bool = False) -> dict[tuple[str, ...], list[str]]:
    """Files by header; one look at the first line of each file."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        names = spark.read.csv(file, header=True, escape='"', multiLine=multi_line).columns
        found.setdefault(tuple(names), []).append(file)
    return found


def read_csv_by_name(
    spark: SparkSession, path: str, multi_line: bool = False, partitioned: bool = False
) -> DataFrame | None:
    """CSV files with any order and choice of columns, as text; None if there is no file."""
    parts = []
    for names, files in csv_headers(spark, path, multi_line).items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        reader = spark.read.schema(schema).options(**{"basePath": path} if partitioned else {})
        parts.append(reader.csv(files, header=True, nullValue="NA", escape='"', multiLine=multi_line))
    return union_all(parts) if parts else None


def read_submissions(
    spark: SparkSession,
    path: str,
    year: int | None,
    columns: Sequence[str],
    fmt: str = "json",
    blocks: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """Submissions of one survey and edition; without a year the folder is partitioned by it.

    All answers come as text and by name: files may differ in columns, their
    order and, for Parquet, their types, and a question nobody answered is NULL.
    A broken JSON line is an error.  CSV answers may hold line breaks only with
    `multi_line`, which reads each file in one task.
    Matrix questions have one column per cell, named by the server after the
    block; with `blocks` these are looked up in the data.
    """
    wanted = list(columns)
    if blocks:
        found = found_columns(spark, path, fmt, multi_line)
        wanted += [c for c in found if c not in wanted and any(b in c for b in blocks)]
    schema = answer_schema(wanted)
    if year is None:
        schema = schema.add("year", "int")
    if fmt == "json":
        df = spark.read.schema(schema).json(path, mode="FAILFAST")
    else:
        if fmt == "csv":
            raw = read_csv_by_name(spark, path, multi_line, partitioned=year is None)
        else:
            raw = spark.read.option("mergeSchema", True).format(fmt).load(path)
        if raw is None:
            df = spark.createDataFrame([], schema)
        else:
            have = set(raw.columns)
            cells = {f.name: F.col(f"`{f.name}`") if f.name in have else F.lit(None) for f in schema.fields}
            df = raw.select(*[cells[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return df if year is None else df.withColumn("year", F.lit(year))


def write_raw_export(
    df: DataFrame,
    path: str,
    id_name: str,
    prefixes: Sequence[str] = SYSTEM_PREFIXES,
    names: Sequence[str] = SYSTEM_NAMES,
    fmt: str = "csv",
) -> None:
    """Submissions without system columns, kept for reference."""
    out = drop_system_columns(df.withColumnRenamed("_id", id_name), prefixes, names)
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("escape", '"').csv(path, header=True, nullValue="NA")
    else:
        writer.format(fmt).save(path)
