"""Corpus pipeline: language, near duplicates, secrets, mixture, tokens."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from canvass.llm.arrow import prepare_checkpoints
from canvass.llm.jaccard import keep_one_of_each
from canvass.llm.language import reject_undetermined
from canvass.llm.mixing import mix_sources
from canvass.llm.pieces import piece_columns
from canvass.llm.secret_scan import redact_secrets

PIECES = public_tokenizers.path("piece_bpe_32k.model")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; texts without letters and undecided ones go."""
    with open(PIECES, "rb") as f:
        return reject_undetermined(docs, f.read())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by 0.8 of the 5-word shingles."""
    return keep_one_of_each(docs, size=5, part=80, whole=100)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind in brackets."""
    return redact_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents at least once, those of small sources up to twice."""
    return mix_sources(docs, repeats=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their ids, packed as little-endian unsigned 32-bit integers."""
    return piece_columns(docs, PIECES).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("tokens", tokens),
]

# learned models, components and encodings cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on `documents`; each result is written to the shared folder and read again."""
    prepare_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
