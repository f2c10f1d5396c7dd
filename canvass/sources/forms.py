"""Form definitions: landed JSON of a form, and the published metadata files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import read_table

def _struct(texts: Sequence[str]) -> T.StructType:
    fields = [T.StructField(t, T.StringType()) for t in texts]
    return T.StructType([*fields, T.StructField("label", T.ArrayType(T.StringType()))])


_QUESTION = _struct([
    "name", "type", "$kuid", "$xpath", "$autoname", "$qpath", "required",
    "select_from_list_name", "relevant", "kobo--matrix_list",
])
_CHOICE = _struct(["name", "$kuid", "list_name"])
FORM_SCHEMA = T.StructType([
    T.StructField("content", T.StructType([
        T.StructField("survey", T.ArrayType(_QUESTION)),
        T.StructField("choices", T.ArrayType(_CHOICE)),
    ])),
])

# canonical names of the metadata columns used by the catalog
_NAMES = {
    "$kuid": "kuid",
    "$xpath": "col_name",
    "$autoname": "autoname",
    "$qpath": "qpath",
    "select_from_list_name": "list_name",
    "kobo--matrix_list": "matrix_list",
}


def flat_label(label: str | Column) -> Column:
    """The only label of a question; NULL without one, an error with several."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(
        F.size(c) > 1, F.raise_error(F.lit("more than one label per question"))
    ).otherwise(F.get(c, 0)).cast("string")


def form_rows(form: DataFrame) -> DataFrame:
    """Question rows in form order (`ord`), canonical column names, flat labels."""
    rows = form.select(F.posexplode("content.survey").alias("ord", "_q")).select("ord", "_q.*")
    return rows.withColumn("label", flat_label("label")).withColumnsRenamed(_NAMES)


def choice_rows(form: DataFrame) -> DataFrame:
    """Choice rows in form order (`ord`)."""
    rows = form.select(F.posexplode("content.choices").alias("ord", "_c")).select("ord", "_c.*")
    return rows.withColumn("label", flat_label("label")).withColumnsRenamed(_NAMES)


def read_form(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Questions and choices of a form definition that was landed as JSON."""
    form = spark.read.schema(FORM_SCHEMA).json(path, multiLine=True)
    return form_rows(form), choice_rows(form)


def write_form_csv(rows: DataFrame, path: str) -> None:
    """Metadata CSV; `ord` keeps the questionnaire order across part files."""
    rows.write.mode("overwrite").option("escape", '"').csv(path, header=True, nullValue="NA")


def read_form_csv(spark: SparkSession, path: str) -> DataFrame:
    """Metadata CSV, written above or kept from earlier years.

    A file without `ord` is taken in its own row order: a multi-line CSV file is
    never split, so the running id follows the lines.
    """
    rows = read_table(spark, path).withColumnsRenamed(_NAMES)
    if "ord" in rows.columns:
        return rows.withColumn("ord", F.col("ord").cast("int"))
    return rows.withColumn("ord", F.monotonically_increasing_id().cast("int"))


def question_json(rows: DataFrame, name: str = "question", entries: Sequence[str] = ()) -> DataFrame:
    """One JSON object per question, missing entries as explicit null.

    It holds all columns but `ord`, which then is all that stays beside it, or the
    given entries, and then all columns stay.
    """
    held = entries or [c for c in rows.columns if c != "ord"]
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in held]), {"ignoreNullFields": "false"})
    return rows.withColumn(name, text) if entries else rows.select("ord", text.alias(name))


def write_form_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def battery(catalog: DataFrame, choices: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Questions of an item battery and the choice lists they use."""
    items = catalog.filter(F.col("q_key") == key)
    return items, choices.join(items.select("list_name"), "list_name", "left_semi")


def statements(catalog: DataFrame, choices: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Statements sorted by name, and the choice list of the first one."""
    items = catalog.filter(F.col("q_key") == key).orderBy("name")
    first = catalog.filter(F.col("q_key") == key).agg(F.min_by("list_name", "ord").alias("list_name"))
    return items, choices.join(first, "list_name", "left_semi")


def answer_schema(columns: Sequence[str]) -> T.StructType:
    """Submissions arrive as text: id, end time, and one string per question."""
    fields = [T.StructField("_id", T.LongType()), T.StructField("end", T.TimestampType())]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in columns])
