"""Small constant tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_table(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """Rows known on the driver as a local relation.

    Going through Arrow gives Spark the real size of the table, so that joins
    with it are broadcast by the optimizer's own size check.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) or [() for _ in schema.fields]
    table = pa.table({f.name: pa.array(list(c)) for f, c in zip(schema.fields, columns)})
    return spark.createDataFrame(table, schema)
