"""Row functions over Arrow batches, the folder that executors share, and small tables."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

T = TypeVar("T")

# Rows whose results are held at a time.
SLICE = 512

# A row function gets the values of the asked columns and returns the new values; a slice
# function gets a list for each asked column and returns the new values of each row.
RowFunction = Callable[..., tuple]
SliceFunction = Callable[..., list[tuple]]


# The table that a Python worker keeps between tasks, by kind and key.
HELD: dict[tuple[str, Hashable], object] = {}


def held(kind: str, key: Hashable, make: Callable[[], T]) -> T:
    """The worker's table of a kind and key.  Workers outlive stages, so asking for one releases the one before."""
    if (kind, key) not in HELD:
        release()
        HELD[kind, key] = make()
    return HELD[kind, key]


def release() -> None:
    """Drop the worker's table; for tasks that need none, as the worker may have one of a stage before."""
    if HELD:
        HELD.clear()
        give_back()


def give_back() -> None:
    """Return freed memory to the system, for the other processes of the executor; a worker waits with it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Recent:
    """Values by key for the slices of a worker; those not asked for lately are forgotten.

    `young` holds what the running slice needs.  At half of `limit` bytes it
    becomes `old`, from which asked keys come back, so a long key or many of
    them cost what they take and no more is held than `limit` and one slice.
    """

    def __init__(self, limit: int, size: Callable[[str, object], int], sizes: Callable[[dict], int] | None = None) -> None:
        self.limit, self.size = limit, size
        self.sizes = sizes or (lambda new: sum(size(k, v) for k, v in new.items()))
        self.young: dict = {}
        self.old: dict = {}
        self.taken = 0

    def absent(self, keys: Callable[[dict], set]) -> list:
        """Keys that are not known at all; `keys` tells those that are not among the given ones."""
        if self.taken > self.limit // 2:
            self.old, self.young, self.taken = self.young, {}, 0
        new, again = [], {}
        for key in keys(self.young):
            value = self.old.get(key)
            if value is None:
                new.append(key)
            else:
                again[key] = value
        self.put_all(again)
        return new

    def put(self, key: str, value: object) -> None:
        self.young[key] = value
        self.taken += self.size(key, value)

    def put_all(self, new: dict) -> None:
        self.young.update(new)
        self.taken += self.sizes(new)


def by_row(make: Callable[[], RowFunction]) -> Callable[[], SliceFunction]:
    def make_slice() -> SliceFunction:
        row = make()
        return lambda *columns: [row(*values) for values in zip(*columns)]

    return make_slice


def add_columns(
    df: DataFrame, inputs: list[str], fields: list[StructField], make: Callable[[], SliceFunction]
) -> DataFrame:
    """`df` with new columns; `make` builds the slice function once in each task.

    A task holds one Arrow batch of texts, and values and results of a slice of it.  A new
    column replaces one of the same name.
    """
    hidden = [f"__in_{i}" for i in range(len(inputs))]
    clashing = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in clashing]
    source = df.select(*[df[f"`{c}`"] for c in kept], *[df[f"`{c}`"].alias(h) for c, h in zip(inputs, hidden)])
    schema = StructType([*source.select(*[f"`{c}`" for c in kept]).schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in fields]
        function = make()
        for part in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            out = function(*[c.to_pylist() for c in part.columns[len(kept) :]])
            made = [pa.array([o[k] for o in out], type=kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *made], names=schema.names)
        give_back()

    return source.mapInArrow(run, schema)


def prepare_checkpoints(spark: SparkSession) -> None:
    """Name the folder of spark.checkpoint.dir to Spark, which all executors share.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = os.path.join(tempfile.mkdtemp(prefix="run-"), "checkpoints")
    context.setCheckpointDir(folder)


def stored(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read again, which cuts its lineage and tells Spark its size."""
    spark = df.sparkSession
    prepare_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int, limit: int = 8 << 20) -> DataFrame:
    """`df` marked for a broadcast if its rows, counted now, take `limit` bytes at most; else as it is, to be shuffled."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df
