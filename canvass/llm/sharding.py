"""Sharding by extendible hashing: only buckets over the byte limit split on another bit.

A row's bucket is named by the first bits of the hash of its id.  Sums of bytes by prefix,
eight bits deeper in each round and only below buckets that are still too
large, give the directory; the shards are the shallowest prefixes within the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.llm.arrow import small, stored

# Bits of the hash, and bits decided in one round.
BITS, STEP = 60, 8


def hash_bits(id_col: str) -> Column:
    """First 60 bits of the MD5 of the id as text; a null id counts like an empty one."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def prefix(h: Column, depth: int) -> Column:
    """The first `depth` bits as a number."""
    return F.shiftright(h, BITS - depth)


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """Columns depth, prefix, bytes, rows, fits of all shards, from rows with columns h and bytes.

    A bucket over the limit is split unless all its rows have the same hash; then it stays whole and does not fit.
    """
    depth, waiting, found = 0, rows, None
    sums = [F.sum("bytes").alias("bytes"), F.count("*").alias("rows"), F.min("h").alias("least"), F.max("h").alias("most")]
    again = [F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("most").alias("most")]
    while True:
        deepest = min(depth + STEP, BITS)
        fine = waiting.groupBy(prefix(F.col("h"), deepest).alias("p")).agg(*sums)
        first = depth if depth == 0 else depth + 1
        level = F.explode(F.sequence(F.lit(first), F.lit(deepest)))
        levels = fine.withColumn("depth", level).withColumn("prefix", F.call_function("shiftright", F.col("p"), F.lit(deepest) - F.col("depth")))
        levels = stored(levels.groupBy("depth", "prefix").agg(*again))
        done = (F.col("bytes") <= limit) | (F.col("least") == F.col("most")) | (F.col("depth") == BITS)
        parents = levels.where(~done).select((F.col("depth") + 1).alias("d"), F.col("prefix").alias("parent"))
        ended = levels.where(done)
        above = F.call_function("shiftright", F.col("prefix"), F.lit(1))
        # buckets of the first level of a round have a parent that was too large in the round before
        split = ended.join(parents, (F.col("depth") == F.col("d")) & (above == F.col("parent")), "left_semi").unionByName(ended.where(F.col("depth") == first))
        split = split.select("depth", "prefix", "bytes", "rows", (F.col("bytes") <= limit).alias("fits"))
        found = split if found is None else found.unionByName(split)
        open_ = levels.where(~done & (F.col("depth") == deepest)).select(F.col("prefix").alias("open"))
        if open_.isEmpty():
            return stored(found)
        waiting = waiting.join(small(open_, 16), prefix(F.col("h"), deepest) == F.col("open"), "left_semi")
        depth = deepest


def shard_rows(df: DataFrame, limit: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with columns shard (bits as text), depth, shard_bytes, shard_rows and fits.

    Bytes are those of the text in UTF-8; null texts have none.  Rows with the same id stay
    together, also null ids; a shard that consists of one id alone may exceed the limit, and fits is false.
    An empty table gives no rows; columns named like a result are replaced.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    shards = directory(stored(df.select(hash_bits(id_col).alias("h"), size.alias("bytes"))), limit)
    least = shards.agg(F.min("depth")).first()[0] or 0
    reach = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(BITS) - F.col("depth"))
    bits = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0")))
    ranges = shards.select(
        F.call_function("shiftright", F.col("prefix"), F.col("depth") - least).alias("base"), (F.col("prefix") * reach).alias("begin"),
        ((F.col("prefix") + 1) * reach).alias("end"), bits.alias("shard"), "depth", F.col("bytes").alias("shard_bytes"),
        F.col("rows").alias("shard_rows"), "fits",
    )
    named = {"shard", "depth", "shard_bytes", "shard_rows", "fits"}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in named]
    rows = df.select(*kept, hash_bits(id_col).alias("__h")).withColumn("__base", prefix(F.col("__h"), least))
    inside = (F.col("__base") == F.col("base")) & (F.col("__h") >= F.col("begin")) & (F.col("__h") < F.col("end"))
    return rows.join(small(ranges, 96), inside).select(*kept, "shard", "depth", "shard_bytes", "shard_rows", "fits")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One file for each shard: a shard is never larger than a task holds."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
