"""Session settings for survey workloads."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that matter for plans of this library.  Adaptive execution sizes
# shuffles, switches small sides to broadcast after measuring them, and splits
# hot keys even where that costs one more shuffle.  Files count four times their
# stored size when Spark decides on a broadcast before it has measured anything.
SETTINGS = {
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "canvass", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; `extra` uses '__' for '.' in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
