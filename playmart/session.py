"""A session with the settings the library is meant to run with.

Results do not depend on them, and a session passed to the library is left as it is.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Parquet is compressed, so the size check before a broadcast multiplies file
# sizes by an expansion factor: without it a fact of a few compressed MB passes for a small table. Skewed
# join partitions are split even when that costs one more shuffle
# downstream: a single popular song or user may own a large share of all plays.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A table in one file is still read by several tasks where its row groups allow it.
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "playmart", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in (RUNTIME_SETTINGS | extra).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
