"""Session settings the jobs are tuned for. Results do not depend on them."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Replanning at run time: broadcasts by measured size, splits skewed joins and large
    # months, merges small partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a shuffled partition, and with it a written file, aims at.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The JVM never compiles methods above 8000 bytes of code. A stage that generates a
    # larger one runs faster on the operators' own, split code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Bytes that a shuffled partition may hold before the engine joins small ones.
PARTITION_BYTES = 128 << 20


def configure(builder: SparkSession.Builder, input_bytes: int | None = None) -> SparkSession.Builder:
    """``input_bytes``, where given, sets the partitions that shuffles begin with: the engine
    joins small ones at run time but does not split large ones of a sort or an
    aggregation."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes:
        first = max(200, -(-input_bytes // PARTITION_BYTES))
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", first)
    return builder
