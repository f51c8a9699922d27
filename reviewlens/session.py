"""Session settings the jobs are written for. All are standard Spark options."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution merges small shuffle partitions, splits skewed join partitions and swaps in
# broadcasts by measured size; runtime filters drop fact rows before a shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Builder with the settings. On a cluster also set ``spark.checkpoint.dir`` to a folder all
    executors share and ``spark.sql.shuffle.partitions`` to two or three times the cores."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
