"""Session settings the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Partition counts are left to the cluster: set spark.sql.shuffle.partitions high enough that a
# shuffle partition stays near 128 MB before coalescing (about 50,000 for 6 TB of shuffled
# columns); adaptive execution merges what is too small and splits what is too large.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot foreign key is split even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Spark compares file sizes with the broadcast threshold; compressed columns grow in memory.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def build_session(name: str, **settings: str) -> SparkSession:
    """Session with the given settings, and the ones above unless the submitter chose others."""
    builder = SparkSession.builder.appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    chosen = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark
