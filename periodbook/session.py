"""Session settings the reports are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Partition counts and memory depend on the cluster and are left to it.
SETTINGS = {
    # business zone; the reports themselves hold local wall clocks and do not depend on it
    "spark.sql.session.timeZone": "America/Los_Angeles",
    # run-time join choice, partition merging and splitting of hot join keys
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # joins with a few rows of a large table (coupon orders) filter the other side by a Bloom filter before its shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    # a report's partitions replace only themselves
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # plans here have thousands of expressions; do not record a call site for each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
