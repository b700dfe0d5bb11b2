"""Session defaults the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Readings and observation dates are UTC throughout; AQE splits skewed joins and
# rebalanced writes, so both are part of the contract rather than a tuning choice.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles start in many parts, which AQE joins up to its advisory size: a large input has
    # more of them, not larger ones.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Quantile sketches of more groups than Spark's default 128 are still hashed, not sorted.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # Top-k per group keeps k rows in each task also for a large k.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    # Window state lives on disk beside the executor instead of in its heap.
    "spark.sql.streaming.stateStore.providerClass":
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "isobar", master: str | None = None, **overrides: str) -> SparkSession:
    """Create a session; ``overrides`` are Spark settings with ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in overrides.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin an existing session to UTC, as every event time in this package is, and to shuffles that grow in parts."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(_PARTS, None) is None:
        spark.conf.set(_PARTS, DEFAULTS[_PARTS])
    return spark
