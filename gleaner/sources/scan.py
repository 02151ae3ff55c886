"""Parquet scans whose per-row work is spread over the cluster.

Spark splits a Parquet file by row group, so a table stored as a few large
row groups is read by a few tasks, and every expression above the scan
(variant building, casts, text parsing) runs on those tasks alone.  ``spread``
hash-partitions such a scan by a key before that work.  The decision is
checked, not assumed: the scan is spread only when it has fewer splits than
the cluster has cores *and* enough bytes to fill more tasks.  On a cluster
reading many files the scan already has thousands of splits and nothing is
added; a small dimension table is never fanned out either.

The key must not be heavily skewed (a table's id column); without a key the
rows are dealt round-robin.  Filters and column pruning still reach the scan:
Catalyst pushes both through the repartition.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

# Parquet bytes one task should get before spreading pays for its shuffle
# (compressed: the rows above the scan are several times larger).
SPREAD_TARGET_BYTES = 256 << 10


def spread_width(spark: SparkSession, have: int, size_bytes: int,
                 target_bytes: int = SPREAD_TARGET_BYTES) -> int:
    """Partition count for a scan of ``have`` splits and ``size_bytes`` bytes
    (``have`` when no spreading is worth it)."""
    cores = spark.sparkContext.defaultParallelism
    want = min(cores, max(1, math.ceil(size_bytes / target_bytes)))
    return want if want > have else have


def spread(df: DataFrame, size_bytes: int, key: list[str] | None = None,
           target_bytes: int = SPREAD_TARGET_BYTES) -> DataFrame:
    """``df`` (a scan of ``size_bytes`` bytes) hash-partitioned by ``key`` over
    more tasks when it has fewer splits than cores; else ``df`` unchanged."""
    have = df.rdd.getNumPartitions()
    n = spread_width(df.sparkSession, have, size_bytes, target_bytes)
    if n <= have:
        return df
    return df.repartition(n, *key) if key else df.repartition(n)


def read_spread(spark: SparkSession, path: str, key: list[str] | None = None,
                target_bytes: int = SPREAD_TARGET_BYTES) -> DataFrame:
    """``spark.read.parquet(path)``, spread by ``key`` when its splits are few."""
    from gleaner.sinks.table import _FS

    df = spark.read.parquet(path)
    return spread(df, _FS(spark, path).size(path), key, target_bytes)
