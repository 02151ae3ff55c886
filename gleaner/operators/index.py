"""Dense row numbers 0..n-1 in a global order, without a one-task window.

``row_number() OVER (ORDER BY c)`` has no partition key, so Spark moves every
row into one task.  Here the rows are range-sorted over the cluster instead;
``monotonically_increasing_id`` then holds each row's partition (high bits)
and its position inside that partition (low 33 bits).  One count per
partition gives running offsets: a table with as many rows as the sort has
partitions, which is the only thing broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.session import checkpointed

_LOW_BITS = 33  # monotonically_increasing_id keeps the in-partition position below bit 33


def dense_index(df: DataFrame, order: list[Column], name: str = "idx") -> DataFrame:
    """``df`` with ``name`` = 0-based position of each row under ``order``
    (ties in ``order`` get distinct, arbitrary positions)."""
    ids = df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id())
    # Range bounds of the sort are sampled: fix the ids once, then read twice.
    ids = checkpointed(ids).select(
        "*", F.shiftright("__mid", _LOW_BITS).alias("__part"),
        F.col("__mid").bitwiseAND((1 << _LOW_BITS) - 1).alias("__pos"))
    per_part = ids.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # a window over the per-partition counts only: as many rows as partitions
    offsets = per_part.select(
        "__part",
        (F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"))
    out = ids.join(F.broadcast(offsets), "__part", "left")
    return out.select(*df.columns, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__pos")).alias(name))
