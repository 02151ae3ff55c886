"""As-of join: each left row with the latest right row of the same key at or
before (strictly before, by default) its time.

A window over the whole key would put a hot key in one task.  Time is cut
into buckets instead:

1. left and right rows are unioned and ordered inside each (key, bucket);
   a running ``last`` gives the match found in the row's own bucket;
2. each (key, bucket) with right rows is summarized by its last right row;
3. the carry of a bucket is the last summary of an earlier bucket, a window
   over the summaries only (one row per key and bucket, not per event);
4. a left row takes its in-bucket match, else its bucket's carry.

Work per task is bounded by the rows of one (key, bucket).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

_K = "__asof_kind"
_B = "__asof_bucket"
_T = "__asof_t"
_R = "__asof_right"


def asof_join(left: DataFrame, right: DataFrame, by: list[str] | str, left_on: str, right_on: str,
              right_cols: list[str], bucket_seconds: float = 86400.0, strict: bool = True,
              tie_break: list[str] | None = None, numeric: bool = False) -> DataFrame:
    """``left`` plus ``right_cols`` of the matching right row (NULL if none).

    ``numeric=True`` treats the time columns as numbers and ``bucket_seconds``
    as a bucket width in the same unit.  Ties on the right time are broken by
    ``tie_break`` (largest wins), then the right time itself."""
    by = [by] if isinstance(by, str) else list(by)
    tie_break = list(tie_break or [])

    def bucket_of(c):
        if numeric:
            return F.floor(F.col(c) / F.lit(bucket_seconds)).cast("bigint")
        return F.floor(F.unix_micros(F.col(c).cast("timestamp")) / F.lit(bucket_seconds * 1e6)).cast("bigint")

    # Left rows sort before right rows at equal time when the match must be strictly earlier.
    left_kind, right_kind = (0, 1) if strict else (1, 0)
    for k in by:  # NULL never equals anything
        right = right.filter(F.col(k).isNotNull())
    right_struct = F.struct(*[F.col(c) for c in right_cols], F.col(right_on).alias(_T))
    r = right.select(*[F.col(k) for k in by], bucket_of(right_on).alias(_B), F.col(right_on).alias(_T),
                     F.lit(right_kind).alias(_K), *[F.col(c).alias(f"__tb{i}") for i, c in enumerate(tie_break)],
                     right_struct.alias(_R))
    l_cols = left.columns
    lft = left.select(*[F.col(k) for k in by], bucket_of(left_on).alias(_B), F.col(left_on).alias(_T),
                      F.lit(left_kind).alias(_K),
                      *[F.lit(None).cast(right.schema[c].dataType).alias(f"__tb{i}") for i, c in enumerate(tie_break)],
                      F.lit(None).cast(r.schema[_R].dataType).alias(_R),
                      F.struct(*[F.col(c) for c in l_cols]).alias("__left"))
    u = r.withColumn("__left", F.lit(None).cast(lft.schema["__left"].dataType)).unionByName(lft)

    order = [F.col(_T), F.col(_K), *[F.col(f"__tb{i}").asc_nulls_first() for i in range(len(tie_break))]]
    w = Window.partitionBy(*by, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_bucket = (u.withColumn("__match", F.last(_R, ignorenulls=True).over(w))
                 .filter(F.col(_K) == left_kind)
                 .select(*by, _B, "__left", "__match"))

    last_in_bucket = r.groupBy(*by, _B).agg(
        F.max_by(_R, F.struct(F.col(_T), *[F.col(f"__tb{i}") for i in range(len(tie_break))])).alias("__sum"))
    wanted = lft.select(*by, _B).distinct().withColumn("__sum", F.lit(None).cast(last_in_bucket.schema["__sum"].dataType))
    marks = last_in_bucket.withColumn("__m", F.lit(1)).unionByName(wanted.withColumn("__m", F.lit(0)))
    wb = Window.partitionBy(*by).orderBy(F.col(_B), F.col("__m")).rowsBetween(Window.unboundedPreceding,
                                                                              Window.currentRow)
    carry = (marks.withColumn("__carry", F.last("__sum", ignorenulls=True).over(wb))
             .filter(F.col("__m") == 0).select(*by, _B, "__carry"))

    joined = in_bucket.join(carry, [*by, _B], "left")
    match = F.coalesce(F.col("__match"), F.col("__carry"))
    return joined.select(*[F.col("__left")[c].alias(c) for c in l_cols],
                         *[match[c].alias(c) for c in right_cols])
