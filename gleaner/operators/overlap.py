"""Join of intervals that overlap, without a nested loop.

``l.start <= r.end AND r.start <= l.end`` has no equality to hash or sort by,
so Spark compares all pairs.  Here time (or any number) is cut into buckets,
of a width per level that doubles from one level to the next: an interval's
own level is the first at which it touches two buckets at most, however long
it is.  Two intervals meet at the higher of their levels, so a row is copied
to its own level and to the higher ones that the other side has, to at most
two buckets each, and the join is an equi-join on (keys, level, bucket).  A
pair comes out of the first bucket that both are in, and so once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LEVELS = 48


def _level(start: Column, end: Column, width: float) -> Column:
    """First level whose bucket is no shorter than the interval."""
    units = (end - start) / F.lit(float(width))
    return F.when(units <= 1, 0).otherwise(F.least(F.lit(LEVELS), F.ceil(F.log2(units)))).cast("int")


def _present(df: DataFrame, level: Column) -> list[int]:
    """Levels that occur: at most LEVELS + 1 numbers."""
    return sorted(r[0] for r in df.select(level.alias("level")).distinct().collect() if r[0] is not None)


def overlap_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str],
                 width: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of rows whose closed intervals overlap (and whose ``keys``, columns
    of both sides, are equal): the left columns, then the right ones without
    the keys.  Spans are columns of numbers, dates or timestamps; a timestamp's
    unit is the second, a date's the day.  ``width`` is the length of a usual
    interval, which only shapes the work.  A row with a NULL bound, or one that ends
    before it starts, joins nothing.  Other columns must differ in name."""
    sides = []
    for df, span in ((left, left_span), (right, right_span)):
        a, b = (_number(df, c) for c in span)
        sides.append(df.withColumn("__a", a).withColumn("__b", b).where("__a <= __b")
                     .withColumn("__own", _level(F.col("__a"), F.col("__b"), width)))
    levels = [_present(df, F.col("__own")) for df in sides]
    dealt = []
    for k, df in enumerate(sides):
        other = F.filter(F.array(*[F.lit(v) for v in levels[1 - k]]).cast("array<int>"), lambda v: v > F.col("__own"))
        df = df.withColumn("__level", F.explode(F.array_prepend(other, F.col("__own"))))
        size = F.lit(float(width)) * F.pow(F.lit(2.0), F.col("__level"))
        first, last = (F.floor(F.col(c) / size).cast("bigint") for c in ("__a", "__b"))
        dealt.append(df.withColumn("__first", first).withColumn("__bucket", F.explode(F.sequence(first, last))))
    x, y = dealt[0], dealt[1].withColumnsRenamed({c: f"{c}r" for c in ("__a", "__b", "__own", "__first")})
    pairs = x.join(y, [*keys, "__level", "__bucket"]).where(
        (F.col("__level") == F.greatest("__own", "__ownr")) & (F.col("__bucket") == F.greatest("__first", "__firstr"))
        & (F.col("__a") <= F.col("__br")) & (F.col("__ar") <= F.col("__b")))
    return pairs.select(*left.columns, *[c for c in right.columns if c not in keys])


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    if kind == "date":
        return F.unix_date(name).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(name).cast("timestamp")) / 1e6
    return F.col(name).cast("double")
