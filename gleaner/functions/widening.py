"""Column types that changed between what is stored and what arrives.

Both sides are cast to the narrower of the types that hold them: integers by
size, then float and double, dates before timestamps, and text, which holds
everything, last.  Nothing is lost by a cast but digits of a bigint beyond 53
bits where the other side is a double (as any frame of floats has it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, MapType, NullType, ShortType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

# Orders of types, each of which holds those before it.
_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_NUMBERS = (*_WHOLE, FloatType, DoubleType)
_TIMES = (DateType, TimestampNTZType, TimestampType)


def common_type(a: DataType, b: DataType) -> DataType:
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    for order in (_NUMBERS, _TIMES):
        if isinstance(a, order) and isinstance(b, order):
            if isinstance(a, (LongType, IntegerType)) and isinstance(b, FloatType) or \
                    isinstance(b, (LongType, IntegerType)) and isinstance(a, FloatType):
                return DoubleType()
            return max(a, b, key=lambda t: order.index(type(t)))
    if isinstance(a, DecimalType) or isinstance(b, DecimalType):
        return _with_decimal(a, b)
    return StringType()


def _with_decimal(a: DataType, b: DataType) -> DataType:
    if isinstance(a, (FloatType, DoubleType)) or isinstance(b, (FloatType, DoubleType)):
        return DoubleType()
    digits = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
    sizes = [(t.precision, t.scale) if isinstance(t, DecimalType) else (digits.get(type(t)), 0) for t in (a, b)]
    if any(p is None for p, _ in sizes):
        return StringType()
    scale = max(s for _, s in sizes)
    whole = max(p - s for p, s in sizes)
    return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()


def widened(stored: StructType, new: StructType) -> StructType:
    """Stored columns, then those that only the new side has, with types that
    hold both sides.  Names are held against each other in any case."""
    have = {f.name.lower(): f for f in new.fields}
    out = [StructField(f.name, common_type(f.dataType, have[f.name.lower()].dataType) if f.name.lower() in have
                       else f.dataType) for f in stored.fields]
    known = {f.name.lower() for f in stored.fields}
    return StructType(out + [StructField(f.name, f.dataType) for f in new.fields if f.name.lower() not in known])


def _cast(c: Column, have: DataType, want: DataType) -> Column:
    if have == want:
        return c
    if isinstance(want, StringType) and isinstance(have, (StructType, ArrayType, MapType)):
        return F.to_json(c)
    return c.cast(want)


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly these columns; those it lacks are NULL."""
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in schema.fields:
        own = have.get(f.name.lower())
        if own is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(_cast(F.col("`" + own.name.replace("`", "``") + "`"), own.dataType, f.dataType).alias(f.name))
    return df.select(*out)
