"""Missing-value rules used by last-version deduplication, and the audit stamp."""

from __future__ import annotations

import datetime as _dt
from functools import reduce
import operator
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (DateType, DoubleType, FloatType, StringType, TimestampNTZType,
                               TimestampType)

from gleaner.functions.casts import cast_text

# Texts that stand for a missing value after a frame was
# written as strings (pandas writes NaN/NaT/None that way).
MISSING_TEXTS = ("nan", "nat", "none", "")

AUDIT_COLUMN = "_loaded_at"
AUDIT_ZONE = "America/Los_Angeles"


def is_missing(c: Column, dtype) -> Column:
    if isinstance(dtype, StringType):
        return c.isNull() | F.lower(F.trim(c)).isin(*MISSING_TEXTS)
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def present_flag(c: Column, dtype) -> Column:
    """1 when the value is present, else 0."""
    return F.when(is_missing(c, dtype), F.lit(0)).otherwise(F.lit(1))


def epoch_seconds(c: Column, dtype) -> Column:
    """Seconds since epoch of a date/time value, NULL when missing or unparsable."""
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        ts = c.cast("timestamp") if isinstance(dtype, TimestampNTZType) else c
    elif isinstance(dtype, DateType):
        ts = c.cast("timestamp")
    else:
        ts = cast_text(c.cast("string"), "timestamp")
    return F.when(~is_missing(c, dtype), F.unix_seconds(ts))


def latest_of(df: DataFrame, columns: list[str]) -> Column:
    """Greatest epoch over the columns, NULLs skipped; a single column is itself."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    parts = [epoch_seconds(F.col(c), types[c]) for c in columns]
    return parts[0] if len(parts) == 1 else F.greatest(*parts)


def present_count(df: DataFrame, columns: list[str]) -> Column:
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return reduce(operator.add, [present_flag(F.col(c), types[c]) for c in columns])


def audit_stamp(now: _dt.datetime | None = None) -> Column:
    """One literal per run: ISO-8601 text of the load time in Pacific time."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return F.lit(now.astimezone(ZoneInfo(AUDIT_ZONE)).isoformat())
