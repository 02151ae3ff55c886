"""Deduplication by key: first record wins, or the latest non-missing version."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from gleaner.functions.missing import latest_of, present_count

_RN = "__rn"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def dedup_first(df: DataFrame, key, order=("req_idx", "pos"), newest_request_first: bool = True) -> DataFrame:
    """One row per key: highest ``req_idx`` (later request wins), then lowest ``pos``.

    NULL keys form one group.  ``row_number() = 1`` lets Spark add a
    per-partition group limit before the shuffle, so a hot key sends at most
    one row per input partition across the network.
    """
    order = [o for o in order if o in df.columns]
    sort = []
    for i, o in enumerate(order):
        desc = newest_request_first and i == 0 and o == "req_idx"
        sort.append(F.col(o).desc() if desc else F.col(o).asc())
    if not sort:  # no order given: the smallest row, so that reruns agree
        sort = _total_order(df, _keys(key))
    w = Window.partitionBy(*_keys(key)).orderBy(*sort)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def _has_no_order(dtype) -> bool:
    if isinstance(dtype, ArrayType):
        return _has_no_order(dtype.elementType)
    if isinstance(dtype, StructType):
        return any(_has_no_order(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (MapType, VariantType))


def _total_order(df: DataFrame, without: list[str]) -> list:
    """All other columns in schema order, NULLs last: two rows that tie on all
    of them are equal.  Maps and variants stand as their JSON text."""
    values = [(F.to_json(F.struct(f.name)) if _has_no_order(f.dataType) else F.col(f.name))
              for f in df.schema.fields if f.name not in without]
    return [v.asc_nulls_last() for v in values] or [F.lit(0).asc()]


def dedup_latest_non_null(df: DataFrame, key, columns: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """Per key, the row whose date columns are latest (NULLs last), then the
    one with most present dates, then the smallest tie-break values.

    The tie-break makes the winner deterministic; by default it is every
    other column in schema order, then the date columns themselves, so rows
    in any order give the same winner.
    """
    keys = _keys(key)
    ties = _total_order(df, [*keys, *columns]) + _total_order(df, [c for c in df.columns if c not in columns]) \
        if tie_break is None else [F.col(c).asc_nulls_last() for c in tie_break]
    w = Window.partitionBy(*keys).orderBy(
        latest_of(df, list(columns)).desc_nulls_last(),
        present_count(df, list(columns)).desc(),
        *ties,
    )
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
