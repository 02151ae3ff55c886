"""Null-safe anti join, unions and the upsert that composes them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from gleaner.operators.dedup import dedup_first


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


# Keys are broadcast while their counted bytes stay under this bound.
BROADCAST_MAX_BYTES = 256 << 20


def key_bytes(key):
    """What a row's key weighs in a broadcast, roughly: its text and a row's overhead."""
    sizes = [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in _keys(key)]
    return reduce(lambda a, b: a + b, sizes) + 24


def anti_join_null_safe(existing: DataFrame, batch: DataFrame, key, broadcast_keys: bool = False) -> DataFrame:
    """Rows of ``existing`` whose key does not occur in ``batch`` (NULL matches NULL).

    ``<=>`` is planned as a hash/sort-merge join on (coalesce, isnull) keys,
    not a nested loop.  ``broadcast_keys=True`` ships the batch keys to every
    task so the existing table is filtered where it is read, with no
    shuffle; callers set it only after counting the keys (see ``upsert``).
    """
    keys = _keys(key)
    right = batch.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    if broadcast_keys:
        right = F.broadcast(right)
    cond = reduce(lambda a, b: a & b,
                  [existing[k].eqNullSafe(right[f"__k{i}"]) for i, k in enumerate(keys)])
    return existing.join(right, cond, "left_anti")


def any_null_key(df: DataFrame, key):
    """Rows whose key has a NULL part (those only a null-safe join can match)."""
    return reduce(lambda a, b: a | b, [df[k].isNull() for k in _keys(key)])


def upsert_bucketed(existing: DataFrame, latest: DataFrame, key, buckets: int, batch_has_null_key: bool) -> DataFrame:
    """Upsert of a deduplicated batch into a stored side bucketed by ``key``.

    ``<=>`` join keys are expressions, not the bucket columns, so Spark would
    shuffle the stored side.  An equi anti join reads it bucket by bucket, and
    only the batch moves; the batch is then added, hash-partitioned like the
    buckets, so that each output partition holds one bucket (one file per
    bucket when written).  Every stored row of a batch key goes, also where
    the key is stored more than once.  A NULL key never matches in an
    equi-join, so with one key column stored NULL-key rows are dropped when
    the batch has one.  Keys of several columns with NULL parts in the batch
    need ``<=>``: the caller takes the null-safe path for those batches.
    """
    keys = _keys(key)
    if batch_has_null_key and len(keys) > 1:
        raise ValueError("several key columns with NULL parts need the null-safe upsert")
    wanted = latest.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    cond = reduce(lambda x, y: x & y, [existing[k] == wanted[f"__k{i}"] for i, k in enumerate(keys)])
    kept = existing.join(wanted, cond, "left_anti")
    if batch_has_null_key:
        kept = kept.filter(F.col(keys[0]).isNotNull())
    return union_by_name(kept, latest.repartition(buckets, *keys))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_family(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL over a family of tables with the same layout."""
    if not frames:
        raise ValueError("empty table family")
    return union_by_name(*frames)


def upsert_frame(existing: DataFrame | None, batch: DataFrame, key,
                 order=("req_idx", "pos"), helper_cols=("req_idx", "pos"), broadcast_keys: bool = False,
                 deduplicated: bool = False, buckets: int | None = None,
                 batch_has_null_key: bool | None = None) -> DataFrame:
    """Result of upserting ``batch`` into ``existing`` by ``key`` in one job.

    Equivalent to applying the requests one after another: per key the
    record of the highest request index wins, within a request the first.
    Existing rows whose key is in the batch are replaced; new columns are
    added with NULLs for old rows.

    ``buckets``: ``existing`` is bucketed by ``key`` into that many buckets.
    It is read in place either way: the broadcast anti join keeps its buckets
    and the batch is hash-partitioned the same way for the union; without a
    broadcast, an equi anti join does the same bucket by bucket.
    """
    latest = batch if deduplicated else dedup_first(batch, key, order)
    latest = latest.drop(*[c for c in helper_cols if c in latest.columns])
    if existing is None:
        return latest.repartition(buckets, *_keys(key)) if buckets else latest
    if buckets:
        if broadcast_keys:  # the broadcast join keeps the stored side's buckets; the union zips them
            kept = anti_join_null_safe(existing, latest, key, broadcast_keys=True)
            return union_by_name(kept, latest.repartition(buckets, *_keys(key)))
        if batch_has_null_key is None:
            batch_has_null_key = not latest.filter(any_null_key(latest, key)).isEmpty()
        return upsert_bucketed(existing, latest, key, buckets, batch_has_null_key)
    return union_by_name(anti_join_null_safe(existing, latest, key, broadcast_keys), latest)
