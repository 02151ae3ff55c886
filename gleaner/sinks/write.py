"""Write strategies: upsert, append, full refresh, staged write and merge.

All of them take the whole batch of a run (every request at once), so a run
is one Spark job per table instead of one rewrite per request.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gleaner.functions.missing import AUDIT_COLUMN, audit_stamp
from gleaner.functions.widening import fitted, widened
from gleaner.operators.combine import BROADCAST_MAX_BYTES, any_null_key, key_bytes, union_family, upsert_frame
from gleaner.session import checkpointed, new_scratch
from gleaner.operators.dedup import dedup_first, dedup_latest_non_null
from gleaner.sinks.partitioned import PartitionedTable
from gleaner.sinks.table import Bucketing, VersionedTable, list_tables
from gleaner.spec import Collector, Merge, Staging

HELPERS = ("req_idx", "pos", "_member")

# Batches with at most this many distinct keys, whose counted bytes are within
# BROADCAST_MAX_BYTES, are broadcast to the tasks reading the stored table.
BROADCAST_MAX_KEYS = 5_000_000

# Staging tables written at the same time (each is its own Spark job).
MAX_CONCURRENT_WRITES = 8


def _strip(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in HELPERS if c in df.columns])


def upsert(table: VersionedTable, batch: DataFrame, key, stamp: bool = False,
           order=("req_idx", "pos"), buckets: int | None = None,
           broadcast_max_keys: int = BROADCAST_MAX_KEYS) -> int | None:
    """Replace rows by key (NULL keys match), add new ones; one new version.

    ``buckets`` stores the table bucketed by the key (kept by later writes).
    Up to ``broadcast_max_keys`` batch keys are broadcast to the tasks that
    read the stored table; above that, a bucketed table is merged bucket by
    bucket by an equi anti join (only the batch is shuffled), a plain one by
    a null-safe sort-merge anti join (both sides shuffled).
    """
    if key is None:
        raise ValueError("upsert needs a key")
    if stamp:
        batch = batch.withColumn(AUDIT_COLUMN, audit_stamp())
    # The deduplicated batch is checkpointed to the shared folder: lineage to
    # the fetch is cut (a lost executor re-reads it) and its size is exact.
    # Its count is also the empty check, so the batch plan runs once.
    latest = checkpointed(dedup_first(batch, key, order))
    n_keys, n_bytes = latest.agg(F.count(F.lit(1)), F.coalesce(F.sum(key_bytes(key)), F.lit(0))).first()
    return _upsert_deduplicated(table, latest, key, n_keys, buckets,
                                broadcast_max_keys if n_bytes <= BROADCAST_MAX_BYTES else 0)


def _upsert_deduplicated(table: VersionedTable, latest: DataFrame, key, n_keys: int,
                         buckets: int | None = None, broadcast_max_keys: int = BROADCAST_MAX_KEYS) -> int | None:
    if n_keys == 0:
        return None
    keys = tuple([key] if isinstance(key, str) else key)
    base = table.current_version()
    existing = None if base is None else table.read(base)
    stored = table.bucketing()
    layout = Bucketing(keys, buckets) if buckets else stored
    broadcast = n_keys <= broadcast_max_keys
    # The stored table already has the layout the new version needs: it is
    # read bucket by bucket and never shuffled.
    in_place = existing is None or (stored is not None and stored.columns == keys and layout == stored)
    has_null = None
    if in_place and existing is not None and not broadcast:
        has_null = not latest.filter(any_null_key(latest, key)).isEmpty()
        if has_null and len(keys) > 1:
            in_place = False  # NULL parts of a composite key need the null-safe join (shuffles both sides)
    if existing is not None:  # types that drifted are widened on both sides
        plain = latest.drop(*[c for c in HELPERS if c in latest.columns])
        schema = widened(existing.schema, plain.schema)
        if any(schema[f.name].dataType != f.dataType for f in existing.schema.fields):
            existing, in_place = fitted(existing, schema), False
        latest = fitted(plain, StructType([f for f in schema.fields if f.name.lower() in
                                           {c.lower() for c in plain.columns}]))
    merged = upsert_frame(existing, latest, key, helper_cols=HELPERS, deduplicated=True,
                          broadcast_keys=broadcast, batch_has_null_key=has_null,
                          buckets=layout.buckets if layout is not None and in_place else None)
    if layout is not None and not in_place:
        merged = merged.repartition(layout.buckets, *layout.columns)  # first bucketed version: one shuffle
    return table.replace(merged, bucket_by=layout, after=base or 0)


def append(table: VersionedTable | PartitionedTable, batch: DataFrame, stamp: bool = False,
           batch_id: str | None = None):
    """Add the run's batch.  Into a partitioned table it is written once and as
    a partition of its own, which the same ``batch_id`` replaces."""
    if isinstance(table, PartitionedTable):
        out = _strip(batch)
        return table.append(out.withColumn(AUDIT_COLUMN, audit_stamp()) if stamp else out, batch_id)
    if batch.isEmpty():
        return None
    out = _strip(batch)
    if stamp:
        out = out.withColumn(AUDIT_COLUMN, audit_stamp())
    return table.append(out)


def full_refresh(table: VersionedTable, batch: DataFrame, stamp: bool = False) -> int | None:
    """Replace the table by the run's batch; an empty batch keeps the old rows
    (the new version is written, and committed only if it holds rows)."""
    out = _strip(batch)
    if stamp:
        out = out.withColumn(AUDIT_COLUMN, audit_stamp())
    return table.replace(out, only_if_rows=True)


def member_name(staging: Staging, value) -> str:
    return staging.table_pattern.format(**{staging.partition_param: "default" if value is None else value})


def family_pattern(staging: Staging) -> re.Pattern:
    head, _, tail = staging.table_pattern.partition("{" + staging.partition_param + "}")
    return re.compile("^" + re.escape(head) + "(.+)" + re.escape(tail) + "$")


def staged_write(spark: SparkSession, root: str, namespace: str, staging: Staging, batch: DataFrame,
                 key, members: list, order=("req_idx", "pos"), stamp: bool = False) -> dict[str, int | None]:
    """Upsert each slice of the batch into the staging table of its member.

    ``batch._member`` holds the partition-param value of each row's request;
    ``members`` are values the spec names (literals); values that only the
    batch holds, from a date axis or an override, get their tables too.
    The batch is deduplicated per (member, key) once and written to the
    shared folder partitioned by member: lineage to the fetch is cut, and
    each member's upsert reads its own partition only (not the whole batch
    once per member).  The key count per member (footers and paths only)
    decides each broadcast.
    """
    if key is None:
        raise ValueError("staged writes upsert by key")
    if stamp:
        batch = batch.withColumn(AUDIT_COLUMN, audit_stamp())
    keys = [key] if isinstance(key, str) else list(key)
    deduped = dedup_first(batch, ["_member", *keys], order)
    landed = new_scratch(spark, "staged")
    deduped.write.partitionBy("_member").parquet(landed)
    latest = spark.read.schema(deduped.schema).parquet(landed)  # member values stay text
    sizes = {r["_member"]: (r["n"], r["b"]) for r in latest.groupBy("_member").agg(
        F.count(F.lit(1)).alias("n"), F.sum(key_bytes(keys)).alias("b")).collect()}
    counts = {m: n for m, (n, _) in sizes.items()}
    # The data decide what is written; the spec's members only add tables that
    # this run has no rows for.
    by_table: dict[str, list] = {}
    for m in [*members, *sorted(set(counts) - set(members), key=lambda v: (v is None, v))]:
        by_table.setdefault(member_name(staging, m), []).append(m)

    # Member tables are independent: their upserts run as concurrent Spark
    # jobs, so small members do not leave the cluster idle one after another.
    workers = max(1, min(len(by_table), MAX_CONCURRENT_WRITES))

    def write_table(name: str) -> int | None:
        res = None
        for m in by_table[name]:  # members sharing a table are upserted in order
            part = latest.filter(F.col("_member").eqNullSafe(F.lit(m)))
            small = sizes.get(m, (0, 0))[1] <= BROADCAST_MAX_BYTES // workers  # all that run at once share the bound
            res = _upsert_deduplicated(VersionedTable(spark, root, namespace, name), part, key, counts.get(m, 0),
                                       broadcast_max_keys=BROADCAST_MAX_KEYS // workers if small else 0) or res
        return res

    with ThreadPoolExecutor(max_workers=workers) as pool:
        return dict(zip(by_table, pool.map(write_table, list(by_table))))


def family_tables(spark: SparkSession, root: str, namespace: str, staging: Staging) -> list[VersionedTable]:
    pat = family_pattern(staging)
    return [t for t in list_tables(spark, root) if t.namespace == namespace and pat.match(t.name)]


def merged_frame(frames: list[DataFrame], key, merge: Merge) -> DataFrame:
    combined = union_family(frames)
    if merge.dedup is not None and key is not None:
        combined = dedup_latest_non_null(combined, key, list(merge.dedup.columns))
    return combined


def staged_merge(spark: SparkSession, root: str, namespace: str, staging: Staging, merge: Merge,
                 key=None) -> int | None:
    """Rebuild the merged table from every staging table of the family (the
    merged table itself may fit the pattern but is no member)."""
    members = [t for t in family_tables(spark, root, namespace, staging) if t.name != merge.table]
    if not members:
        return None
    merged = merged_frame([t.read() for t in members], merge.key or key, merge)
    return VersionedTable(spark, root, namespace, merge.table).replace(merged)


def write(spark: SparkSession, collector: Collector, batch: DataFrame, root: str,
          members: list | None = None, stamp: bool = True, batch_id: str | None = None) -> dict:
    """Dispatch a run's batch on the collector's cadence.  ``batch_id`` names
    an appended batch: a run that is tried again under it adds nothing twice."""
    c = collector.cadence
    ns = collector.table_namespace
    if c.staging is not None:
        res = staged_write(spark, root, ns, c.staging, batch, c.primary_key, members or [None], stamp=stamp)
        if c.merge is not None:
            res[c.merge.table] = staged_merge(spark, root, ns, c.staging, c.merge, c.primary_key)
        return res
    table = VersionedTable(spark, root, ns, collector.name)
    parts = PartitionedTable(spark, root, ns, collector.name)
    if c.strategy == "incremental" and (c.buckets or table.exists()):
        return {collector.name: upsert(table, batch, c.primary_key, stamp, buckets=c.buckets)}
    if c.strategy == "incremental":
        if stamp:
            batch = batch.withColumn(AUDIT_COLUMN, audit_stamp())
        return {collector.name: parts.upsert(batch, c.primary_key, partitions=c.key_partitions)}
    if c.strategy == "append":
        return {collector.name: append(table if table.exists() else parts, batch, stamp, batch_id)}
    if c.strategy == "full_refresh":
        return {collector.name: full_refresh(table, batch, stamp)}
    raise ValueError(f"Unknown strategy '{c.strategy}'")
