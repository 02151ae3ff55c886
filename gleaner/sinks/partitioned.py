"""A warehouse table as one Parquet folder, written by Spark's own writer with
dynamic partition overwrite: a write replaces the partitions it holds rows
of, and the files of all others stay as they are.

Partitions are named by what wrote them, in the hidden column ``_part``:

* ``append``: one partition per batch, named by the batch's id.  A batch that
  is written again (a retried run, a replayed micro-batch of a stream)
  replaces itself, so every row is there once.
* ``upsert``: a fixed number of partitions by a hash of the key.  A batch reads
  and rewrites only the partitions its keys fall in.

Spark commits a job's partitions by moving them into place one after another,
as for any partitioned Parquet table: a reader in that moment may see some of
them.  One writer at a time per table; concurrent commits are a matter for a
table format.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gleaner.functions.widening import fitted, widened
from gleaner.operators.combine import BROADCAST_MAX_BYTES, key_bytes, upsert_frame
from gleaner.operators.dedup import dedup_first
from gleaner.session import checkpointed
from gleaner.sinks.table import _FS

PART = "_part"
FOLDER = "parts"
KEY_PARTITIONS = 64


class PartitionedTable:
    def __init__(self, spark: SparkSession, root: str, namespace: str, name: str):
        self.spark = spark
        self.namespace = namespace
        self.name = name
        self.path = f"{root.rstrip('/')}/{namespace}/{name}"
        self._fs = _FS(spark, root)

    @property
    def full_name(self) -> str:
        return f"{self.namespace}.{self.name}"

    def location(self) -> str:
        return f"{self.path}/{FOLDER}"

    def parts(self) -> list[str]:
        return sorted(n.partition("=")[2] for n in self._fs.dirs(self.location()) if n.startswith(f"{PART}="))

    def exists(self) -> bool:
        return bool(self.parts())

    def read(self) -> DataFrame | None:
        """The table's rows; None where nothing was written yet."""
        return self._stored().drop(PART) if self.exists() else None

    def _stored(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(self.location()).withColumn(
            PART, F.col(PART).cast("string"))

    def _write(self, df: DataFrame) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART)
         .parquet(self.location()))

    def _fit(self, new: StructType) -> StructType:
        """The schema that holds stored and new columns.  Where a stored column
        has to be wider, the table is rewritten with it first."""
        if not self.exists():
            return new
        stored = self._stored()
        old = StructType([f for f in stored.schema.fields if f.name != PART])
        schema = widened(old, new)
        was = {f.name: f.dataType for f in old.fields}
        if any(f.name in was and was[f.name] != f.dataType for f in schema.fields):
            part = stored.schema[PART]
            self._write(fitted(stored, StructType([f for f in schema.fields if f.name in was] + [part])))
        return schema

    # ---- append ----------------------------------------------------------
    def append(self, df: DataFrame, batch_id: str | None = None) -> str:
        """Add a batch.  ``batch_id`` names it (default: a new name): the same
        id again replaces the batch.  A batch without rows adds nothing."""
        batch_id = batch_id or uuid.uuid4().hex
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch_id):
            raise ValueError("a batch id has letters, digits, '_' and '-' only")
        if any(_KEYED.match(p) for p in self.parts()[:1]):
            raise ValueError(f"{self.full_name} is upserted by key; appended rows would not be found by it")
        schema = self._fit(df.schema)
        self._write(fitted(df, schema).withColumn(PART, F.lit(f"batch-{batch_id}")))
        return batch_id

    # ---- upsert ----------------------------------------------------------
    def upsert(self, batch: DataFrame, key, order=("req_idx", "pos"), helpers=("req_idx", "pos", "_member"),
               partitions: int = KEY_PARTITIONS, broadcast_max_keys: int = 5_000_000) -> int:
        """Replace rows by key (NULL keys match), add new ones; returns how many
        partitions were written.  Of equal keys in the batch the row of the
        highest request, then of the lowest position, counts.  ``partitions``
        is fixed by the first batch; an empty batch changes nothing."""
        if key is None:
            raise ValueError("upsert needs a key")
        keys = [key] if isinstance(key, str) else list(key)
        known = self.parts()
        if known:
            mark, partitions = self._layout(known[0], keys)
        else:
            mark = _mark(keys)
        latest = dedup_first(batch, keys, order)
        latest = latest.drop(*[c for c in helpers if c in latest.columns])
        schema = self._fit(latest.schema)
        latest = checkpointed(fitted(latest, schema).withColumn(PART, _part_of(keys, mark, partitions)))
        touched = {r[PART]: (r["n"], r["b"]) for r in latest.groupBy(PART).agg(
            F.count(F.lit(1)).alias("n"), F.sum(key_bytes(keys)).alias("b")).collect()}
        n_keys, n_bytes = (sum(x) for x in zip(*touched.values())) if touched else (0, 0)
        if not touched:
            return 0
        old = None
        if set(touched) & set(known):
            old = self._stored()
            old = fitted(old, StructType(schema.fields + [old.schema[PART]])).where(F.col(PART).isin(*touched))
        merged = upsert_frame(old, latest, keys, deduplicated=True, helper_cols=(),
                              broadcast_keys=n_keys <= broadcast_max_keys and n_bytes <= BROADCAST_MAX_BYTES)
        # files by partition: small ones in one task, large ones split
        self._write(merged.hint("rebalance", PART))
        return len(touched)

    def _layout(self, part: str, keys: list[str]) -> tuple[str, int]:
        m = _KEYED.match(part)
        if not m:
            raise ValueError(f"{self.full_name} was written by append; upsert needs a table of its own")
        if m["mark"] != _mark(keys):
            raise ValueError(f"{self.full_name} is upserted by another key than {', '.join(keys)}")
        return m["mark"], int(m["n"])


_KEYED = re.compile(r"key-(?P<mark>[0-9a-f]{8})-(?P<n>\d+)-\d+$")


def _mark(keys: list[str]) -> str:
    return hashlib.sha256("\0".join(keys).encode()).hexdigest()[:8]


def _part_of(keys: list[str], mark: str, n: int) -> Column:
    """By the keys' text, which stays where an integer column becomes text."""
    at = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(n))
    return F.concat(F.lit(f"key-{mark}-{n}-"), at.cast("string"))


def partitioned_tables(spark: SparkSession, root: str) -> list[PartitionedTable]:
    """Every partitioned table with rows below a warehouse root."""
    fs = _FS(spark, root)
    return [t for ns in sorted(fs.dirs(root)) for name in sorted(fs.dirs(f"{root.rstrip('/')}/{ns}"))
            if (t := PartitionedTable(spark, root, ns, name)).exists()]
