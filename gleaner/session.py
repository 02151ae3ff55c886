"""Session helpers: one place that knows the settings the engine relies on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of the engine needs.  UTC makes timestamp casts and
# epoch formatting independent of the machine; AQE re-plans joins and
# partition counts from runtime sizes, which is how small batch sides become
# broadcasts without an unchecked hint.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # A bucketed table is always read bucket by bucket, so its partitioning
    # carries through to joins, unions and the bucketed write of the next
    # version (one file per bucket) instead of being dropped when no
    # operator above the scan asks for it.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


def get_session(master: str | None = None, app: str = "gleaner", **conf: str) -> SparkSession:
    """Return the active session, or build one with the engine settings.

    On a cluster the session normally exists already (spark-submit); only
    the SQL settings are applied to it then.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in {**ENGINE_CONF, **conf}.items():
            if k.startswith("spark.sql."):
                active.conf.set(k, v)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.bindAddress": "127.0.0.1",
        **ENGINE_CONF,
        **conf,
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach: below ``spark.checkpoint.dir``.

    The cluster names that setting; a test session without one gets a
    private folder set here (``local`` masters only).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = os.path.join(os.environ.get("TMPDIR", "/tmp"), f"gleaner-{uuid.uuid4().hex[:8]}")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])


def new_scratch(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused folder below the shared folder."""
    return shared_dir(spark, "gleaner", kind, uuid.uuid4().hex)


def checkpointed(df):
    """Reliable checkpoint into the shared folder (never a local one): cuts
    lineage so a lost executor re-reads files instead of recomputing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def saved(df: DataFrame, kind: str) -> DataFrame:
    """Write once below the shared folder and read back: later steps, and
    tasks run anew after a lost executor, read files and recompute nothing."""
    path = new_scratch(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
