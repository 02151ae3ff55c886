"""Structured Streaming pipeline for JSON message collectors.

``readStream`` (Kafka in production, files in tests) -> ``decode_messages``
(undecodable text dropped) -> ``project_messages`` (dot paths, strict casts)
-> the warehouse table, a batch every ``window_seconds``.  The checkpoint
holds the offsets, so a restarted query resumes where the lost one stopped;
each micro-batch is a partition of the table named by stream and batch id, so
one that is run again replaces itself.  Batch appends go to the same table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column as SColumn, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType,
                               TimestampType)

from gleaner.functions.casts import cast_variant, strict_cast_text
from gleaner.functions.paths import json_path
from gleaner.session import shared_dir
from gleaner.sinks.partitioned import PartitionedTable
from gleaner.spec import Collector, Column, MessageSource

_TYPES = {"string": StringType(), "integer": LongType(), "float": DoubleType(), "boolean": BooleanType(),
          "timestamp": TimestampType(), "date": DateType()}


def message_schema(columns: list[Column]) -> StructType:
    """Output schema of a message collector; untyped columns are text."""
    return StructType([StructField(c.name, _TYPES.get(c.type or "string", StringType()), True) for c in columns])


def kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str,
                   starting_offsets: str = "latest", min_partitions: int | None = None) -> DataFrame:
    """The message stream of a topic (needs the spark-sql-kafka connector on
    the classpath; tests read files with ``readStream.text`` instead).

    ``minPartitions`` (default: the cluster's cores) lets Spark cut the
    offset range of each topic partition into several tasks, so a topic with
    one partition is still decoded in parallel, with no shuffle."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("minPartitions", str(min_partitions or spark.sparkContext.defaultParallelism))
            .load()
            .select(F.col("value").cast("string").alias("value")))


def decode_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages -> VARIANT ``record``; text that is not JSON is dropped."""
    rec = F.try_parse_json(F.col(value).cast("string"))
    return df.select(rec.alias("record")).filter(F.col("record").isNotNull())


def _message_value(record: SColumn, col: Column) -> SColumn:
    v = json_path(record, col.path or col.name, "variant")
    if col.type in ("timestamp", "date"):
        return strict_cast_text(F.try_variant_get(v, "$", "string"), col.type)
    if col.type is None:
        return F.try_variant_get(v, "$", "string")
    return cast_variant(v, col.type)


def project_messages(decoded: DataFrame, columns: list[Column]) -> DataFrame:
    """Each column by its path (its name when no path), cast like batch
    records except dates/timestamps, which accept ISO text only."""
    rec = F.col("record")
    return decoded.select(*[_message_value(rec, c).alias(c.name) for c in columns])


def run_stream(spark: SparkSession, collector: Collector, messages: DataFrame, root: str,
               checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Start the append stream of a message collector into its warehouse table."""
    if not isinstance(collector.source, MessageSource):
        raise ValueError("run_stream needs a MessageSource collector")
    if collector.cadence.strategy != "append":
        raise ValueError(f"a stream only adds rows: strategy 'append', not {collector.cadence.strategy!r}")
    columns = list(collector.source.schema or [])
    table = PartitionedTable(spark, root, collector.table_namespace, collector.name)
    out = project_messages(decode_messages(messages), columns)
    checkpoint = checkpoint or shared_dir(spark, "gleaner", "streams", collector.table_namespace, collector.name)
    writer = (out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
              .foreachBatch(append_batches(table, checkpoint)))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=f"{collector.window_seconds} seconds")
    return writer.start()


def append_batches(table: PartitionedTable, checkpoint: str):
    """foreachBatch sink: a micro-batch becomes a partition of the table, named
    by the stream (its checkpoint) and the batch id.  Run again after a
    failure it replaces itself; streams with other checkpoints have other names."""
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, f"{stream}-{batch_id}")
    return sink


def tumbling_counts(events: DataFrame, ts: str, window_seconds: int, group: list[str], value: str,
                    watermark: str = "10 minutes") -> DataFrame:
    """Event-time tumbling windows: events and value sum per window and group.
    The watermark bounds the state kept for late events."""
    return (events.withWatermark(ts, watermark)
            .groupBy(F.window(ts, f"{window_seconds} seconds").alias("w"), *group)
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *group, "n_events", "total_value"))


def write_changelog(path: str):
    """foreachBatch sink: each micro-batch's updated rows, tagged with the batch id.
    A replayed batch writes the same rows with the same id."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(path)
    return sink


def latest_changelog(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current value per key: the row of the highest batch id."""
    from gleaner.operators.dedup import dedup_first

    log = spark.read.parquet(path).withColumnRenamed("_batch", "req_idx")
    return dedup_first(log, keys, order=("req_idx",)).drop("req_idx")


def publish(messages: DataFrame, folder: str, count: int = 1, value: str = "value") -> None:
    """Write every message ``count`` times to the message sink (text files here;
    ``format("kafka")`` with a topic option where the connector is present)."""
    copies = messages.select(F.col(value).cast("string").alias("value"),
                             F.explode(F.sequence(F.lit(1), F.lit(count))).alias("copy"))
    copies.select("value").write.mode("append").text(folder)
