"""Streams over the events table: a file stream, run to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.session import new_scratch
from gleaner.sinks.partitioned import PartitionedTable
from gleaner.sinks.write import append
from gleaner.spec import Cadence, Collector, Column, MessageSource
from gleaner.streaming import (decode_messages, latest_changelog, project_messages, run_stream,
                               tumbling_counts, write_changelog)
from gleaner.suite.registry import table


def event_messages(spark, sf):
    """The events table as a stream of JSON messages.  Error events arrive
    truncated (not JSON) and must be dropped by the decoder."""
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/event[s].parquet")
    good = F.to_json(F.struct(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("user_id").alias("user"),
        F.col("event_type").alias("kind"),
        F.parse_json("props").alias("payload"),
        F.col("value").alias("amount")))
    bad = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "kind": "error"'))
    # One file is one split: spread it as the Kafka reader's minPartitions
    # spreads a one-partition topic, so decoding is not left to one task.
    stream = stream.repartition(spark.sparkContext.defaultParallelism, "event_id")
    return stream.select(F.when(F.col("event_type") == "error", bad).otherwise(good).alias("value"))


MESSAGE_COLUMNS = [
    Column("id", "id", "integer"), Column("at", "at", "timestamp"), Column("kind", "kind", "string"),
    Column("k", "payload.k", "integer"), Column("amount", "amount", "float"),
]


def _run_to_end(df, path, mode="append", fmt="parquet", foreach=None):
    ckpt = path + "_checkpoint"
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt).trigger(availableNow=True)
    q = w.foreachBatch(foreach).start() if foreach else w.format(fmt).start(path)
    q.awaitTermination()


def _register():
    from gleaner.suite.registry import register

    @register("stream_decode", """
SELECT event_id AS id, ts AS "at", event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       value AS amount
FROM events WHERE event_type <> 'error'
""")
    def q_stream_decode(spark, sf):
        out = new_scratch(spark, "stream")
        projected = project_messages(decode_messages(event_messages(spark, sf)), MESSAGE_COLUMNS)
        _run_to_end(projected, out)
        return spark.read.parquet(out).withColumn("at", F.col("at").cast("timestamp_ntz"))

    @register("stream_append", """
SELECT event_id AS id, CAST(ts AS DATE) AS day, user_id AS "user", event_type AS kind FROM events
WHERE event_type <> 'error'
""")
    def q_stream_append(spark, sf):
        root = new_scratch(spark, "warehouse")
        coll = Collector("clicks", MessageSource("events", schema=(
            Column("id", "id", "integer"), Column("day", "day", "date"), Column("user", "user", "integer"),
            Column("kind", "kind", "string"))), Cadence("append"), namespace="live", streaming=True)
        q = run_stream(spark, coll, event_messages(spark, sf), root,
                       checkpoint=new_scratch(spark, "checkpoint"), available_now=True)
        q.awaitTermination()
        return PartitionedTable(spark, root, "live", "clicks").read()

    @register("stream_and_batch_append", """
SELECT event_id AS id, event_type AS kind, 'stream' AS via FROM events WHERE event_type <> 'error'
UNION ALL
SELECT event_id + 1000000000, event_type, 'batch' FROM events WHERE event_type = 'error'
""")
    def q_stream_and_batch_append(spark, sf):
        """One table fed by a stream and by batches: the stream runs, a batch is
        appended (and, as a retry, appended again), the stream is started again
        from its checkpoint; every row is there once."""
        root, checkpoint = new_scratch(spark, "warehouse"), new_scratch(spark, "checkpoint")
        coll = Collector("clicks", MessageSource("events", schema=(
            Column("id", "id", "integer"), Column("kind", "kind", "string"))), Cadence("append"), namespace="live",
            streaming=True)
        late = table(spark, sf, "events").where("event_type = 'error'").select(
            (F.col("event_id") + 1000000000).alias("id"), F.col("event_type").alias("kind"))
        t = PartitionedTable(spark, root, "live", "clicks")
        for _ in range(2):
            run_stream(spark, coll, event_messages(spark, sf), root, checkpoint, available_now=True).awaitTermination()
            append(t, late, batch_id="late")
        return t.read().select("id", "kind", F.when(F.col("id") >= 1000000000, "batch").otherwise("stream").alias("via"))

    @register("stream_tumbling", """
SELECT date_trunc('minute', ts) AS window_start, event_type AS kind, count(*) AS n_events,
       round(sum(value), 2) AS total_value
FROM events WHERE event_type <> 'error' GROUP BY 1, 2
""")
    def q_stream_tumbling(spark, sf):
        out = new_scratch(spark, "changelog")
        decoded = project_messages(decode_messages(event_messages(spark, sf)), MESSAGE_COLUMNS)
        counts = tumbling_counts(decoded, "at", 60, ["kind"], "amount")
        _run_to_end(counts, out, mode="update", foreach=write_changelog(out))
        latest = latest_changelog(spark, out, ["window_start", "kind"])
        return latest.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "kind",
                             "n_events", F.round("total_value", 2).alias("total_value"))


_register()
