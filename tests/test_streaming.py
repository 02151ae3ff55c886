import datetime as dt

from pyspark.sql import functions as F

from gleaner.session import new_scratch
from gleaner.sinks.partitioned import PartitionedTable
from gleaner.spec import Cadence, Collector, Column, MessageSource
from gleaner.streaming import (decode_messages, latest_changelog, message_schema, project_messages, publish,
                               run_stream, tumbling_counts, write_changelog)

from conftest import rows

MESSAGES = [
    '{"id": 1, "at": "2024-01-05T10:00:00Z", "user": {"name": "ann"}, "n": "3.7"}',
    'not json at all',
    '{"id": 2, "at": "2024-01-05T10:00:30.250Z", "user": {"name": "bob"}, "n": 4}',
    '{"id": 3, "at": "2024-01-05 10:01:10", "user": "flat", "n": null}',
    '{"id": 4, "at": "2024-01-05T10:01:59Z", "user": {"name": "cy"}, "n": 1, "day": "2024-01-05"}',
]
COLUMNS = [Column("id", "id", "integer"), Column("at", "at", "timestamp"), Column("name", "user.name", "string"),
           Column("n", "n", "integer"), Column("day", "day", "date")]


def _files(spark):
    folder = new_scratch(spark, "t-msgs")
    spark.createDataFrame([(m,) for m in MESSAGES], "value string").coalesce(1).write.text(folder)
    return folder


def test_decode_project_batch(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    out = project_messages(decode_messages(df), COLUMNS)
    got = rows(out, "id", "at", "name", "n")
    assert got == sorted([(1, dt.datetime(2024, 1, 5, 10), "ann", 3), (2, dt.datetime(2024, 1, 5, 10, 0, 30, 250000), "bob", 4),
                          (3, None, None, None), (4, dt.datetime(2024, 1, 5, 10, 1, 59), "cy", 1)], key=repr)
    assert [f.dataType.simpleString() for f in message_schema(COLUMNS).fields] == \
        ["bigint", "timestamp", "string", "bigint", "date"]


def test_stream_equals_batch(spark):
    folder = _files(spark)
    root = new_scratch(spark, "t-stream-wh")
    coll = Collector("msgs", MessageSource("topic", schema=tuple(COLUMNS)), Cadence("append"), streaming=True)
    q = run_stream(spark, coll, spark.readStream.text(folder), root, checkpoint=new_scratch(spark, "t-ck"),
                   available_now=True)
    q.awaitTermination()
    streamed = PartitionedTable(spark, root, "msgs", "msgs").read()
    batch = project_messages(decode_messages(spark.read.text(folder)), COLUMNS)
    assert rows(streamed) == rows(batch.select(*streamed.columns))


def test_tumbling_windows_all_closed(spark):
    folder = _files(spark)
    decoded = project_messages(decode_messages(spark.readStream.text(folder)), COLUMNS)
    counts = tumbling_counts(decoded.withColumn("one", F.lit(1.0)), "at", 60, [], "one")
    log = new_scratch(spark, "t-log")
    q = (counts.writeStream.outputMode("update").option("checkpointLocation", log + "_ck")
         .trigger(availableNow=True).foreachBatch(write_changelog(log)).start())
    q.awaitTermination()
    got = rows(latest_changelog(spark, log, ["window_start"]), "window_start", "n_events")
    assert got == [(dt.datetime(2024, 1, 5, 10, 0), 2), (dt.datetime(2024, 1, 5, 10, 1), 1)]


def test_publish_copies(spark):
    out = new_scratch(spark, "t-pub")
    publish(spark.createDataFrame([("a",), ("b",)], "value string"), out, count=3)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == ["a"] * 3 + ["b"] * 3


def test_processing_time_trigger(spark):
    folder = _files(spark)
    root = new_scratch(spark, "t-stream-pt")
    coll = Collector("msgs", MessageSource("topic", schema=tuple(COLUMNS)), Cadence("append"), streaming=True,
                     window_seconds=1)
    q = run_stream(spark, coll, spark.readStream.text(folder), root, checkpoint=new_scratch(spark, "t-ck2"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert PartitionedTable(spark, root, "msgs", "msgs").read().count() == 4


def test_stream_and_batches_share_a_table(spark):
    """Stream, batch append, restart with more messages, a batch id run again:
    all rows once."""
    from gleaner.sinks.write import append
    from gleaner.streaming.messages import append_batches

    folder, root, ck = _files(spark), new_scratch(spark, "t-both"), new_scratch(spark, "t-ck3")
    coll = Collector("msgs", MessageSource("topic", schema=tuple(COLUMNS)), Cadence("append"), streaming=True)

    def run():
        run_stream(spark, coll, spark.readStream.text(folder), root, checkpoint=ck, available_now=True).awaitTermination()

    run()
    t = PartitionedTable(spark, root, "msgs", "msgs")
    extra = spark.createDataFrame([(50, "dee")], "id bigint, name string")
    append(t, extra, batch_id="b1")
    append(t, extra, batch_id="b1")
    spark.createDataFrame([('{"id": 9}',)], "value string").coalesce(1).write.mode("append").text(folder)
    run()
    run()
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2, 3, 4, 9, 50]
    again = t.read().where("id = 9")
    append_batches(t, ck)(spark.createDataFrame(again.collect(), again.schema), 1)
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2, 3, 4, 9, 50]
