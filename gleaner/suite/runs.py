"""Write strategies by dispatch, and the small operators around a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog import classify_statements
from gleaner.functions.missing import AUDIT_COLUMN
from gleaner.operators import as_text
from gleaner.session import new_scratch
from gleaner.sinks.partitioned import PartitionedTable
from gleaner.sinks.table import VersionedTable
from gleaner.sinks.write import write
from gleaner.spec import Cadence, Collector, FunctionSource
from gleaner.streaming import publish
from gleaner.suite.registry import register, table

_BATCHES = """
  SELECT o_orderkey AS id, o_orderstatus AS status, 0 AS run FROM orders WHERE o_orderkey % 3 <> 0
  UNION ALL SELECT o_orderkey, 'again', 1 FROM orders WHERE o_orderkey % 2 = 0"""


@register("write_dispatch", f"""
WITH b AS ({_BATCHES})
SELECT 'append' AS strategy, id, status, true AS stamped FROM b
UNION ALL SELECT 'full_refresh', id, status, true FROM b WHERE run = 1
UNION ALL SELECT 'incremental', id, arg_max(status, run), true FROM b GROUP BY id
""")
def q_write_dispatch(spark, sf):
    """Two runs' batches through each strategy; every row carries its audit stamp."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    runs = [o.where("id % 3 <> 0"), o.where("id % 2 = 0").withColumn("status", F.lit("again"))]
    root, out = new_scratch(spark, "warehouse"), None
    for strategy in ("append", "full_refresh", "incremental"):
        coll = Collector(strategy, FunctionSource(len), Cadence(strategy, primary_key="id", key_partitions=8), namespace="runs")
        for batch in runs:
            write(spark, coll, batch, root)
        kind = VersionedTable if strategy == "full_refresh" else PartitionedTable
        stamped = F.col(AUDIT_COLUMN).rlike(r"^\d{4}-\d\d-\d\d")
        rows = kind(spark, root, "runs", strategy).read().select(
            F.lit(strategy).alias("strategy"), "id", "status", F.coalesce(stamped, F.lit(False)).alias("stamped"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("as_text", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer
""")
def q_as_text(spark, sf):
    return as_text(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


@register("classify_statements", """
SELECT statement, is_write, count(*) AS n FROM (
  SELECT s.sql || ' ' || p_type AS statement, s.w AS is_write FROM part JOIN (VALUES
    (0, 'select * from', false), (1, '  INSERT into', true), (2, 'with x as', false), (3, 'Drop table', true),
    (4, 'created by', false), (5, 'update', true), (6, 'describe', false)) AS s(i, sql, w) ON p_partkey % 7 = s.i)
GROUP BY statement, is_write
""")
def q_classify_statements(spark, sf):
    words = ["select * from", "  INSERT into", "with x as", "Drop table", "created by", "update", "describe"]
    first = F.coalesce(*[F.when(F.col("p_partkey") % 7 == i, F.lit(w)) for i, w in enumerate(words)])
    texts = table(spark, sf, "part").select(F.concat(first, F.lit(" "), F.col("p_type")).alias("statement"))
    return classify_statements(texts, "statement").groupBy("statement", "is_write").agg(F.count(F.lit(1)).alias("n"))


@register("publish_copies", """
SELECT '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS value, 3 AS n FROM events WHERE event_type <> 'view'
""")
def q_publish_copies(spark, sf):
    """Each message is written three times to the message folder."""
    folder = new_scratch(spark, "published")
    e = table(spark, sf, "events").where("event_type <> 'view'")
    publish(e.select(F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("value")), folder, 3)
    return spark.read.text(folder).groupBy("value").agg(F.count(F.lit(1)).cast("int").alias("n"))
