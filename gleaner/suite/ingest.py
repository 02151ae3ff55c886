"""Projection, casts and the single-key write strategies over orders/lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions.casts import cast_text
from gleaner.functions.paths import json_path
from gleaner.operators import (anti_join_null_safe, dedup_first, project_schema, union_by_name,
                               upsert_frame)
from gleaner.session import new_scratch
from gleaner.sinks.partitioned import PartitionedTable
from gleaner.sinks.table import Bucketing, VersionedTable
from gleaner.sinks.write import append, full_refresh, upsert
from gleaner.spec import Column
from gleaner.suite.registry import register, table


ORDER_BUCKETS = 8


def _months(ts):
    return ((F.year(ts) - 1970) * 12 + F.month(ts) - 1).cast("int")


def shipment_records(spark, sf):
    """lineitem as response records: one request per ship month.

    ``req_idx`` is the month, ``pos`` the line number inside its order; the
    record is the VARIANT object a parsed response holds (quantity arrives
    as text, prices as numbers, dates as ISO text).
    """
    li = table(spark, sf, "lineitem")
    body = F.to_variant_object(F.struct(
        F.struct(F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line")).alias("key"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").cast("string").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.struct(F.col("l_returnflag").alias("return")).alias("flags"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("shipped"),
    ))
    return li.select(_months(F.col("l_shipdate")).alias("req_idx"),
                     F.col("l_linenumber").alias("pos"),
                     body.alias("record"))


# Records of one request are ordered by line number; lineitem repeats line
# numbers inside an order, so ship date and price complete the order.
RECORD_ORDER = ("req_idx", "pos", "last_ship", "o_totalprice")

ORDER_UPDATE = [
    Column("o_orderkey", "key.order", "integer"),
    Column("o_orderstatus", "status", "string"),
    Column("o_totalprice", "price", "float"),
    Column("last_ship", "shipped", "date"),
]

_BATCH_SQL = """
  SELECT l_orderkey AS o_orderkey, l_linestatus AS o_orderstatus, l_extendedprice AS o_totalprice,
         CAST(l_shipdate AS DATE) AS last_ship,
         (year(l_shipdate) - 1970) * 12 + month(l_shipdate) - 1 AS req_idx, l_linenumber AS pos
  FROM lineitem"""

_WIN_SQL = f"""
  SELECT o_orderkey, o_orderstatus, o_totalprice, last_ship FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY req_idx DESC, pos, last_ship, o_totalprice) AS rn
    FROM ({_BATCH_SQL}) b) WHERE rn = 1"""

_UPSERT_SQL = f"""
WITH win AS ({_WIN_SQL})
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(NULL AS DATE) AS last_ship
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM win w WHERE w.o_orderkey IS NOT DISTINCT FROM o.o_orderkey)
UNION ALL
SELECT o_orderkey, NULL, o_orderstatus, o_totalprice, NULL, NULL, last_ship FROM win
"""


@register("json_path", """
SELECT event_id, user_id AS uid, event_type AS kind,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(NULL AS BIGINT) AS k_below_scalar,
       CAST(NULL AS VARCHAR) AS absent,
       '{"id":' || user_id || ',"kind":"' || event_type || '"}' AS user_json
FROM events
""")
def q_json_path(spark, sf):
    ev = table(spark, sf, "events")
    rec = F.parse_json(F.to_json(F.struct(
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("user"),
        F.parse_json("props").alias("props"))))
    r = ev.select("event_id", rec.alias("r"))
    return r.select(
        "event_id",
        json_path("r", "user.id", "bigint").alias("uid"),
        json_path("r", "user.kind", "string").alias("kind"),
        json_path("r", "props.k", "bigint").alias("k"),
        json_path("r", "props.k.deeper", "bigint").alias("k_below_scalar"),
        json_path("r", "props.absent", "string").alias("absent"),
        json_path("r", "user", "string").alias("user_json"),
    )


@register("cast_types", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 5 THEN 1000
       ELSE CAST(trunc(l_quantity + 0.9) AS BIGINT) END AS qty,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS price,
  CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false ELSE NULL END AS returned,
  CAST(l_shipdate AS DATE) AS ship_date,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE l_shipdate END AS ship_ts,
  CASE WHEN l_orderkey % 11 IN (8, 9, 10) THEN NULL ELSE l_shipdate END AS any_ts,
  CASE WHEN l_orderkey % 11 IN (8, 9, 10) THEN NULL ELSE CAST(l_shipdate AS DATE) END AS any_date
FROM lineitem
""")
def q_cast_types(spark, sf):
    li = table(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    # every shape of text that is a time, and three that are none
    shapes = ["yyyyMMdd", "MMM d, yyyy", "MMMM d, yyyy H:mm", "d MMM yyyy H:mm:ss", "yyyy/M/d", "M-d-yyyy", "M/d/yyyy h:mm a",
              "EEE, dd MMM yyyy HH:mm:ss 'GMT'", "yyyy", "HH:mm", "yyyyMMddHHmm"]
    any_time = F.coalesce(*[F.when(F.col("l_orderkey") % 11 == i, F.date_format("l_shipdate", f)) for i, f in enumerate(shapes)])
    texts = li.select(
        "l_orderkey", "l_linenumber",
        F.when(n == 2, F.lit("n/a")).when(n == 5, F.lit("1e3"))
         .otherwise((F.col("l_quantity") + 0.9).cast("string")).alias("qty"),
        F.when(n == 3, F.lit("abc")).otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
        F.when(F.col("l_returnflag") == "R", F.lit("true"))
         .when(F.col("l_returnflag") == "A", F.lit("false")).otherwise(F.lit("maybe")).alias("returned"),
        F.when(n % 2 == 0, F.date_format("l_shipdate", "M/d/yyyy"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("ship_date"),
        F.when(n == 4, F.lit("1/32/2024 10:00"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("ship_ts"),
        any_time.alias("any_ts"),
    )
    return texts.select(
        "l_orderkey", "l_linenumber",
        cast_text(F.col("qty"), "integer").alias("qty"),
        cast_text(F.col("price"), "float").alias("price"),
        cast_text(F.col("returned"), "boolean").alias("returned"),
        cast_text(F.col("ship_date"), "date").alias("ship_date"),
        cast_text(F.col("ship_ts"), "timestamp").cast("timestamp_ntz").alias("ship_ts"),
        cast_text(F.col("any_ts"), "timestamp").cast("timestamp_ntz").alias("any_ts"),
        cast_text(F.col("any_ts"), "date").alias("any_date"),
    )


LINE_SCHEMA = [
    Column("order_key", "key.order", "integer"),
    Column("line_no", "key.line", "integer"),
    Column("quantity", "qty", "integer"),
    Column("price", "price", "float"),
    Column("return_flag", "flags.return", "string"),
    Column("ship_date", "shipped", "date"),
    Column("shipped_at", "shipped", "timestamp"),
    Column("missing", "flags.none", "string"),
]


@register("project_schema", """
SELECT (year(l_shipdate) - 1970) * 12 + month(l_shipdate) - 1 AS req_idx, l_linenumber AS pos,
       l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_no,
       CAST(trunc(l_quantity) AS BIGINT) AS quantity, l_extendedprice AS price,
       l_returnflag AS return_flag, CAST(l_shipdate AS DATE) AS ship_date, l_shipdate AS shipped_at,
       CAST(NULL AS VARCHAR) AS missing
FROM lineitem
""")
def q_project_schema(spark, sf):
    out = project_schema(shipment_records(spark, sf), LINE_SCHEMA)
    return out.withColumn("shipped_at", F.col("shipped_at").cast("timestamp_ntz"))


@register("dedup_first", f"""
SELECT o_orderkey, o_orderstatus, o_totalprice, last_ship FROM ({_WIN_SQL})
""")
def q_dedup_first(spark, sf):
    batch = project_schema(shipment_records(spark, sf), ORDER_UPDATE)
    return dedup_first(batch, "o_orderkey", RECORD_ORDER).drop("req_idx", "pos")


@register("anti_join_null_safe", """
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey IS NOT DISTINCT FROM o.o_orderkey)
""")
def q_anti_join(spark, sf):
    batch = project_schema(shipment_records(spark, sf), ORDER_UPDATE)
    return anti_join_null_safe(table(spark, sf, "orders"), batch, "o_orderkey")


@register("union_by_name", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(NULL AS DATE) AS last_ship FROM orders
UNION ALL
SELECT o_orderkey, NULL, o_orderstatus, o_totalprice, NULL, NULL, last_ship FROM ({_BATCH_SQL}) b
""")
def q_union_by_name(spark, sf):
    batch = project_schema(shipment_records(spark, sf), ORDER_UPDATE).drop("req_idx", "pos")
    return union_by_name(table(spark, sf, "orders"), batch)


@register("upsert_plan", _UPSERT_SQL)
def q_upsert_plan(spark, sf):
    """The upsert as one logical plan (what the sink writes), without the write."""
    batch = project_schema(shipment_records(spark, sf), ORDER_UPDATE)
    return upsert_frame(table(spark, sf, "orders"), batch, "o_orderkey", RECORD_ORDER)


def _seeded_table(spark, sf, name="orders"):
    t = VersionedTable(spark, new_scratch(spark, "warehouse"), "shop", name)
    t.replace(table(spark, sf, "orders"))
    return t


@register("upsert", _UPSERT_SQL)
def q_upsert(spark, sf):
    """Stored orders table, then one run's batch upserted: the partitions that
    its keys fall in are written anew."""
    t = PartitionedTable(spark, new_scratch(spark, "warehouse"), "shop", "orders")
    t.upsert(table(spark, sf, "orders"), "o_orderkey", partitions=ORDER_BUCKETS)
    t.upsert(project_schema(shipment_records(spark, sf), ORDER_UPDATE), "o_orderkey", order=RECORD_ORDER)
    return t.read()


@register("upsert_version", _UPSERT_SQL)
def q_upsert_version(spark, sf):
    """The same into a table of versions: a new version of the whole table."""
    t = _seeded_table(spark, sf)
    upsert(t, project_schema(shipment_records(spark, sf), ORDER_UPDATE), "o_orderkey", order=RECORD_ORDER)
    return t.read()


@register("upsert_touched", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4096 = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders
""")
def q_upsert_touched(spark, sf):
    """A batch of few keys rewrites the partitions they fall in, no others."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    t = PartitionedTable(spark, new_scratch(spark, "warehouse"), "shop", "orders")
    t.upsert(orders, "o_orderkey", partitions=ORDER_BUCKETS)
    t.upsert(orders.where("o_orderkey % 4096 = 7").withColumn("o_orderstatus", F.lit("X")), "o_orderkey")
    return t.read()


@register("append_widened", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS who, CAST(o_totalprice AS DOUBLE) AS amount FROM orders
UNION ALL SELECT l_orderkey, 'supplier ' || l_suppkey, CAST(l_linenumber AS DOUBLE) FROM lineitem
""")
def q_append_widened(spark, sf):
    """Columns whose type drifts: text into a bigint, a double into an int."""
    t = PartitionedTable(spark, new_scratch(spark, "warehouse"), "shop", "drift")
    append(t, table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("who"),
        F.col("l_linenumber").cast("int").alias("amount")))
    append(t, table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("who"), F.col("o_totalprice").alias("amount")))
    return t.read()


@register("append", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(NULL AS DATE) AS last_ship FROM orders
UNION ALL
SELECT o_orderkey, NULL, o_orderstatus, o_totalprice, NULL, NULL, last_ship FROM ({_BATCH_SQL}) b
""")
def q_append(spark, sf):
    t = PartitionedTable(spark, new_scratch(spark, "warehouse"), "shop", "orders")
    append(t, table(spark, sf, "orders"))
    append(t, project_schema(shipment_records(spark, sf), ORDER_UPDATE))
    return t.read()


@register("full_refresh", f"""
SELECT o_orderkey, o_orderstatus, o_totalprice, last_ship FROM ({_BATCH_SQL}) b
""")
def q_full_refresh(spark, sf):
    t = _seeded_table(spark, sf)
    full_refresh(t, project_schema(shipment_records(spark, sf), ORDER_UPDATE))
    return t.read()


@register("upsert_bucketed", _UPSERT_SQL)
def q_upsert_bucketed(spark, sf):
    """The upsert into an orders table stored bucketed by key, on the path a
    batch above the broadcast bound takes (forced here with a bound of 0):
    one anti join reads the stored table bucket by bucket, only the
    batch is shuffled, and the new version is written one file per bucket."""
    layout = Bucketing(("o_orderkey",), ORDER_BUCKETS)
    t = VersionedTable(spark, new_scratch(spark, "warehouse"), "shop", "orders")
    t.replace(table(spark, sf, "orders").repartition(ORDER_BUCKETS, "o_orderkey"), bucket_by=layout)
    upsert(t, project_schema(shipment_records(spark, sf), ORDER_UPDATE), "o_orderkey", order=RECORD_ORDER,
           broadcast_max_keys=0)
    return t.read()
