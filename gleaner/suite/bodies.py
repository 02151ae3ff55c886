"""Response bodies, transforms and run outcomes over the driver tables.

Bodies are built from the tables as a remote API would send them: pages of
at most 100 records (pages follow input partitions, not a data key), JSON
nested under ``response.results`` or CSV with a header line.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import project_schema, rows_per_request, run_summary, schema_inferred
from gleaner.sources.records import (csv_header_fields, dead_letters, infer_text_types, parse_csv_records,
                                     parse_json_records, records_of, request_outcomes)
from gleaner.session import checkpointed, saved
from gleaner.spec import ArrayJoin, Column, CrsReproject
from gleaner.suite.fixtures import pages_of
from gleaner.suite.registry import register, table

PAGE = 100
LINE_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]


def json_bodies(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINE_COLS)
    pages = pages_of(li, PAGE, LINE_COLS)
    body = F.to_json(F.struct(F.struct(F.col("rows").alias("results")).alias("response")))
    return pages.select(F.col("page").alias("req_idx"), body.alias("body"))


@register("parse_json_records", """
SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_no, l_quantity AS quantity,
       l_extendedprice AS price, l_returnflag AS flag, l_shipdate AS shipped_at
FROM lineitem
""")
def q_parse_json_records(spark, sf):
    recs = records_of(parse_json_records(json_bodies(spark, sf), "response.results"))
    out = project_schema(recs, [
        Column("order_key", "l_orderkey", "integer"), Column("line_no", "l_linenumber", "integer"),
        Column("quantity", "l_quantity", "float"), Column("price", "l_extendedprice", "float"),
        Column("flag", "l_returnflag", "string"), Column("shipped_at", "l_shipdate", "timestamp"),
    ], keep=())
    return out.withColumn("shipped_at", F.col("shipped_at").cast("timestamp_ntz"))


def odd_json_bodies(spark, sf):
    """Orders whose records a strict parser refuses here and there: a repeated
    key (the last one counts), a NaN, and texts that are broken."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    record = (F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit('{"k": 0, "p": '), price, F.lit(', "k": '), key, F.lit("}")))
              .when(F.col("o_orderkey") % 101 == 0, F.concat(F.lit('{"k": '), key, F.lit(', "p": NaN}')))
              .when(F.col("o_orderkey") % 103 == 0, F.concat(F.lit('{"k": '), key, F.lit(', "p": , "s": "}]\\""}')))
              .otherwise(F.concat(F.lit('{"k": '), key, F.lit(', "p": '), price, F.lit(', "s": "a, ]} \\" b"}'))))
    pages = pages_of(o.select("o_orderkey", record.alias("line")), PAGE, ["o_orderkey"])
    body = F.concat(F.lit('{"n": {"x": [1, 2]}, "rows": ['),
                    F.array_join(F.transform("rows", lambda r: r["line"]), ", "), F.lit(']}'))
    return pages.select(F.col("page").alias("req_idx"), body.alias("body"))


@register("parse_json_bad_records", """
SELECT CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 101 = 0 OR o_orderkey % 103 <> 0 THEN 'record' ELSE 'dead letter' END AS kind,
       CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 101 = 0 OR o_orderkey % 103 <> 0 THEN o_orderkey END AS order_key,
       CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice WHEN o_orderkey % 101 = 0 OR o_orderkey % 103 = 0 THEN NULL
            ELSE o_totalprice END AS price
FROM orders
""")
def q_parse_json_bad_records(spark, sf):
    """A bad record costs only itself: all others of its response come out."""
    parsed = checkpointed(parse_json_records(checkpointed(odd_json_bodies(spark, sf)), "rows"))
    good = project_schema(records_of(parsed), [Column("order_key", "k", "integer"), Column("price", "p", "float")], keep=())
    return good.select(F.lit("record").alias("kind"), "order_key", "price").unionByName(
        dead_letters(parsed).select(F.lit("dead letter").alias("kind"), F.lit(None).cast("bigint").alias("order_key"),
                                    F.lit(None).cast("double").alias("price")))


@register("request_outcomes", """
WITH r AS (SELECT doc_id % 50 AS req_idx, doc_id, lang FROM documents),
flagged AS (SELECT req_idx, doc_id % 7 = 0 AS bad, req_idx % 11 = 3 AS failed FROM r)
SELECT req_idx, CASE WHEN bool_or(failed) THEN 'HTTP 503 from documents' END AS error,
       count(*) FILTER (WHERE NOT failed AND NOT bad) AS n_rows, count(*) FILTER (WHERE NOT failed AND bad) AS n_bad
FROM flagged GROUP BY req_idx
""")
def q_request_outcomes(spark, sf):
    """Good and bad records per request, and requests that failed whole."""
    d = table(spark, sf, "documents")
    record = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit('{"doc_id": "'), F.col("doc_id").cast("string"), F.lit('}'))) \
        .otherwise(F.to_json(F.struct("doc_id", "text")))
    per = d.groupBy((F.col("doc_id") % 50).alias("req_idx")).agg(F.collect_list(record).alias("r"))
    failed = F.col("req_idx") % 11 == 3
    bodies = per.select("req_idx", F.when(~failed, F.concat(F.lit("["), F.array_join("r", ","), F.lit("]"))).alias("body"),
                        F.when(failed, F.lit("HTTP 503 from documents")).alias("error"))
    return request_outcomes(parse_json_records(bodies))


def csv_bodies(spark, sf):
    li = table(spark, sf, "lineitem")
    note = F.concat(F.lit('line "'), F.col("l_linenumber").cast("string"), F.lit('", flag '), F.col("l_returnflag"))
    rows = li.select(F.to_csv(F.struct(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship"), note.alias("note")),
        {"escape": '"', "quoteAll": "false"}).alias("line"))
    pages = pages_of(rows, PAGE, ["line"])
    header = F.lit("l_orderkey,l_linenumber,l_quantity,l_discount,ship,note\n")
    return pages.select(F.col("page").alias("req_idx"),
                        F.concat(header, F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("body"))


@register("parse_csv_records", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_discount END AS l_discount,
       strftime(l_shipdate, '%Y-%m-%d') AS ship,
       'line "' || l_linenumber || '", flag ' || l_returnflag AS note
FROM lineitem
""")
def q_parse_csv_records(spark, sf):
    bodies = checkpointed(csv_bodies(spark, sf))  # landed, as a run lands responses
    # parsed once, read twice: Parquet keeps each field of the variants as a column
    recs = saved(records_of(parse_csv_records(bodies)), "csv-records")
    types = infer_text_types(recs, fields=csv_header_fields(bodies))
    return recs.select(*[F.try_variant_get("record", f"$['{n}']", t).alias(n) for n, t in types])


def csv_layouts(spark, sf):
    """Customers as CSV of two layouts: a blank first line, an empty and a
    repeated header name, cells with line breaks, quotes and commas, records
    with a surplus cell."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    key, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    note = F.concat(F.lit('"'), segment, F.lit(', ""x""\nline '), key, F.lit('"'))
    cells = [key, F.col("c_nationkey").cast("string"), note, segment]
    line = F.when(F.col("c_custkey") % 89 == 0, F.concat_ws(",", *cells, F.lit("surplus"))).otherwise(F.concat_ws(",", *cells))
    pages = pages_of(c.select("c_custkey", line.alias("line")), PAGE, ["c_custkey"])
    head = F.when(F.col("page") % 2 == 0, "\n \nkey,,note,key").otherwise("\ufeffkey,nation,note,segment")
    lines = F.array_join(F.transform("rows", lambda r: r["line"]), "\n")
    body = F.concat(head, F.lit("\n"), lines, F.lit("\n"))
    return pages.select(F.col("page").alias("req_idx"),
                        F.when(F.col("page") % 3 == 0, F.replace(body, F.lit("\n"), F.lit("\r\n"))).otherwise(body).alias("body"))


@register("parse_csv_layouts", """
SELECT CASE WHEN c_custkey % 89 = 0 THEN 'dead letter' ELSE 'record' END AS kind,
       CASE WHEN c_custkey % 89 <> 0 THEN c_custkey END AS custkey,
       CASE WHEN c_custkey % 89 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS nation,
       CASE WHEN c_custkey % 89 <> 0 THEN c_mktsegment || ', "x"' || chr(10) || 'line ' || c_custkey END AS note,
       CASE WHEN c_custkey % 89 <> 0 THEN c_mktsegment END AS segment
FROM customer
""")
def q_parse_csv_layouts(spark, sf):
    parsed = checkpointed(parse_csv_records(checkpointed(csv_layouts(spark, sf))))

    def cell(*names):
        return F.coalesce(*[F.try_variant_get("record", f"$['{n}']", "string") for n in names])

    good = records_of(parsed).select(
        F.lit("record").alias("kind"), cell("key").cast("bigint").alias("custkey"),
        cell("nation", "Unnamed: 1").cast("bigint").alias("nation"), cell("note").alias("note"),
        cell("segment", "key.1").alias("segment"))
    return good.unionByName(dead_letters(parsed).select(F.lit("dead letter").alias("kind")), allowMissingColumns=True)


@register("schema_inferred", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS o_orderdate, o_orderpriority
FROM orders
""")
def q_schema_inferred(spark, sf):
    o = table(spark, sf, "orders")
    recs = checkpointed(o.select(F.parse_json(F.to_json(F.struct(*o.columns))).alias("record")))
    return schema_inferred(recs, keep=())


@register("array_join", """
SELECT doc_id,
       CASE WHEN lang = 'de' THEN text ELSE array_to_string(string_split(text, ' '), '|') END AS words,
       CAST(NULL AS VARCHAR) AS absent
FROM documents
""")
def q_array_join(spark, sf):
    d = table(spark, sf, "documents")
    # German documents send the text itself, the others a list of words.
    body = F.when(F.col("lang") == "de", F.to_json(F.struct(F.col("text").alias("w")))) \
        .otherwise(F.to_json(F.struct(F.split(F.col("text"), " ").alias("w"))))
    recs = d.select("doc_id", F.parse_json(body).alias("record"))
    return project_schema(recs, [Column("words", transform=ArrayJoin("w", "|")),
                                 Column("absent", transform=ArrayJoin("nothing.here", "|"))], keep=("doc_id",))


_R = 6378137.0


@register("crs_reproject", f"""
SELECT c_custkey,
       round(degrees(c_acctbal * 1000 / {_R}), 6) AS lon,
       round(degrees(atan((exp(c_custkey * 1000.0 / {_R}) - exp(-c_custkey * 1000.0 / {_R})) / 2)), 6) AS lat,
       round(radians(c_acctbal / 100) * {_R}, 3) AS mx,
       round(ln(tan(pi() / 4 + radians(c_nationkey * 3.0) / 2)) * {_R}, 3) + 0.0 AS my
FROM customer
""")
def q_crs_reproject(spark, sf):
    c = table(spark, sf, "customer")
    body = F.to_json(F.struct((F.col("c_acctbal") * 1000).alias("X"), (F.col("c_custkey") * 1000).alias("Y"),
                              (F.col("c_acctbal") / 100).cast("string").alias("lon"),
                              (F.col("c_nationkey") * 3).alias("lat")))
    recs = c.select("c_custkey", F.parse_json(body).alias("record"))
    out = project_schema(recs, [
        Column("lon", transform=CrsReproject(("X", "Y"), "EPSG:3857", "EPSG:4326", "x"), type="float"),
        Column("lat", transform=CrsReproject(("X", "Y"), "EPSG:3857", "EPSG:4326", "y"), type="float"),
        Column("mx", transform=CrsReproject(("lon", "lat"), "EPSG:4326", "EPSG:3857", "x"), type="float"),
        Column("my", transform=CrsReproject(("lon", "lat"), "EPSG:4326", "EPSG:3857", "y"), type="float"),
    ], keep=("c_custkey",))
    return out.select("c_custkey", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"),
                      F.round("mx", 3).alias("mx"), F.round("my", 3).alias("my"))


def event_outcomes(spark, sf):
    """Events as responses: one request per hour of the event log; a request
    failed when its first event is an error.  The run is the day."""
    ev = table(spark, sf, "events")
    hour = F.date_trunc("hour", F.col("ts"))
    per = ev.groupBy(hour.alias("hour")).agg(
        F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"),
        F.count(F.lit(1)).alias("n_events"))
    failed = F.col("first_type") == "error"
    return per.select(
        F.to_date("hour").alias("run"),
        F.unix_seconds(F.col("hour").cast("timestamp")).alias("req_idx"),
        F.when(failed, F.lit("HTTP 500 from events")).alias("error"),
        F.when(failed, F.lit(0)).otherwise(F.col("n_events")).alias("n_rows"))


@register("run_summary", """
WITH per AS (
  SELECT date_trunc('hour', ts) AS hour, arg_min(event_type, (ts, event_id)) AS first_type FROM events GROUP BY 1),
o AS (SELECT CAST(hour AS DATE) AS run, first_type = 'error' AS failed FROM per)
SELECT run, count(*) AS n_requests, count(*) FILTER (WHERE failed) AS n_failed,
       CASE WHEN count(*) FILTER (WHERE failed) = count(*) THEN 'FAILED'
            WHEN count(*) FILTER (WHERE failed) > 0 THEN 'complete with errors' ELSE 'complete' END AS status,
       (count(*) FILTER (WHERE failed))::VARCHAR || '/' || count(*)::VARCHAR AS failed_of
FROM o GROUP BY run
""")
def q_run_summary(spark, sf):
    return run_summary(event_outcomes(spark, sf), run="run")


@register("rows_per_request", """
WITH per AS (
  SELECT date_trunc('hour', ts) AS hour, arg_min(event_type, (ts, event_id)) AS first_type FROM events GROUP BY 1)
SELECT CAST(epoch(e.hour) AS BIGINT) AS req_idx, count(*) AS n_rows
FROM (SELECT date_trunc('hour', ts) AS hour FROM events) e JOIN per p ON p.hour = e.hour
WHERE p.first_type <> 'error' GROUP BY 1
""")
def q_rows_per_request(spark, sf):
    ok = event_outcomes(spark, sf).filter(F.col("error").isNull()).select("req_idx")
    ev = table(spark, sf, "events").select(
        F.unix_seconds(F.date_trunc("hour", F.col("ts")).cast("timestamp")).alias("req_idx"))
    return rows_per_request(ev.join(ok, "req_idx", "left_semi"))
