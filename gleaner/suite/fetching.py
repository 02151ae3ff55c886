"""Calls over the driver tables: the tables' rows are the requests, and a
stand-in for the remote side answers them (no network is used)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gleaner.operators import project_schema
from gleaner.plans import request_params
from gleaner.session import new_scratch
from gleaner.sinks.partitioned import PartitionedTable
from gleaner.sources.fetch import fetch_function, fetch_http, land, register_function
from gleaner.sources.records import (dead_letters, function_records, parse_json_records, records_of,
                                     request_outcomes)
from gleaner.spec import Auth, Column, FunctionSource, HttpSource, Param, RateLimit, ResponseFormat
from gleaner.suite.registry import register, table

URL = "http://customers.test/v1"


def answer(method, url, params, headers, timeout):
    """Answers a request from its params: refuses without the token, does not
    know every 31st key, is overloaded at every 37th, else sends two records."""
    key = int(params["key"])
    if headers.get("Authorization") != "Bearer t0ken":
        return 401, ""
    if key % 31 == 0:
        return 404, "no such key"
    if key % 37 == 0:
        return 429, "slow down"
    rows = [{"id": key * 10 + i, "key": key, "segment": params["segment"], "unit": params["unit"]} for i in range(2)]
    return 200, json.dumps({"data": {"items": rows}}).encode("utf-16" if key % 5 == 0 else "utf-8")


def customer_plan(spark, sf):
    c = table(spark, sf, "customer")
    plan = c.select(F.col("c_custkey").alias("req_idx"), F.create_map(
        F.lit("key"), F.col("c_custkey").cast("string"), F.lit("segment"), F.col("c_mktsegment"),
        F.lit("unit"), F.lit("each")).alias("params"))
    return request_params(plan, static={"unit": "none", "segment": "none"})


SOURCE = HttpSource(URL, auth=Auth("bearer", "t0ken"), response=ResponseFormat("json", "data.items"))


@register("fetch_http", """
SELECT c_custkey AS req_idx,
       CASE WHEN c_custkey % 31 = 0 THEN 404 WHEN c_custkey % 37 = 0 THEN 429 ELSE 200 END AS status,
       CASE WHEN c_custkey % 31 = 0 THEN 'http://customers.test/v1 answered with status 404; The URL may be wrong, or this resource does not exist.'
            WHEN c_custkey % 37 = 0 THEN 'http://customers.test/v1 answered with status 429; Rate limit exceeded. Add a rate_limit block to the collector spec to slow down requests.' END AS error,
       CASE WHEN c_custkey % 31 <> 0 AND c_custkey % 37 <> 0 THEN c_mktsegment END AS segment
FROM customer
""")
def q_fetch_http(spark, sf):
    """One call per customer: status, error with its hint, and the body read."""
    got = fetch_http(customer_plan(spark, sf), SOURCE, answer)
    return got.select("req_idx", "status", "error", F.get_json_object("body", "$.data.items[0].segment").alias("segment"))


@register("fetch_paced", """
SELECT c_nationkey AS nation, count(*) AS n_requests, count(*) FILTER (WHERE c_custkey % 31 = 0 OR c_custkey % 37 = 0) AS n_failed
FROM customer GROUP BY c_nationkey
""")
def q_fetch_paced(spark, sf):
    """The same calls under a rate limit, dealt to tasks by their time slots."""
    plan = customer_plan(spark, sf)
    source = HttpSource(URL, auth=Auth("bearer", "t0ken"), rate_limit=RateLimit(requests=600_000, per_minutes=1))
    got = land(spark, fetch_http(plan, source, answer, concurrency=4))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return got.join(c, got["req_idx"] == c["c_custkey"]).groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("n_requests"), F.count("error").alias("n_failed"))


@register("collector_run", """
SELECT c_custkey * 10 + i AS id, c_custkey AS cust, c_mktsegment AS segment, 'each' AS unit
FROM customer, (VALUES (0), (1)) AS t(i) WHERE c_custkey % 31 <> 0 AND c_custkey % 37 <> 0
""")
def q_collector_run(spark, sf):
    """Plan, fetch, land, parse, project, upsert: twice, as a rerun adds nothing."""
    t = PartitionedTable(spark, new_scratch(spark, "warehouse"), "shop", "items")
    for _ in range(2):
        bodies = land(spark, fetch_http(customer_plan(spark, sf), SOURCE, answer))
        batch = project_schema(records_of(parse_json_records(bodies, SOURCE.response.records_path)), [
            Column("id", "id", "integer"), Column("cust", "key", "integer"), Column("segment", "segment", "string"),
            Column("unit", "unit", "string")])
        t.upsert(batch, "id", partitions=8)
    return t.read()


def shipments(params):
    """A user's function: as many records as the key's last digit; some calls fail."""
    if params["key"] % 50 == 0:
        raise LookupError(f"no supplier {params['key']}")
    for i in range(params["key"] % 10):
        yield {"supplier": params["key"], "i": i, "good": params["good"] is True, "rate": params["balance"] / 2}


_SHIPMENTS_SQL = """
SELECT s_suppkey AS supplier, i, s_acctbal > 0 AS good, s_acctbal / 2 AS rate
FROM supplier, range(0, 10) AS r(i) WHERE s_suppkey % 50 <> 0 AND i < s_suppkey % 10
"""
_SHIPMENT = [Column("supplier", "supplier", "integer"), Column("i", "i", "integer"), Column("good", "good", "boolean"),
             Column("rate", "rate", "float")]


@register("function_source", _SHIPMENTS_SQL)
def q_function_source(spark, sf):
    """A function as a source: typed params, one row per record."""
    s = table(spark, sf, "supplier")
    plan = s.select(F.col("s_suppkey").alias("req_idx"), F.create_map(
        F.lit("key"), F.col("s_suppkey").cast("string"), F.lit("good"), (F.col("s_acctbal") > 0).cast("string"),
        F.lit("balance"), F.col("s_acctbal").cast("string")).alias("params"))
    source = FunctionSource(shipments, params=(Param("key", "integer"), Param("good", "boolean"), Param("balance", "float")))
    return project_schema(records_of(function_records(land(spark, fetch_function(plan, source)))), _SHIPMENT, keep=())


@register("function_in_sql", _SHIPMENTS_SQL + """ UNION ALL SELECT s_suppkey, NULL, NULL, NULL FROM supplier WHERE s_suppkey % 50 = 0""")
def q_function_in_sql(spark, sf):
    """The same function called by SQL, its calls from a table argument; calls
    that failed come out as rows of their own."""
    register_function(spark, "shipments", shipments)
    calls = spark.sql("""
        SELECT * FROM shipments(TABLE(
            SELECT s_suppkey AS req_idx, CAST(s_suppkey AS INT) AS key, s_acctbal > 0 AS good, s_acctbal AS balance
            FROM {supplier}))""", supplier=table(spark, sf, "supplier"))
    calls = land(spark, calls)
    good = project_schema(records_of(function_records(calls)), _SHIPMENT, keep=())
    failed = calls.where("error IS NOT NULL").select(F.col("req_idx").alias("supplier"))
    return good.unionByName(failed, allowMissingColumns=True)


@register("rest_outcomes", """
SELECT CASE WHEN c_custkey % 31 = 0 OR c_custkey % 37 = 0 THEN 'failed' ELSE 'complete' END AS outcome,
       CAST(sum(CASE WHEN c_custkey % 31 = 0 OR c_custkey % 37 = 0 THEN 0 ELSE 2 END) AS BIGINT) AS n_rows, count(*) AS n_requests,
       CAST(0 AS BIGINT) AS n_dead
FROM customer GROUP BY 1
""")
def q_rest_outcomes(spark, sf):
    parsed = parse_json_records(land(spark, fetch_http(customer_plan(spark, sf), SOURCE, answer)), "data.items")
    dead = dead_letters(parsed).groupBy("req_idx").agg(F.count(F.lit(1)).alias("n"))
    return request_outcomes(parsed).join(dead, "req_idx", "left").groupBy(
        F.when(F.col("error").isNotNull(), "failed").otherwise("complete").alias("outcome")).agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_requests"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_dead"))
