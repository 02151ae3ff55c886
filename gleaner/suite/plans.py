"""Request plans whose bounds and categories come from the orders table."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.plans import build_plan, categorical_axis_from, date_range_axis, plan_limit
from gleaner.spec import DateRange, Param
from gleaner.suite.registry import register, table


def _order_span(spark, sf):
    row = table(spark, sf, "orders").agg(F.min("o_orderdate").cast("date").alias("s"),
                                         F.max("o_orderdate").cast("date").alias("e")).first()
    return row["s"], row["e"]


def _two_param_plan(spark, sf, step, window=None):
    s, e = _order_span(spark, sf)
    defs = {"from": Param("from", "date"), "to": Param("to", "date", format="%m/%d/%Y")}
    axis = date_range_axis(DateRange(("from", "to"), s.isoformat(), e.isoformat(), step, window), defs)
    plan = build_plan(spark, [axis])
    return plan.select("req_idx", F.col("params")["from"].alias("date_from"),
                       F.col("params")["to"].alias("date_to"))


_SPAN = "WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders)"


@register("plan_date_range", _SPAN + """,
w AS (SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 7 DAY)) AS ws, e FROM b)
SELECT CAST(row_number() OVER (ORDER BY ws) - 1 AS BIGINT) AS req_idx,
       strftime(ws, '%Y-%m-%d') AS date_from,
       strftime(least(ws + INTERVAL 6 DAY, CAST(e AS TIMESTAMP)), '%m/%d/%Y') AS date_to
FROM w
""")
def q_plan_date_range(spark, sf):
    return _two_param_plan(spark, sf, "7 days")


@register("plan_overlap_windows", _SPAN + """,
w AS (SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 7 DAY)) AS ws, e FROM b)
SELECT CAST(row_number() OVER (ORDER BY ws) - 1 AS BIGINT) AS req_idx,
       strftime(ws, '%Y-%m-%d') AS date_from,
       strftime(least(ws + INTERVAL 9 DAY, CAST(e AS TIMESTAMP)), '%m/%d/%Y') AS date_to
FROM w
""")
def q_plan_overlap_windows(spark, sf):
    return _two_param_plan(spark, sf, "1 week", "10 days")


def _cartesian(spark, sf):
    s, e = _order_span(spark, sf)
    months = date_range_axis(DateRange(("since",), s.isoformat(), e.isoformat(), "1 month"),
                             {"since": Param("since", "date", format="%s")})
    prio = categorical_axis_from(table(spark, sf, "orders"), "o_orderpriority", "priority")
    plan = build_plan(spark, [months, prio])
    return plan.select("req_idx", F.col("params")["since"].alias("since"),
                       F.col("params")["priority"].alias("priority"))


_CARTESIAN_SQL = _SPAN + """,
w AS (SELECT row_number() OVER (ORDER BY ws) - 1 AS i, ws
      FROM (SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 30 DAY)) AS ws FROM b)),
p AS (SELECT row_number() OVER (ORDER BY v) - 1 AS j, v FROM (SELECT DISTINCT o_orderpriority AS v FROM orders)),
n AS (SELECT count(*) AS np FROM p)
SELECT CAST(i * np + j AS BIGINT) AS req_idx, CAST(epoch(ws) AS BIGINT)::VARCHAR AS since, v AS priority
FROM w JOIN p ON true JOIN n ON true
"""


@register("plan_cartesian", _CARTESIAN_SQL)
def q_plan_cartesian(spark, sf):
    return _cartesian(spark, sf)


@register("plan_limit", f"SELECT * FROM ({_CARTESIAN_SQL}) q WHERE req_idx < 25")
def q_plan_limit(spark, sf):
    plan = _cartesian(spark, sf)
    return plan_limit(plan, 25)
