"""The bucketed window SQL (as-of join, moving sum, lag/lead) against its
one-window oracle text in DuckDB, on fixtures with a hot key spanning many
hours and months, NULL values, a NULL customer and same-time events."""

import datetime as dt
import math

import duckdb
import pandas as pd
import pytest

from gleaner.suite import ORACLE
from gleaner.suite.sql_delegated import SPARK_SQL


def _events():
    base = dt.datetime(2024, 1, 1)
    rows, eid = [], 0
    for u, n in ((1, 400), (2, 7), (3, 1)):  # user 1 holds most rows
        for i in range(n):
            eid += 1
            ts = base + dt.timedelta(minutes=37 * i + u)
            kind = ("view", "purchase", "click")[(i * 7 + u) % 3]
            value = None if i % 11 == 0 else round(i * 1.25 + u, 2)
            rows.append((eid, ts, u, kind, value))
    # a view at the very time of a purchase: strictly earlier views only
    rows.append((eid + 1, base + dt.timedelta(minutes=37 * 5 + 1), 1, "view", 999.0))
    rows.append((eid + 2, base + dt.timedelta(minutes=37 * 5 + 1), 1, "purchase", 1.0))
    return rows


def _orders():
    base = dt.datetime(2023, 1, 1)
    rows = []
    for k in range(300):
        cust = None if k % 50 == 0 else (7 if k % 3 else 100 + k % 9)  # customer 7 is hot
        rows.append((k + 1, cust, base + dt.timedelta(days=(k * 13) % 700), round(k * 3.5, 2)))
    return rows


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    return v


def _sorted(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name,table,frame", [
    ("sql_join_range", "events", _events),
    ("sql_window_frame", "events", _events),
    ("sql_window_lag", "orders", _orders),
])
def test_bucketed_windows_equal_one_window_oracle(spark, name, table, frame):
    rows = frame()
    schema = {"events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
              "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_totalprice double"}[table]
    spark.createDataFrame(rows, schema).createOrReplaceTempView(table)
    got = spark.sql(SPARK_SQL[name].format(p=""))
    # nullable pandas dtypes, so None is NULL to DuckDB in every column
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).convert_dtypes()
    con = duckdb.connect()
    con.register(table, pdf)
    res = con.execute(ORACLE[name])
    want = res.fetchall()
    assert len(got.columns) == len(res.description)
    assert _sorted(got.collect()) == _sorted(want)
