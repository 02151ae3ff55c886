"""Catalog listing, overlay, SQL front, row cap, models and export."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog import Warehouse
from gleaner.session import new_scratch
from gleaner.sinks.table import VersionedTable
from gleaner.suite.registry import register, table

_CACHE: dict = {}


def warehouse(spark, sf) -> Warehouse:
    """The driver tables as namespace ``tpch`` (one Warehouse per session and folder)."""
    key = (id(spark), sf)
    if key not in _CACHE:
        _CACHE[key] = Warehouse(spark, flat={"tpch": sf})
    return _CACHE[key]


@register("scan_table", """
SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'
""")
def q_scan_table(spark, sf):
    li = warehouse(spark, sf).table("tpch.lineitem")
    return (li.filter((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                      & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_quantity", "l_extendedprice"))


_TABLES = ("benchmark conversations customer documents embeddings events labels lineitem nation orders pages "
           "part region supplier").split()


@register("table_catalog", "\nUNION ALL\n".join(
    f"SELECT 'tpch' AS namespace, '{t}' AS \"table\", 'tpch.{t}' AS full_name, "
    f"(SELECT count(*) FROM {t}) AS row_count, "
    f"(SELECT count(*) FROM (DESCRIBE {t})) AS n_columns, 'local' AS layer" for t in _TABLES))
def q_table_catalog(spark, sf):
    listing = Warehouse(spark, flat={"tpch": sf}).list_tables()
    return listing.select("namespace", "table", "full_name", "row_count",
                          F.size("columns").cast("bigint").alias("n_columns"), "layer")


def _upserted_orders_root(spark, sf):
    from gleaner.suite.ingest import ORDER_UPDATE, RECORD_ORDER, shipment_records
    from gleaner.operators import project_schema
    from gleaner.sinks.write import upsert

    root = new_scratch(spark, "remote")
    t = VersionedTable(spark, root, "tpch", "orders")
    t.replace(table(spark, sf, "orders"))
    upsert(t, project_schema(shipment_records(spark, sf), ORDER_UPDATE), "o_orderkey", order=RECORD_ORDER)
    return root


from gleaner.suite.ingest import _UPSERT_SQL  # noqa: E402


@register("overlay_catalog", "WITH o AS (" + _UPSERT_SQL + """)
SELECT o.o_orderstatus, count(*) AS n_orders, count(o.last_ship) AS n_updated, count(l.l_orderkey) AS n_lines
FROM o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderstatus
""")
def q_overlay_catalog(spark, sf):
    """orders exists in both layers (the remote one is upserted); lineitem only locally."""
    wh = Warehouse(spark, remote_root=_upserted_orders_root(spark, sf), flat={"tpch": sf})
    return wh.query("""
        SELECT o.o_orderstatus, count(*) AS n_orders, count(o.last_ship) AS n_updated,
               count(l.l_orderkey) AS n_lines
        FROM tpch.orders o LEFT JOIN tpch.lineitem l ON l.l_orderkey = o.o_orderkey
        GROUP BY o.o_orderstatus""", cap=0)


@register("sql_query", """
SELECT o_orderpriority, round(avg(o_totalprice), 4) AS avg_price, count(*) AS n
FROM orders GROUP BY 1 ORDER BY 2 DESC
""")
def q_sql_query(spark, sf):
    return warehouse(spark, sf).query("""
        SELECT o_orderpriority, round(avg(o_totalprice), 4) AS avg_price, count(*) AS n
        FROM tpch.orders GROUP BY 1 ORDER BY 2 DESC""")


@register("sql_cap", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_shipdate, l_extendedprice LIMIT 500
""")
def q_sql_cap(spark, sf):
    """No LIMIT in the text: the front caps the read at 500 rows."""
    return warehouse(spark, sf).query("""
        SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM tpch.lineitem
        ORDER BY l_orderkey, l_linenumber, l_shipdate, l_extendedprice""")


@register("sql_limit_kept", """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 700
""")
def q_sql_limit_kept(spark, sf):
    """The statement ends in its own LIMIT 700: no cap on top of it."""
    return warehouse(spark, sf).query("""
        WITH c AS (SELECT c_custkey, c_name, c_acctbal FROM tpch.customer)
        SELECT * FROM c ORDER BY c_acctbal DESC, c_custkey LIMIT 700""")


_MODEL_SQL = """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n_lines
FROM {p}lineitem GROUP BY l_returnflag, l_linestatus
"""


@register("materialize_model", "SELECT l_returnflag, l_linestatus, sum_qty, revenue, n_lines, "
          "sum_qty * 2 AS double_qty FROM (" + _MODEL_SQL.format(p="") + ") m")
def q_materialize_model(spark, sf):
    """A model written as a table, then queried by name like any other table."""
    wh = Warehouse(spark, root=new_scratch(spark, "warehouse"), flat={"tpch": sf})
    res = wh.materialize(_MODEL_SQL.format(p="tpch."), "models", "line_summary")
    assert res["ok"] and res["row_count"] >= 0
    return wh.query("SELECT *, sum_qty * 2 AS double_qty FROM models.line_summary", cap=0)


@register("sql_export", """
SELECT c_nationkey, count(*) AS n_customers, round(sum(c_acctbal), 2) AS total_balance
FROM customer GROUP BY c_nationkey
""")
def q_sql_export(spark, sf):
    """COPY (query) TO 'path' writes Parquet; the export is read back."""
    wh = warehouse(spark, sf)
    path = new_scratch(spark, "export")
    wh.query(f"""COPY (SELECT c_nationkey, count(*) AS n_customers, round(sum(c_acctbal), 2) AS total_balance
                 FROM tpch.customer GROUP BY c_nationkey) TO '{path}' (FORMAT parquet)""")
    return spark.read.parquet(path)
