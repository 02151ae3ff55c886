"""Collects the queries and oracle texts of every suite module."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def _in_utc(fn):
    """Run the query with the session in UTC, the zone the engine's epoch
    and instant<->wall-clock conversions are defined in."""
    import functools

    @functools.wraps(fn)
    def run(spark, sf_dir):
        if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return run


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = _in_utc(fn)
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


# The id column of each driver table, the key a scan with few
# splits is spread by (unique or nearly so, hence no hot partition).
ID_COLUMNS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
    "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
    "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id",
    "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id",
    "labels": "doc_id", "conversations": "conv_id",
}


def table(spark, sf_dir: str, name: str):
    """A driver table; spread over the cores when its file has few row groups."""
    from gleaner.sources.scan import read_spread

    key = ID_COLUMNS.get(name)
    return read_spread(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", [key] if key else None)


SUITE_MODULES = ("ingest", "plans", "merge", "warehouse_sql", "sql_delegated", "bodies", "fetching", "runs", "streams")


def load_suite():
    import importlib
    import importlib.util

    for m in SUITE_MODULES:
        if importlib.util.find_spec(f"gleaner.suite.{m}") is not None:
            importlib.import_module(f"gleaner.suite.{m}")
