"""Staged writes and last-version merges over lineitem joined to orders.

Each line is a record with two date texts: the order date and the ship
date.  Open lines have no ship date yet (written 'NaN', as a frame cast to
text holds it); low-priority orders have no order date; every other ship
date uses the American M/d/yyyy form.  The staging family is one table per
return flag.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import dedup_latest_non_null, union_family
from gleaner.session import new_scratch
from gleaner.sinks.write import family_tables, staged_merge, staged_write
from gleaner.spec import LatestNonNull, Merge, Staging
from gleaner.suite.registry import register, table

STAGING = Staging("flag", "lines_{flag}_staging")
MERGE = Merge("lines_merged", key="l_orderkey", dedup=LatestNonNull(("order_date", "ship_date")))
ORDER = ("req_idx", "pos", "shipped_on", "price")


def line_records(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    ship_text = (F.when(F.col("l_linestatus") == "O", F.lit("NaN"))
                 .when(F.col("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "M/d/yyyy"))
                 .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")))
    order_text = F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd"))
    months = ((F.year("l_shipdate") - 1970) * 12 + F.month("l_shipdate") - 1).cast("bigint")
    return j.select(
        months.alias("req_idx"),
        F.col("l_linenumber").alias("pos"),
        "l_orderkey",
        F.col("l_returnflag").alias("_member"),
        F.col("l_shipdate").alias("shipped_on"),
        F.col("l_extendedprice").alias("price"),
        order_text.alias("order_date"),
        ship_text.alias("ship_date"),
    )


_RECORDS_SQL = """
SELECT (year(l_shipdate) - 1970) * 12 + month(l_shipdate) - 1 AS req_idx, l_linenumber AS pos, l_orderkey,
       l_returnflag AS member, l_shipdate AS shipped_on, l_extendedprice AS price,
       CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
       CASE WHEN l_linestatus = 'O' THEN 'NaN'
            WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%-m/%-d/%Y')
            ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS ship_date,
       CASE WHEN o_orderpriority <> '5-LOW' THEN epoch(o_orderdate) END AS order_epoch,
       CASE WHEN l_linestatus <> 'O' THEN epoch(l_shipdate) END AS ship_epoch
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

_STAGED_SQL = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY member, l_orderkey
                               ORDER BY req_idx DESC, pos, shipped_on, price) AS rn
  FROM ({_RECORDS_SQL}) r) WHERE rn = 1
"""


def _latest_sql(src: str, key_cols: str) -> str:
    # greatest() skips NULLs; present count is 1 per non-missing date.
    return f"""
SELECT * FROM (
  SELECT *, row_number() OVER (
     PARTITION BY l_orderkey
     ORDER BY greatest(order_epoch, ship_epoch) DESC NULLS LAST,
              (CASE WHEN order_epoch IS NULL THEN 0 ELSE 1 END + CASE WHEN ship_epoch IS NULL THEN 0 ELSE 1 END) DESC,
              {key_cols}) AS rn2
  FROM ({src}) s) WHERE rn2 = 1
"""


@register("dedup_latest_non_null", "SELECT l_orderkey, pos AS l_linenumber, member AS l_returnflag, shipped_on, "
          "price, order_date, ship_date FROM (" + _latest_sql(
              _RECORDS_SQL, "pos ASC NULLS LAST, member ASC NULLS LAST, shipped_on ASC NULLS LAST, "
                            "price ASC NULLS LAST") + ") x")
def q_dedup_latest_non_null(spark, sf):
    recs = (line_records(spark, sf).drop("req_idx")
            .withColumnRenamed("pos", "l_linenumber").withColumnRenamed("_member", "l_returnflag"))
    return dedup_latest_non_null(recs, "l_orderkey", ["order_date", "ship_date"])


def _write_family(spark, sf):
    root = new_scratch(spark, "warehouse")
    recs = line_records(spark, sf)
    members = [r[0] for r in recs.select("_member").distinct().orderBy("_member").collect()]
    staged_write(spark, root, "shop", STAGING, recs, "l_orderkey", members, order=ORDER)
    return root


@register("staged_write", "SELECT member AS staging_table, l_orderkey, shipped_on, price, order_date, ship_date "
          "FROM (SELECT * REPLACE ('lines_' || member || '_staging' AS member) FROM (" + _STAGED_SQL + ") s) t")
def q_staged_write(spark, sf):
    root = _write_family(spark, sf)
    frames = [t.read().withColumn("staging_table", F.lit(t.name))
              for t in family_tables(spark, root, "shop", STAGING)]
    return union_family(frames)


@register("union_family", "SELECT l_orderkey, shipped_on, price, order_date, ship_date FROM (" + _STAGED_SQL + ") s")
def q_union_family(spark, sf):
    root = _write_family(spark, sf)
    return union_family([t.read() for t in family_tables(spark, root, "shop", STAGING)])


@register("staged_merge", "SELECT l_orderkey, shipped_on, price, order_date, ship_date FROM (" + _latest_sql(
    _STAGED_SQL, "shipped_on ASC NULLS LAST, price ASC NULLS LAST") + ") x")
def q_staged_merge(spark, sf):
    root = _write_family(spark, sf)
    staged_merge(spark, root, "shop", STAGING, MERGE)
    from gleaner.sinks.table import VersionedTable
    return VersionedTable(spark, root, "shop", MERGE.table).read()
