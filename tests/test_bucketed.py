import glob
import os

import pytest
from pyspark.sql import functions as F

from gleaner.catalog import Warehouse
from gleaner.operators import upsert_frame
from gleaner.sinks.table import BUCKETING_FILE, Bucketing, VersionedTable
from gleaner.sinks.write import append, upsert

from conftest import rows

SCHEMA = "req_idx bigint, pos int, id bigint, v string"

BATCHES = [
    [(0, 0, 1, "a"), (0, 1, 2, "b"), (0, 2, None, "n0"), (1, 0, 7, "g")],
    [(0, 0, 2, "B"), (0, 1, 3, "c"), (0, 2, 2, "dup"), (1, 0, 8, "h")],
    [(0, 0, None, "n1"), (0, 1, 9, "i"), (1, 0, 1, "A")],
    [(0, 0, 4, "d"), (0, 1, 5, "e")],  # no NULL key: the stored NULL-key row stays
]


def _files(t):
    return sorted(glob.glob(os.path.join(t.location().replace("file:", ""), "*.parquet")))


@pytest.mark.parametrize("broadcast_max_keys", [0, 1_000])
def test_bucketed_upserts_equal_plain_ones(spark, root, broadcast_max_keys):
    plain = VersionedTable(spark, root, "ns", f"plain{broadcast_max_keys}")
    bucketed = VersionedTable(spark, root, "ns", f"bucketed{broadcast_max_keys}")
    for data in BATCHES:
        batch = spark.createDataFrame(data, SCHEMA)
        upsert(plain, batch, "id")
        upsert(bucketed, batch, "id", buckets=4, broadcast_max_keys=broadcast_max_keys)
        assert rows(bucketed.read(), "id", "v") == rows(plain.read(), "id", "v")
    assert bucketed.bucketing() == Bucketing(("id",), 4)
    assert len(_files(bucketed)) <= 4  # one file per bucket
    assert os.path.exists(os.path.join(bucketed.location().replace("file:", ""), BUCKETING_FILE))
    # the layout is kept by later upserts that do not name it
    upsert(bucketed, spark.createDataFrame([(0, 0, 6, "f")], SCHEMA), "id")
    assert bucketed.bucketing() == Bucketing(("id",), 4) and len(_files(bucketed)) <= 4


def test_stored_side_is_not_shuffled(spark, root):
    t = VersionedTable(spark, root, "ns", "big")
    stored = spark.range(20_000).select(F.col("id"), F.lit("old").alias("v"))
    t.replace(stored.repartition(8, "id"), bucket_by=Bucketing(("id",), 8))
    batch = spark.range(15_000, 25_000).select(F.col("id"), F.lit("new").alias("v"))
    for broadcast in (False, True):
        merged = upsert_frame(t.read(), batch, "id", helper_cols=(), deduplicated=True,
                              broadcast_keys=broadcast, buckets=8, batch_has_null_key=False)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        # only the batch moves: no exchange of the stored columns, none on null-safe keys
        assert "hashpartitioning(coalesce" not in plan
        assert plan.count("Exchange hashpartitioning") <= 2
        assert merged.count() == 25_000
        assert merged.filter(F.col("v") == "new").count() == 10_000


def test_several_key_columns_with_nulls(spark, root):
    schema = "req_idx bigint, pos int, a bigint, b string, v string"
    data = [[(0, 0, 1, "x", "p"), (0, 1, None, "x", "q"), (0, 2, 1, None, "r"), (0, 3, None, None, "s")],
            [(0, 0, None, "x", "Q"), (0, 1, 2, "y", "t"), (0, 2, None, None, "S")]]
    plain = VersionedTable(spark, root, "ns", "plain2")
    bucketed = VersionedTable(spark, root, "ns", "bucketed2")
    for d in data:
        batch = spark.createDataFrame(d, schema)
        upsert(plain, batch, ["a", "b"])
        upsert(bucketed, batch, ["a", "b"], buckets=3, broadcast_max_keys=0)
    assert rows(bucketed.read(), "a", "b", "v") == rows(plain.read(), "a", "b", "v")
    assert rows(plain.read(), "v") == [("Q",), ("S",), ("p",), ("r",), ("t",)]


def test_append_and_sql_keep_the_layout(spark, root):
    t = VersionedTable(spark, root, "ns", "items")
    upsert(t, spark.createDataFrame(BATCHES[0], SCHEMA), "id", buckets=4)
    append(t, spark.createDataFrame([(0, 0, 42, "z"), (0, 1, 43, "y")], SCHEMA).repartition(3))
    assert t.bucketing() == Bucketing(("id",), 4)
    assert t.read().count() == 6 and len(_files(t)) <= 4
    wh = Warehouse(spark, root=root)
    got = wh.query("SELECT id, count(*) AS n FROM ns.items GROUP BY id", cap=0)
    assert sorted(r["id"] for r in got.collect() if r["id"] is not None) == [1, 2, 7, 42, 43]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
