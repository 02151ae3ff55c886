import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gleaner.operators import anti_join_null_safe, dedup_first, union_by_name, upsert_frame
from gleaner.sinks.table import VersionedTable
from gleaner.sinks.write import append, full_refresh, upsert

from conftest import rows

SCHEMA = "req_idx bigint, pos int, id bigint, v string"


def test_null_keys_and_duplicates(spark):
    existing = spark.createDataFrame([(1, "old1"), (None, "oldnull"), (3, "old3")], "id bigint, v string")
    batch = spark.createDataFrame([(0, 0, 1, "a"), (0, 1, 1, "b"), (0, 2, None, "n1"), (0, 3, None, "n2")], SCHEMA)
    out = upsert_frame(existing, batch, "id")
    assert rows(out, "id", "v") == sorted([(1, "a"), (None, "n1"), (3, "old3")], key=repr)


def test_later_request_wins_and_new_column(spark):
    existing = spark.createDataFrame([(1, "old")], "id bigint, v string")
    batch = spark.createDataFrame([(0, 0, 1, "r0", 10), (1, 0, 1, "r1", 11), (1, 1, 2, "r1b", 12)],
                                  SCHEMA + ", extra int")
    out = upsert_frame(existing, batch, "id")
    assert rows(out, "id", "v", "extra") == [(1, "r1", 11), (2, "r1b", 12)]
    old_only = upsert_frame(spark.createDataFrame([(5, "x")], "id bigint, v string"), batch, "id")
    assert (5, "x", None) in rows(old_only, "id", "v", "extra")


def test_write_strategies(spark, root):
    t = VersionedTable(spark, root, "ns", "t")
    empty = spark.createDataFrame([], SCHEMA)
    assert upsert(t, empty, "id") is None and not t.exists()
    b1 = spark.createDataFrame([(0, 0, 1, "a"), (0, 1, 2, "b")], SCHEMA)
    assert upsert(t, b1, "id") == 1
    b2 = spark.createDataFrame([(0, 0, 2, "B"), (0, 1, 3, "c")], SCHEMA)
    assert upsert(t, b2, "id") == 2
    assert rows(t.read(), "id", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert upsert(t, b2, "id") == 3  # idempotent: twice = once
    assert rows(t.read(), "id", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert t.versions() == [2, 3]  # older versions pruned
    assert append(t, b1) == 3 and t.read().count() == 5
    assert full_refresh(t, empty) is None and t.read().count() == 5  # empty keeps old rows
    assert full_refresh(t, b2) == 4 and rows(t.read(), "id") == [(2,), (3,)]


def _sequential(batches):
    """Reference rule applied request by request: dedup first, replace by key."""
    table = {}
    order = []
    for recs in batches:
        seen = {}
        for k, v in recs:
            seen.setdefault(k, v)
        for k in seen:
            if k in table:
                order.remove(k)
            table[k] = seen[k]
            order.append(k)
    return sorted(table.items(), key=repr)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.text("ab", max_size=2)),
                         max_size=6), min_size=1, max_size=4))
def test_one_job_equals_sequential_replay(spark, batches):
    data = [(i, p, k, v) for i, recs in enumerate(batches) for p, (k, v) in enumerate(recs)]
    batch = spark.createDataFrame(data, SCHEMA)
    out = upsert_frame(None, batch, "id")
    assert rows(out, "id", "v") == _sequential(batches)


def test_plans_stay_hash_based(spark):
    existing = spark.range(1000).select(F.col("id"), F.lit("x").alias("v"))
    batch = spark.range(10).select(F.lit(0).cast("bigint").alias("req_idx"), F.lit(0).alias("pos"),
                                   F.col("id"), F.lit("y").alias("v"))
    anti = anti_join_null_safe(existing, batch, "id")
    text = anti._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    first = dedup_first(batch, "id")
    first.collect()
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert union_by_name(existing, batch.drop("req_idx", "pos")).count() == 1010
    random.seed(0)


def test_append_empty_batch_changes_nothing(spark, root):
    t = VersionedTable(spark, root, "ns", "appended")
    empty = spark.createDataFrame([], SCHEMA)
    assert append(t, empty) is None and not t.exists()  # no table from an empty batch
    b1 = spark.createDataFrame([(0, 0, 1, "a"), (0, 1, 2, "b")], SCHEMA)
    assert append(t, b1) == 1
    assert append(t, empty) is None
    assert append(t, b1) == 1 and rows(t.read(), "id") == [(1,), (1,), (2,), (2,)]
