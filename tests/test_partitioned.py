import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType,
                               TimestampType)

from gleaner.functions.widening import common_type, fitted, widened
from gleaner.sinks.partitioned import PartitionedTable

from conftest import rows


def _files(table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(table.location()) for f in names if f.endswith(".parquet")}


def test_untouched_partitions_keep_their_files(spark, root):
    t = PartitionedTable(spark, root, "ns", "t")
    assert t.read() is None
    assert t.upsert(spark.range(1000).select("id", F.lit("old").alias("v")), "id", order=(), partitions=16) == 16
    before = _files(t)
    assert t.upsert(spark.createDataFrame([(5, "new"), (1005, "new")], "id bigint, v string"), "id", order=()) <= 2
    after = _files(t)
    assert len(set(before) - set(after)) <= 2
    kept = set(before) & set(after)
    assert len(kept) >= 14 and all(before[f] == after[f] for f in kept)
    assert rows(t.read()) == sorted([(i, "new" if i == 5 else "old") for i in range(1000)] + [(1005, "new")], key=repr)


@pytest.mark.parametrize("bound", [5_000_000, 0])
def test_upserts_equal_a_replay(spark, root, bound):
    rng = random.Random(3)
    t = PartitionedTable(spark, root, "ns", f"replay{bound}")
    state = {}
    for _ in range(4):
        batch = [(rng.choice([None, *range(20)]), rng.choice(["a", None]), q, p, rng.randint(0, 99))
                 for q in range(3) for p in range(8)]
        for k, j, q, p, v in sorted(batch, key=lambda r: (r[2], -r[3])):  # later request wins, then lowest position
            state[k, j] = v
        t.upsert(spark.createDataFrame(batch, "k bigint, j string, req_idx bigint, pos int, v bigint"), ["k", "j"],
                 partitions=5, broadcast_max_keys=bound)
        assert rows(t.read(), "k", "j", "v") == sorted([(k, j, v) for (k, j), v in state.items()], key=repr)
    assert t.upsert(spark.createDataFrame([], "k bigint, j string, req_idx bigint, pos int, v bigint"), ["k", "j"]) == 0


def test_the_stored_side_is_pruned_and_not_shuffled(spark, root):
    from gleaner.operators.combine import upsert_frame
    from gleaner.sinks.partitioned import PART

    t = PartitionedTable(spark, root, "ns", "plan")
    t.upsert(spark.range(500).select("id", F.lit(1).alias("v")), "id", order=(), partitions=8)
    one = t.parts()[0]
    old = t._stored().where(F.col(PART).isin(one))
    merged = upsert_frame(old, old.limit(1), ["id"], deduplicated=True, helper_cols=(), broadcast_keys=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and one in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_batch_written_twice_is_there_once(spark, root):
    t = PartitionedTable(spark, root, "ns", "log")
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id bigint, v string")
    t.append(a, "run-1")
    t.append(a, "run-1")
    t.append(spark.createDataFrame([(2, "y", True)], "id bigint, v string, seen boolean"), "run-2")  # a new column
    t.append(a.limit(0), "run-3")
    t.append(a)
    assert rows(t.read()) == sorted([(1, "x", None)] * 4 + [(2, "y", True)], key=repr)
    with pytest.raises(ValueError):
        t.append(a, "../x")


def test_kinds_of_tables_do_not_mix(spark, root):
    a = spark.createDataFrame([(1, "x")], "id bigint, v string")
    log, keyed = (PartitionedTable(spark, root, "ns", n) for n in ("log2", "keyed2"))
    log.append(a)
    keyed.upsert(a, "id", order=())
    for call in (lambda: log.upsert(a, "id", order=()), lambda: keyed.append(a), lambda: keyed.upsert(a, "v", order=()),
                 lambda: keyed.upsert(a, None)):
        with pytest.raises(ValueError):
            call()


def test_types_that_drift_are_widened(spark, root):
    t = PartitionedTable(spark, root, "ns", "drift")
    t.append(spark.createDataFrame([(1, 5)], "id int, v bigint"), "a")
    t.append(spark.createDataFrame([(2, "five")], "id bigint, v string"), "b")
    t.append(spark.createDataFrame([(3, 7)], "id bigint, v bigint"), "c")
    assert rows(t.read()) == sorted([(1, "5"), (2, "five"), (3, "7")], key=repr)
    assert t.read().dtypes == [("id", "bigint"), ("v", "string")]
    k = PartitionedTable(spark, root, "ns", "drift_key")
    k.upsert(spark.createDataFrame([(1, 1.5), (2, 2.5)], "id bigint, v double"), "id", order=())
    k.upsert(spark.createDataFrame([("2", "n/a"), ("x", "0")], "id string, v string"), "id", order=())
    assert rows(k.read()) == sorted([("1", "1.5"), ("2", "n/a"), ("x", "0")], key=repr)


@pytest.mark.parametrize("a,b,c", [
    (IntegerType(), LongType(), LongType()), (LongType(), DoubleType(), DoubleType()), (FloatType(), LongType(), DoubleType()),
    (LongType(), StringType(), StringType()), (DateType(), TimestampType(), TimestampType()),
    (DateType(), LongType(), StringType()), (DecimalType(10, 2), LongType(), DecimalType(21, 2)),
    (DecimalType(38, 2), LongType(), DecimalType(38, 2)), (DecimalType(38, 10), DecimalType(38, 0), StringType()),
    (DecimalType(10, 2), DoubleType(), DoubleType()),
])
def test_common_types(a, b, c):
    assert common_type(a, b) == common_type(b, a) == c


def test_fitted_columns(spark):
    df = spark.createDataFrame([(1, [1, 2])], "a int, B array<int>")
    schema = widened(df.schema, StructType().add("b", "string").add("c", "date"))
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [("a", "int"), ("B", "string"), ("c", "date")]
    assert rows(fitted(df, schema)) == [(1, "[1,2]", None)]
