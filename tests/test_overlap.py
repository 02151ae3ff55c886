import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators.overlap import overlap_join

from conftest import rows


def _side(spark, rng, n, name, keyed):
    data = []
    for i in range(n):
        a = rng.choice([rng.uniform(-50, 50), float(rng.randint(-20, 20))])
        b = a + rng.choice([0.0, 1.0, rng.uniform(0, 3), rng.uniform(0, 400), -1.0])
        data.append((i, rng.choice([1, 2, None]) if keyed else 1, rng.choice([a, a, a, None]), b))
    return spark.createDataFrame(data, f"{name} int, k int, {name}_a double, {name}_b double"), data


@pytest.mark.parametrize("seed,keyed,width", [(1, False, 1.0), (2, True, 4.0), (3, False, 100.0), (4, True, 0.25)])
def test_pairs_equal_all_compared(spark, seed, keyed, width):
    rng = random.Random(seed)
    (x, xs), (y, ys) = _side(spark, rng, 60, "l", keyed), _side(spark, rng, 80, "r", keyed)
    got = overlap_join(x, y, ("l_a", "l_b"), ("r_a", "r_b"), width, ("k",))
    assert got.columns == ["l", "k", "l_a", "l_b", "r", "r_a", "r_b"]
    expected = [(i, j) for i, k, a, b in xs for j, m, c, d in ys
                if k is not None and k == m and None not in (a, c) and a <= b and c <= d and a <= d and c <= b]
    assert rows(got, "l", "r") == sorted(expected, key=repr)  # each once


def test_no_nested_loop_and_bounded_copies(spark):
    x = spark.range(100).select(F.col("id").alias("l"), F.col("id").cast("double").alias("a"), (F.col("id") + 1e9).alias("b"))
    y = spark.range(100).select(F.col("id").alias("r"), F.col("id").cast("double").alias("c"), (F.col("id") + 0.5).alias("d"))
    got = overlap_join(x, y, ("a", "b"), ("c", "d"), 1.0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.count() == sum(1 for i in range(100) for j in range(100) if i <= j + 0.5)
    empty = overlap_join(x.limit(0), y, ("a", "b"), ("c", "d"), 1.0)
    assert empty.count() == 0


def test_times(spark):
    x = spark.sql("SELECT 1 AS l, timestamp'2024-01-01 00:00:00' AS a, timestamp'2024-01-01 00:00:10' AS b")
    y = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2024-01-01 00:00:10', timestamp_ntz'2024-01-02 00:00:00'),"
                  " (2, timestamp_ntz'2024-01-01 00:00:10.000001', timestamp_ntz'2024-01-02 00:00:00') AS t(r, c, d)")
    assert rows(overlap_join(x, y, ("a", "b"), ("c", "d"), 60), "r") == [(1,)]
