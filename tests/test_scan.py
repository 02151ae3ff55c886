from pyspark.sql import functions as F

from gleaner.session import new_scratch
from gleaner.sources.scan import read_spread, spread_width

from conftest import rows


def _one_split_file(spark, n):
    path = new_scratch(spark, "scan") + "/t.parquet"
    spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"),
                          F.sha2(F.col("id").cast("string"), 256).alias("pad")) \
        .coalesce(1).write.parquet(path)
    return path


def test_width_rule(spark):
    cores = spark.sparkContext.defaultParallelism
    mb = 1 << 20
    assert spread_width(spark, 1, 10 * mb, mb) == cores      # big, one split: spread
    assert spread_width(spark, 1, 100, mb) == 1              # tiny: left alone
    assert spread_width(spark, 1, 2 * mb, mb) == min(cores, 2)
    assert spread_width(spark, 5000, 1 << 40, mb) == 5000    # many splits (a cluster scan): left alone


def test_spread_scan_keeps_rows_and_pushdown(spark):
    path = _one_split_file(spark, 40_000)
    plain = spark.read.parquet(path)
    assert plain.rdd.getNumPartitions() == 1
    spread = read_spread(spark, path, ["k"], target_bytes=64 << 10)
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    q = spread.filter(F.col("g") == 3).select("k")
    assert rows(q) == rows(plain.filter(F.col("g") == 3).select("k"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(g), EqualTo(g,3)]" in plan
    assert "ReadSchema: struct<k:bigint,g:bigint>" in plan


def test_small_scan_not_spread(spark):
    path = _one_split_file(spark, 10)
    assert read_spread(spark, path, ["k"]).rdd.getNumPartitions() == 1


def test_scan_with_many_splits_is_not_spread(spark):
    from gleaner.session import new_scratch

    path = new_scratch(spark, "scan") + "/many.parquet"
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, 50_000, numPartitions=cores * 2).write.parquet(path)
    df = read_spread(spark, path, ["id"], target_bytes=1)  # bytes alone would ask for spreading
    assert df.rdd.getNumPartitions() >= cores
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
