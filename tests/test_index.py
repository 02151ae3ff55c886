from pyspark.sql import Window, functions as F

from gleaner.operators import dense_index


def test_dense_index_matches_global_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise((F.col("id") * 7919) % 5003).alias("v"))
    df = df.distinct()
    got = dense_index(df, [F.col("v").asc_nulls_first()], "i")
    want = df.select("v", (F.row_number().over(Window.orderBy(F.col("v").asc_nulls_first())) - 1).alias("i"))
    assert got.columns == ["v", "i"]
    assert sorted(got.collect(), key=lambda r: r["i"]) == sorted(want.collect(), key=lambda r: r["i"])
    assert [r["i"] for r in got.orderBy("i").collect()] == list(range(df.count()))


def test_dense_index_empty_and_single(spark):
    empty = spark.createDataFrame([], "v string")
    assert dense_index(empty, [F.col("v")]).count() == 0
    one = spark.createDataFrame([("x",)], "v string")
    assert [tuple(r) for r in dense_index(one, [F.col("v")]).collect()] == [("x", 0)]
