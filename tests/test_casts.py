import datetime as dt
import math

from pyspark.sql import functions as F

from gleaner.functions.casts import cast_text, cast_variant, strict_cast_text
from gleaner.functions.dates import format_date

TEXTS = ["12.9", "1e3", "NaN", "Infinity", "abc", "false", "2024-01-05T10:00:00Z", "1/5/2024", None, " 42 "]


def _cast(spark, type_, **kw):
    df = spark.createDataFrame([(t,) for t in TEXTS], "s string")
    return [r[0] for r in df.select(cast_text(F.col("s"), type_, **kw)).collect()]


def test_integer_truncates_through_double(spark):
    assert _cast(spark, "integer") == [12, 1000, None, None, None, None, None, None, None, 42]


def test_float(spark):
    out = _cast(spark, "float")
    assert out[0] == 12.9 and out[1] == 1000.0 and math.isnan(out[2]) and out[3] == math.inf
    assert out[4] is None and out[8] is None


def test_boolean_and_truthy(spark):
    assert _cast(spark, "boolean")[5] is False
    assert _cast(spark, "boolean")[4] is None
    assert _cast(spark, "boolean", truthy=True)[5] is True  # non-empty text is true


def test_dates_and_timestamps(spark):
    d = _cast(spark, "date")
    assert d[6] == dt.date(2024, 1, 5) and d[7] == dt.date(2024, 1, 5) and d[4] is None
    ts = _cast(spark, "timestamp")
    assert ts[6] == dt.datetime(2024, 1, 5, 10, 0) and ts[7] == dt.datetime(2024, 1, 5)
    assert ts[0] is None  # a number is not a time


def test_variant_numbers_are_not_timestamps(spark):
    df = spark.createDataFrame([('{"t": 1704067200, "n": "17"}',)], "b string").select(F.parse_json("b").alias("r"))
    r = df.select(cast_variant(F.try_variant_get("r", "$.t", "variant"), "timestamp").alias("t"),
                  cast_variant(F.try_variant_get("r", "$.n", "variant"), "integer").alias("n")).first()
    assert r["t"] is None and r["n"] == 17


def test_strict_stream_casts(spark):
    df = spark.createDataFrame([("2024-01-05T10:00:00Z",), ("2024-01-05T10:00:00.5Z",), ("2024-01-05 10:00",),
                                ("2024-01-05",), ("garbage",)], "s string")
    out = df.select(strict_cast_text(F.col("s"), "timestamp").alias("t"),
                    strict_cast_text(F.col("s"), "date").alias("d")).collect()
    assert out[0]["t"] == dt.datetime(2024, 1, 5, 10) and out[1]["t"] == dt.datetime(2024, 1, 5, 10, 0, 0, 500000)
    assert out[2]["t"] is None and out[4]["t"] is None
    assert out[3]["d"] == dt.date(2024, 1, 5) and out[0]["d"] is None


def test_strftime_formats(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 7),)], "d date")
    r = df.select(format_date(F.col("d"), None).alias("iso"), format_date(F.col("d"), "%m/%d/%Y").alias("us"),
                  format_date(F.col("d"), "%s").alias("epoch"), format_date(F.col("d"), "day %j of %Y %%").alias("j")
                  ).first()
    assert (r["iso"], r["us"], r["epoch"], r["j"]) == ("2024-03-07", "03/07/2024", "1709769600", "day 067 of 2024 %")


def test_nineteen_digits_are_exact(spark):
    from gleaner.functions.casts import cast_text

    df = spark.createDataFrame([("1790000000000000001",), ("9223372036854775807",), ("9999999999999999999",)], "s string")
    got = [r[0] for r in df.select(cast_text(F.col("s"), "integer")).collect()]
    assert got == [1790000000000000001, 9223372036854775807, None]


def test_casts_stay_below_what_the_jvm_compiles(spark):
    """HotSpot interprets methods above 8,000 bytes of code."""
    import re

    from gleaner.operators import project_schema
    from gleaner.suite.ingest import LINE_SCHEMA

    recs = spark.range(3).select(F.parse_json(F.concat(F.lit('{"qty": "'), F.col("id").cast("string"), F.lit('"}'))).alias("record"))
    plan = project_schema(recs, LINE_SCHEMA)._jdf.queryExecution()
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(plan, "codegen")
    assert max([int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)], default=0) < 8000


def test_guards_let_every_castable_text_pass(spark):
    texts = ["1", " 1.5e3 ", "-.5", "5.", "1d", "0x1p3", "nan", "+Infinity", "-inf", "\t7\n", "1e400", "T", " yes ", "n", "0", "tru",
             "", ".", "n/a", "1.2.3", "TRUE\t", "off"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    s = F.col("s")
    got = df.select(cast_text(s, "float").cast("string"), s.try_cast("double").cast("string"),
                    cast_text(s, "boolean"), s.try_cast("boolean")).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in got)


def test_times_of_every_shape(spark):
    texts = ["2024-01-05", "2024-1", " 2024-01-05 ", "2024-01-05T10:00:00+0530", "Mon, 5 Jan 2024 10:00:00 GMT", "Friday, January 5, 2024",
             "1/5/2024 3:04 pm", "2024/1/5", "1-5-2024", "20240105", "20240105T101112Z", "Jan 5,2024", "5-Jan-2024", "5 January 2024 7:08",
             "2024", "12:30", "2024-01-05\t", "a, b", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    days = [r[0] for r in df.select(cast_text(F.col("s"), "date")).collect()]
    day = dt.date(2024, 1, 5)
    assert days == [day, dt.date(2024, 1, 1), *[day] * 12, *[None] * 5]
    times = [r[0] for r in df.select(cast_text(F.col("s"), "timestamp")).collect()]
    assert times[3] == dt.datetime(2024, 1, 5, 4, 30) and times[6] == dt.datetime(2024, 1, 5, 15, 4)
    assert [t is None for t in times] == [d is None for d in days]
