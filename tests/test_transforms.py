import math

import pytest
from pyspark.sql import functions as F

from gleaner.functions.transforms import array_join, crs_reproject


def _join(spark, body, path, sep):
    df = spark.createDataFrame([(body,)], "b string").select(F.parse_json("b").alias("r"))
    return df.select(array_join(F.col("r"), path, sep).alias("x")).first()["x"]


@pytest.mark.parametrize("body,path,sep,expected", [
    ('{"topics":["java","tapestry","web-framework"]}', "topics", ",", "java,tapestry,web-framework"),
    ('{"topics":["a","b","c"]}', "topics", " | ", "a | b | c"),
    ('{"topics":[]}', "topics", ",", ""),
    ('{"topics":null}', "topics", ",", None),
    ("{}", "topics", ",", None),
    ('{"topics":"already-a-string"}', "topics", ",", "already-a-string"),
    ('{"meta":{"tags":["x","y"]}}', "meta.tags", ",", "x,y"),
])
def test_array_join_cases(spark, body, path, sep, expected):
    assert _join(spark, body, path, sep) == expected


def test_array_join_null_elements_and_booleans(spark):
    assert _join(spark, '{"t":["a",null,true]}', "t", ",") == "a,None,true"


def test_crs_roundtrip_and_bad_input(spark):
    df = spark.createDataFrame([("1113194.9079327357", "1118889.9748579594"), ("abc", "1"), (None, "2")],
                               "x string, y string")
    out = df.select(
        crs_reproject("x", "y", "EPSG:3857", "EPSG:4326", "x").alias("lon"),
        crs_reproject("x", "y", "EPSG:3857", "EPSG:4326", "y").alias("lat")).collect()
    assert math.isclose(out[0]["lon"], 10.0, abs_tol=1e-9)
    assert math.isclose(out[0]["lat"], 10.0, abs_tol=1e-9)
    assert out[1]["lon"] is None and out[2]["lat"] is None
    back = spark.createDataFrame([(10.0, 10.0)], "lon double, lat double").select(
        crs_reproject("lon", "lat", "EPSG:4326", "EPSG:3857", "x").alias("x"),
        crs_reproject("lon", "lat", "EPSG:4326", "EPSG:3857", "y").alias("y")).first()
    assert math.isclose(back["x"], 1113194.9079327357, rel_tol=1e-12)
    assert math.isclose(back["y"], 1118889.9748579594, rel_tol=1e-12)


def test_crs_identity_and_unknown(spark):
    df = spark.createDataFrame([(1.5, 2.5)], "x double, y double")
    assert df.select(crs_reproject("x", "y", "EPSG:4326", "WGS84", "y").alias("v")).first()["v"] == 2.5
    with pytest.raises(ValueError):
        crs_reproject("x", "y", "EPSG:2154", "EPSG:4326", "x")
