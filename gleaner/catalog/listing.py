"""The tables of warehouse roots as a DataFrame, made by Spark jobs.

Version markers are read as a text source, data files are listed by Spark's
own (parallel) file listing, and footers are read in the tasks that hold the
file names: the driver passes a handful of path patterns and loops over no
tables, however many there are.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gleaner.sinks.partitioned import FOLDER
from gleaner.sinks.table import _FS

_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
_TABLES = "namespace string, table string, dir string, location string, layer string, rank int"
_COLUMNS = "array<struct<name: string, type: string>>"


def _pattern(spark: SparkSession, root: str, below: str) -> str | None:
    """The root's pattern where anything matches it."""
    fs, path = _FS(spark, root), f"{root.rstrip('/')}/{below}"
    found = fs.fs.globStatus(fs.p(path))
    return path if found is not None and len(found) else None


def _files(spark: SparkSession, pattern: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .load(pattern).select("path"))  # names alone: no content is read


def _split(df: DataFrame, column: str, pattern: str, names: list[str]) -> DataFrame:
    parts = [F.regexp_extract(column, pattern, i + 1).alias(n) for i, n in enumerate(names)]
    return df.where(F.col(column).rlike(pattern)).select("*", *parts)


def root_tables(spark: SparkSession, root: str, layer: str, rank: int) -> tuple[DataFrame, DataFrame]:
    """(tables, files): the committed tables of a root, and its data files with
    the table and the folder each belongs to."""
    tables = spark.createDataFrame([], _TABLES)
    files = spark.createDataFrame([], "path string, namespace string, table string, dir string, rank int")
    place = r"([^/]+)/([^/]+)"
    if markers := _pattern(spark, root, "*/*/_versions/[0-9]*"):
        marks = spark.read.option("wholetext", "true").text(markers).select(
            F.col("_metadata.file_path").alias("path"), F.trim("value").alias("dir"))
        marks = _split(marks, "path", rf"^(.*)/{place}/_versions/(\d+)$", ["root", "namespace", "table", "version"])
        last = marks.groupBy("namespace", "table").agg(
            F.max_by(F.struct("root", "dir"), F.col("version").cast("bigint")).alias("m"))
        tables = tables.unionByName(last.select("namespace", "table", F.concat(F.lit("data/"), "m.dir").alias("dir"), F.concat_ws(
            "/", "m.root", "namespace", "table", F.lit("data"), "m.dir").alias("location"),
            F.lit(layer).alias("layer"), F.lit(rank).alias("rank")))
        if data := _pattern(spark, root, "*/*/data"):
            found = _split(_files(spark, data), "path", rf"/{place}/(data/[^/]+)/[^/]*$", ["namespace", "table", "dir"])
            files = files.unionByName(found.withColumn("rank", F.lit(rank)))
    if parts := _pattern(spark, root, f"*/*/{FOLDER}"):
        found = _split(_files(spark, parts), "path", rf"^(.*)/{place}/({FOLDER})/[^/]+/[^/]*$", ["root", "namespace", "table", "dir"])
        tables = tables.unionByName(found.select(
            "namespace", "table", "dir", F.concat_ws("/", "root", "namespace", "table", "dir").alias("location"),
            F.lit(layer).alias("layer"), F.lit(rank).alias("rank")).distinct())
        files = files.unionByName(found.drop("root").withColumn("rank", F.lit(rank)))
    return tables, files


def folder_tables(spark: SparkSession, namespace: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """The same of a folder whose ``<table>.parquet`` files or folders are tables."""
    base = _FS(spark, folder)
    top = re.escape(base.fs.makeQualified(base.p(folder.rstrip("/"))).toString().rstrip("/"))
    found = _split(_files(spark, folder), "path", rf"^({top}/([^/]+)\.parquet)(/.*)?$", ["location", "table"])
    rows = found.select(F.lit(namespace).alias("namespace"), "table", F.lit("").alias("dir"), "location",
                        F.lit("local").alias("layer"), F.lit(0).alias("rank"), "path")
    return rows.drop("path").distinct(), rows.select("path", "namespace", "table", "dir", "rank")


def _footer(path: str) -> tuple[int, str | None, str | None]:
    """(rows, columns as JSON, error) of one Parquet file."""
    import pyarrow.fs as afs
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    try:
        fs, name = afs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
        with fs.open_input_file(name) as f:
            meta = pq.read_metadata(f)
        own = (meta.metadata or {}).get(_SPARK_SCHEMA)
        schema = StructType.fromJson(json.loads(own)) if own else from_arrow_schema(meta.schema.to_arrow_schema())
        return meta.num_rows, json.dumps([{"name": c.name, "type": c.dataType.simpleString()} for c in schema.fields]), None
    except Exception as e:  # noqa: BLE001 - listed, not raised
        return 0, None, f"{type(e).__name__}: {e}".splitlines()[0]


def _footers(batches):
    for b in batches:
        got = [_footer(p) for p in b["path"]]
        out = b.drop(columns="path")
        yield out.assign(n=pd.Series([g[0] for g in got], dtype="int64", index=b.index), columns=[g[1] for g in got],
                         error=[g[2] for g in got])


def listing(spark: SparkSession, sources: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """namespace, table, full_name, row_count, columns, location, layer, error.

    Of tables of one name the one of the highest rank is listed.  A table
    that cannot be read, or has no files, has row_count -1 and the error."""
    tables, files = sources[0]
    for t, f in sources[1:]:
        tables, files = tables.unionByName(t), files.unionByName(f)
    visible = tables.groupBy("namespace", "table").agg(F.max_by(F.struct("dir", "location", "layer", "rank"), "rank").alias("t")) \
        .select("namespace", "table", "t.*")
    wanted = files.join(visible.select("namespace", "table", "dir", "rank"), ["namespace", "table", "dir", "rank"], "left_semi")
    footers = wanted.select("namespace", "table", "path").mapInPandas(
        _footers, "namespace string, table string, n bigint, columns string, error string")
    # the file with most columns has all: later batches write every earlier column
    read = footers.groupBy("namespace", "table").agg(
        F.sum("n").alias("n"), F.max_by("columns", F.length("columns")).alias("columns"), F.min("error").alias("error"))
    error = F.when(F.col("n").isNull(), F.lit("the table has no files")).otherwise(F.col("error"))
    return visible.join(read, ["namespace", "table"], "left").withColumn("error", error).select(
        "namespace", "table", F.concat_ws(".", "namespace", "table").alias("full_name"),
        F.when(F.col("error").isNull(), F.col("n")).otherwise(F.lit(-1)).cast("bigint").alias("row_count"),
        F.when(F.col("error").isNull(), F.from_json("columns", _COLUMNS)).otherwise(F.array().cast(_COLUMNS)).alias("columns"),
        "location", "layer", "error").orderBy("namespace", "table")
