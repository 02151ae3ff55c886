"""A training corpus in five stages over ``documents``.

Each stage calls one operator of ``gleaner.llm`` on all that the stage before
it kept; its result is written as Parquet and read again.  All stages but the
last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.llm.common import find_package, saved
from gleaner.llm.decontaminate import without_leaks
from gleaner.llm.jaccard_join import jaccard_components
from gleaner.llm.mixing import mixed
from gleaner.llm.quality_rules import kept_documents
from gleaner.llm.token_files import read_token_files, write_token_files


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return kept_documents(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays.
    Rows that repeat an id are one document (one row stays); rows with a null
    id link with nothing and stay."""
    groups = saved(jaccard_components(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("component_id").alias("first"), F.count(F.lit(1)).alias("n")), "pipeline-groups")
    gone = groups.where("first <> doc_id").select("doc_id")
    stay = docs.join(gone, "doc_id", "left_anti")
    again = groups.where("first = doc_id AND n > 1").select("doc_id")
    if not again.isEmpty():
        stay = stay.join(again, "doc_id", "left_anti").unionByName(
            stay.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return stay.select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaks go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: none, once or twice."""
    return mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards, and a row per document as read back from them."""
    return read_token_files(write_token_files(docs))


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", jaccard_join),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixing),
          ("token-ID binary output", token_files)]

# Expectation-maximisation, edit distance and the tokenizer are beyond SQL:
# tests/llm holds every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    find_package(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0])
    return docs
