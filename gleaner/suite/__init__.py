"""Registered queries over the driver tables, each with its DuckDB oracle text.

Every query reads whole tables (or data Spark derives from them); none runs
on fixed literals alone.  ``QUERIES`` maps a name to ``fn(spark, sf_dir)``;
``ORACLE`` maps the same name to SQL DuckDB runs over the same Parquet files.
"""

from gleaner.suite.registry import ORACLE, QUERIES, load_suite

load_suite()

__all__ = ["ORACLE", "QUERIES"]
