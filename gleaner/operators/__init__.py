"""Relational operators of a collection run, built from DataFrame primitives."""

from gleaner.operators.asof import asof_join
from gleaner.operators.combine import (anti_join_null_safe, union_by_name, union_family, upsert_bucketed,
                                       upsert_frame)
from gleaner.operators.dedup import dedup_first, dedup_latest_non_null
from gleaner.operators.index import dense_index
from gleaner.operators.project import as_text, infer_columns, project_schema, schema_inferred
from gleaner.operators.summary import rows_per_request, run_summary

__all__ = [
    "asof_join", "dense_index",
    "anti_join_null_safe", "upsert_bucketed", "union_by_name", "union_family", "upsert_frame", "dedup_first",
    "dedup_latest_non_null", "infer_columns", "project_schema", "schema_inferred",
    "rows_per_request", "run_summary", "as_text",
]
