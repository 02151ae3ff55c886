"""Projection of semi-structured records into typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleaner.functions.casts import cast_text, cast_variant_at
from gleaner.functions.paths import json_path
from gleaner.functions.transforms import apply_transform
from gleaner.spec import ArrayJoin, Column


def column_expr(record, col: Column, truthy: bool = False):
    """Expression for one declared column of a VARIANT record."""
    if col.transform is not None:
        value = apply_transform(record, col.transform)
        if col.type is None:
            return value
        text = value if isinstance(col.transform, ArrayJoin) else value.cast("string")
        return cast_text(text, col.type, col.formats, truthy)
    return cast_variant_at(record, col.path, col.type, col.formats, truthy)


def project_schema(records: DataFrame, columns, record: str = "record",
                   keep: tuple[str, ...] = ("req_idx", "pos"), truthy: bool = False) -> DataFrame:
    """Keep the declared columns only, renamed and cast; drop every other field.

    ``columns=None`` keeps every field with inferred types (see ``schema_inferred``).
    An empty input keeps the declared columns.
    """
    if columns is None:
        return schema_inferred(records, record, keep)
    rec = F.col(record)
    kept = [c for c in keep if c in records.columns]
    return records.select(*kept, *[column_expr(rec, c, truthy).alias(c.name) for c in columns])


def _inferred_type(type_name: str) -> str:
    t = type_name.upper()
    if t.startswith("DECIMAL"):
        return "double"
    if t == "VOID":
        return "string"
    if t.startswith(("OBJECT", "ARRAY", "VARIANT")):
        return "variant"
    return t.lower()


def infer_columns(records: DataFrame, record: str = "record") -> list[tuple[str, str]]:
    """(field, Spark type) of every top-level field seen in any record.

    One aggregation pass: each record object is exploded into (key, value)
    and ``schema_of_variant_agg`` merges the types per key.  The result is as
    large as the schema, never as the data.
    """
    fields = (records
              .select(F.explode(F.try_variant_get(F.col(record), "$", "map<string,variant>")))
              .groupBy("key")
              .agg(F.expr("schema_of_variant_agg(value)").alias("t")))
    return sorted((r["key"], _inferred_type(r["t"])) for r in fields.collect())


def schema_inferred(records: DataFrame, record: str = "record",
                    keep: tuple[str, ...] = ("req_idx", "pos")) -> DataFrame:
    """Schemaless pass-through: every field, types inferred over all records."""
    cols = infer_columns(records, record)
    rec = F.col(record)
    kept = [c for c in keep if c in records.columns]
    return records.select(*kept, *[json_path(rec, name, t).alias(name) for name, t in cols])


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to STRING (a frame written as text, as some
    warehouses keep staging tables); NULL stays NULL."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
