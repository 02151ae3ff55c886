"""Dot-path extraction from semi-structured records (variant or JSON text)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def variant_path(path: str) -> str:
    """``a.b`` -> ``$['a']['b']``: each dot part is an object key, never an index."""
    if path is None or path == "":
        return "$"
    parts = path.split(".")
    return "$" + "".join("['" + p.replace("\\", "\\\\").replace("'", "\\'") + "']" for p in parts)


def json_path(record: Column | str, path: str, type_: str = "variant") -> Column:
    """Value at a dot path of a VARIANT record; NULL when any step is not an object."""
    rec = F.col(record) if isinstance(record, str) else record
    return F.try_variant_get(rec, variant_path(path), type_)
