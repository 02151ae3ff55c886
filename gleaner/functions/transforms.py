"""Column transforms a schema column can declare instead of a path."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from gleaner.functions.paths import json_path

# WGS84 / Web-Mercator sphere radius in metres and the CRS
# names accepted for the two systems.
EARTH_RADIUS_M = 6378137.0
_GEOGRAPHIC = {"EPSG:4326", "WGS84", "CRS:84", "OGC:CRS84"}
_MERCATOR = {"EPSG:3857", "EPSG:900913", "EPSG:3785", "EPSG:102100"}


def array_join(record: Column | str, path: str, separator: str = ",", null_text: str = "None") -> Column:
    """Join the array at ``path`` into text.

    NULL or missing -> NULL; ``[]`` -> ''; a scalar -> its own text; null
    elements are written as ``null_text``; booleans and nested values as JSON.
    """
    arr = json_path(record, path, "array<string>")
    return F.coalesce(F.array_join(arr, separator, null_text), json_path(record, path, "string"))


def _crs_kind(name: str) -> str:
    n = name.strip().upper()
    if n in _GEOGRAPHIC:
        return "geographic"
    if n in _MERCATOR:
        return "mercator"
    raise ValueError(f"Unsupported CRS '{name}': only WGS84 (EPSG:4326) and Web Mercator (EPSG:3857)")


def crs_reproject(x: Column | str, y: Column | str, from_crs: str, to_crs: str, component: str) -> Column:
    """One component of an (x, y) pair reprojected between WGS84 and Web Mercator.

    Axis order is always x (lon/easting), y (lat/northing).  Inputs that are
    NULL or do not parse as numbers give NULL.
    """
    xs = (F.col(x) if isinstance(x, str) else x).cast("string").try_cast("double")
    ys = (F.col(y) if isinstance(y, str) else y).cast("string").try_cast("double")
    src, dst = _crs_kind(from_crs), _crs_kind(to_crs)
    if component not in ("x", "y"):
        raise ValueError("component must be 'x' or 'y'")
    if src == dst:
        out_x, out_y = xs, ys
    elif src == "mercator":
        out_x = F.degrees(xs / F.lit(EARTH_RADIUS_M))
        out_y = F.degrees(F.atan(F.sinh(ys / F.lit(EARTH_RADIUS_M))))
    else:
        out_x = F.radians(xs) * F.lit(EARTH_RADIUS_M)
        out_y = F.log(F.tan(F.lit(math.pi / 4) + F.radians(ys) / 2)) * F.lit(EARTH_RADIUS_M)
    out = out_x if component == "x" else out_y
    return F.when(xs.isNotNull() & ys.isNotNull(), out)


def _array_join_t(record: Column, t) -> Column:
    return array_join(record, t.path, t.separator)


def _crs_t(record: Column, t) -> Column:
    fx, fy = t.from_columns
    return crs_reproject(json_path(record, fx, "string"), json_path(record, fy, "string"),
                         t.from_crs, t.to_crs, t.component)


# Transform dispatch: spec class name -> builder(record, transform) -> Column.
TRANSFORMS = {"ArrayJoin": _array_join_t, "CrsReproject": _crs_t}


def apply_transform(record: Column, transform) -> Column:
    builder = TRANSFORMS.get(type(transform).__name__)
    if builder is None:
        raise ValueError(f"Unknown transform type: {type(transform).__name__}")
    return builder(record, transform)
