"""Column functions: path extraction, casts, transforms, missing-value rules."""

from gleaner.functions.casts import cast_text, cast_variant, strict_cast_text
from gleaner.functions.paths import json_path, variant_path
from gleaner.functions.transforms import array_join, crs_reproject, TRANSFORMS

__all__ = [
    "cast_text", "cast_variant", "strict_cast_text", "json_path", "variant_path",
    "array_join", "crs_reproject", "TRANSFORMS",
]
