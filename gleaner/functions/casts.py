"""Casts of extracted values into declared column types.

Every cast is total: a value that does not fit gives NULL (``try_*``
functions), never an error, with ANSI mode left on.  Integers go through a
double first so '12.9' becomes 12, as a truncating ``int(float(x))`` would.
Dates and timestamps are read from text by its shape, one pattern per shape;
numbers and bare times are none.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

_TIME = r"\d{1,2}:\d{2}(:\d{2})?"
_ZONE = r"(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?)"

# The shapes of text that are dates or timestamps, each read by
# one pattern.  ISO text is read by Spark's own cast.  Nothing else is a time:
# not a plain number (but eight digits, a compact date) and not a bare time.
ISO_SHAPE = rf"^\d{{4}}-\d{{1,2}}(-\d{{1,2}}([T ]{_TIME}(\.\d{{1,9}})? ?{_ZONE}?)?)?$"
# A plain part that every text of a shape holds spares most texts the regex.
TIME_SHAPES = (
    ("/", rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}( {_TIME})?$", "M/d/yyyy[ H:mm[:ss]]"),
    ("/", rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_TIME} ?[AaPp][Mm]$", "M/d/yyyy h:mm[:ss][ ]a"),
    ("/", rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}}( {_TIME})?$", "yyyy/M/d[ H:mm[:ss]]"),
    ("-", rf"^\d{{1,2}}-\d{{1,2}}-\d{{4}}( {_TIME})?$", "M-d-yyyy[ H:mm[:ss]]"),
    ("", r"^\d{8}$", "yyyyMMdd"),
    ("T", r"^\d{8}T\d{6}Z?$", "yyyyMMdd'T'HHmmss[X]"),
    (",", rf"^[A-Za-z]{{3}} \d{{1,2}}, ?\d{{4}}( {_TIME})?$", "MMM d,[ ]yyyy[ H:mm[:ss]]"),
    (",", rf"^[A-Za-z]{{4,9}} \d{{1,2}}, ?\d{{4}}( {_TIME})?$", "MMMM d,[ ]yyyy[ H:mm[:ss]]"),
    ("", rf"^\d{{1,2}}[ -][A-Za-z]{{3}}[ -]\d{{4}}( {_TIME})?( GMT| UTC)?$", "d[ ][-]MMM[ ][-]yyyy[ H:mm[:ss]][ z]"),
    (" ", rf"^\d{{1,2}} [A-Za-z]{{4,9}} \d{{4}}( {_TIME})?( GMT| UTC)?$", "d MMMM yyyy[ H:mm[:ss]][ z]"),
)
_WEEKDAY = r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*, *"

_INT_TEXT = r"^\s*[+-]?\d{1,18}\s*$"
_LONG_TEXT = r"^\s*[+-]?\d{19}\s*$"  # may still be a bigint
# Every text that Spark casts to a number or a boolean has one of these shapes.
_FLOAT_TEXT = (r"(?i)^[\x00-\x20]*+[+-]?((\d++\.?\d*+|\.\d++)(e[+-]?\d++)?[df]?|0x[0-9a-fp.+-]++|nan|inf(inity)?)"
               r"[\x00-\x20]*+$")
_BOOLEAN_TEXT = r"(?i)^[\x00-\x20\x7f]*+(t|true|y|yes|1|f|false|n|no|0)[\x00-\x20\x7f]*+$"

SPARK_TYPES = {
    "string": "string",
    "integer": "bigint",
    "float": "double",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
}


def _coalesce(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def with_value(value: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule(value)`` with ``value`` computed once.  A long chain of cases
    stays out of the generated code that way: the JVM does not compile a
    method above 8,000 bytes of code, it interprets it for every row."""
    return F.element_at(F.transform(F.array(value), rule), 1)


# Pattern letter runs -> the digits they accept.  A fallback pattern is only
# tried on text of its shape: a parse failure costs an exception in Spark.
_SHAPES = {"yyyy": r"\d{4}", "yy": r"\d{2}", "MM": r"\d{2}", "M": r"\d{1,2}", "dd": r"\d{2}",
           "d": r"\d{1,2}", "HH": r"\d{2}", "H": r"\d{1,2}", "mm": r"\d{2}", "ss": r"\d{2}"}


def pattern_shape(fmt: str) -> str | None:
    """Regex of the text a Spark datetime pattern can parse; None if unknown letters."""
    out, i = [], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = fmt[i:j]
        if ch.isalpha():
            if run not in _SHAPES:
                return None
            out.append(_SHAPES[run])
        else:
            out.append(re.escape(run))
        i = j
    return r"^\s*" + "".join(out) + r"\s*$"


def _guarded(s: Column, f: str, parsed: Column) -> Column:
    shape = pattern_shape(f)
    return F.when(s.rlike(shape), parsed) if shape else parsed


def _time_text(s: Column) -> Column:
    """Without blanks around it and a weekday before it."""
    return F.when(F.contains(s, F.lit(",")), F.regexp_replace(F.trim(s), _WEEKDAY, "")).otherwise(F.trim(s))


def _read_iso(text: Column, type_: str) -> Column:
    iso = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2") if type_ == "timestamp" else text
    return iso.try_cast(type_)


def _has(part: str, text: Column, shape: str) -> Column:
    return F.contains(text, F.lit(part)) & text.rlike(shape) if part else text.rlike(shape)


def _read_shape(text: Column, type_: str) -> Column:
    out = F.when(_has("-", text, ISO_SHAPE), _read_iso(text, type_))
    for part, shape, pattern in TIME_SHAPES:
        out = out.when(_has(part, text, shape), F.try_to_timestamp(text, F.lit(pattern)).cast(type_))
    return out


def _read_time(s: Column, formats: tuple[str, ...], type_: str) -> Column:
    """Declared formats first, then the one pattern of the text's shape."""
    out = F.when(s.rlike(ISO_SHAPE), _read_iso(s, type_)) \
        .otherwise(with_value(_time_text(s), lambda text: _read_shape(text, type_)))
    tries = [_guarded(s, f, F.try_to_timestamp(s, F.lit(f)).cast(type_)) for f in formats]
    return _coalesce([*tries, out])


def _read_integer(s: Column) -> Column:
    """Plain integer text is cast exactly; anything else goes through a double
    and is truncated.  The regex guards matter for speed: a failing cast of
    text to a number or a boolean costs an exception per row."""
    return F.when(s.rlike(_INT_TEXT), s.try_cast("bigint")) \
        .otherwise(F.coalesce(F.when(s.rlike(_LONG_TEXT), s.try_cast("bigint")),
                              _read_float(s).try_cast("bigint")))


def _read_float(s: Column) -> Column:
    return F.when(s.rlike(_FLOAT_TEXT), s.try_cast("double"))


def cast_text(s: Column, type_: str | None, formats: tuple[str, ...] = (), truthy: bool = False) -> Column:
    """Cast a STRING column to a declared type."""
    if type_ is None or type_ == "string":
        return s
    if type_ == "integer":
        return with_value(s, _read_integer)
    if type_ == "float":
        return _read_float(s)
    if type_ == "boolean":
        if truthy:  # Python truthiness of text: any non-empty string is true
            return F.when(s.isNull(), F.lit(None).cast("boolean")).otherwise(F.length(s) > 0)
        return F.when(s.rlike(_BOOLEAN_TEXT), s.try_cast("boolean"))
    if type_ in ("date", "timestamp"):
        return with_value(s, lambda t: _read_time(t, tuple(formats), type_))
    raise ValueError(f"Unknown column type: '{type_}'")


def _integer_of(text: Column, v: Column) -> Column:
    """JSON true and false are 1 and 0; the texts "true" and "false" are none."""
    return with_value(text, lambda t: F.when(
        t.isin("true", "false"), F.when(F.schema_of_variant(v) == "BOOLEAN", (t == "true").cast("bigint")))
        .otherwise(_read_integer(t)))


def _time_of(text: Column, v: Column, type_: str, formats: tuple[str, ...]) -> Column:
    """A number is no time, also where its digits look like a compact date."""
    def rule(t: Column) -> Column:
        number = t.rlike(r"^\d{8}$") & (F.schema_of_variant(v) != "STRING")
        return F.when(~number, _read_time(t, tuple(formats), type_))

    return with_value(text, rule)


def cast_variant(v: Column, type_: str | None, formats: tuple[str, ...] = (), truthy: bool = False) -> Column:
    """Cast a VARIANT value to a declared type (``None`` keeps the variant)."""
    if type_ is None:
        return v
    if type_ == "string":  # objects and arrays come out as JSON text
        return F.try_variant_get(v, "$", "string")
    if type_ == "integer":
        return _integer_of(F.try_variant_get(v, "$", "string"), v)
    if type_ == "float":
        return F.try_variant_get(v, "$", "double")
    if type_ == "boolean":
        if truthy:
            return cast_text(F.try_variant_get(v, "$", "string"), "boolean", truthy=True)
        return F.try_variant_get(v, "$", "boolean")
    if type_ in ("date", "timestamp"):
        return _time_of(F.try_variant_get(v, "$", "string"), v, type_, formats)
    raise ValueError(f"Unknown column type: '{type_}'")


def cast_variant_at(record: Column, path: str, type_: str | None, formats: tuple[str, ...] = (),
                    truthy: bool = False) -> Column:
    """``cast_variant`` of the value at ``path``, extracted once, directly as
    the target type where Spark's variant cast already has the right rule."""
    from gleaner.functions.paths import variant_path

    p = variant_path(path)
    if type_ is None:
        return F.try_variant_get(record, p, "variant")
    if type_ == "string":
        return F.try_variant_get(record, p, "string")
    if type_ == "float":
        return F.try_variant_get(record, p, "double")
    if type_ == "boolean" and not truthy:
        return F.try_variant_get(record, p, "boolean")
    text, value = F.try_variant_get(record, p, "string"), F.try_variant_get(record, p, "variant")
    if type_ == "integer":
        return _integer_of(text, value)
    if type_ in ("date", "timestamp"):
        return _time_of(text, value, type_, formats)
    return cast_text(text, type_, formats, truthy)


# Fixed value: the ISO shapes a message stream accepts for timestamps (UTC,
# optional fraction, optional Z) and for dates.
_STRICT_TS = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?Z?$"
_STRICT_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def strict_cast_text(s: Column, type_: str | None) -> Column:
    """Cast rule of message streams: ISO timestamps and dates only."""
    if type_ == "timestamp":
        return F.when(s.rlike(_STRICT_TS), s.try_cast("timestamp"))
    if type_ == "date":
        return F.when(s.rlike(_STRICT_DATE), s.try_cast("date"))
    return cast_text(s, type_)


