"""Response bodies to records.

Input is a DataFrame of bodies ``(req_idx, body STRING[, error STRING])``;
output is one row per record ``(req_idx, pos, record VARIANT, error)``.  A
request whose body cannot be read keeps one row with its ``error``; a
request with no records keeps one row with NULL ``pos`` so it still counts
in run outcomes.  A record that cannot be read costs only itself: it keeps a
row with its ``pos``, its ``error`` and no record.  ``records_of`` gives the
good records, ``dead_letters`` the bad ones.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def _empty() -> Column:
    return F.parse_json(F.lit("[]"))


def _kind(v: Column) -> Column:
    t = F.schema_of_variant(v)
    return (F.when(t.startswith("ARRAY"), F.lit("array"))
            .when(t.startswith("OBJECT"), F.lit("object"))
            .when(t == "STRING", F.lit("string"))
            .when(t == "BOOLEAN", F.lit("boolean"))
            .when(t == "VOID", F.lit("null"))
            .otherwise(F.lit("number")))


def not_followed(records_path: str, key: str, found: str) -> str:
    return (f"records_path '{records_path}' stops at key '{key}': that needs an object, and here is a value of kind "
            f"{found}; omit records_path where the response itself is the list of records")


def _follow(v: Column, records_path: str | None) -> tuple[Column, Column]:
    """(value at records_path, error).  A missing key gives an empty list; a
    step into something that is not an object is an error."""
    from gleaner.functions.paths import variant_path

    err = F.lit(None).cast("string")
    cur = v
    if records_path:
        for key in records_path.split("."):
            # A direct lookup; only when it finds nothing is ``cur`` checked
            # for being an object (a missing key is no records, not an error).
            nxt = F.try_variant_get(cur, variant_path(key), "variant")
            not_obj = F.try_variant_get(cur, "$", "map<string,variant>").isNull()
            before, after = not_followed(records_path, key, "\0").split("\0")
            msg = F.concat(F.lit(before), _kind(cur), F.lit(after))
            err = F.coalesce(err, F.when(nxt.isNull(), F.when(not_obj, msg)))
            cur = F.coalesce(nxt, _empty())
    return cur, err


def parse_json_records(bodies: DataFrame, records_path: str | None = None, body: str = "body") -> DataFrame:
    """JSON bodies: the records at ``records_path`` (default: the whole body),
    an array's elements or one object.

    A body that Spark's strict parser takes is read as one VARIANT.  Any other
    (``NaN``, repeated keys, text that is broken somewhere, above a VARIANT's
    size) is split into the texts of its elements, which are then read one by
    one; only those that are no JSON become dead letters."""
    v = F.try_parse_json(F.col(body))
    prior = F.col("error") if "error" in bodies.columns else F.lit(None).cast("string")
    whole = bodies.select("req_idx", F.col(body).alias("__body"), prior.alias("__prior"), v.alias("__v"))
    odd = F.col("__body").isNotNull() & F.col("__v").isNull() & F.col("__prior").isNull()
    # one pass: a body that was read passes NULL to the splitter, any other its
    # text in pieces, one row each, so that no batch of rows holds whole bodies
    pieces = F.when(odd, F.when(F.length("__body") == 0, F.array("__body"))
                    .otherwise(F.regexp_extract_all("__body", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))
    rows = whole.select("req_idx", "__prior", "__v", F.col("__body").isNull().alias("__none"), pieces.alias("__pieces")) \
        .withColumn("__n", F.size("__pieces")) \
        .select("req_idx", "__prior", "__v", "__none", "__n", F.posexplode_outer("__pieces").alias("__i", "__piece"))
    split = rows.withColumn("__parts", _splitter(records_path)("__piece", F.col("__i") == 0, F.col("__i") + 1 == F.col("__n"))) \
        .filter(F.col("__piece").isNull() | F.col("__parts")["shown"])
    data, path_err = _follow(F.col("__v"), records_path)
    parts = F.col("__parts")
    error = F.coalesce("__prior", F.when(F.col("__v").isNotNull(), path_err), parts["error"])
    arr = F.try_variant_get(data, "$", "array<variant>")
    records = (F.when(error.isNotNull() | F.col("__none"), F.lit(None))
               .when(F.col("__v").isNull(), F.transform(parts["texts"], lambda x: F.try_parse_json(x)))
               .when(F.is_variant_null(data), F.array().cast("array<variant>"))
               .when(arr.isNotNull(), arr)
               .otherwise(F.array(data)))
    staged = split.select("req_idx", error.alias("__error"), records.alias("__recs"), parts["errors"].alias("__bad"),
                          F.coalesce(parts["first"], F.lit(0)).alias("__first"))
    return staged.select("req_idx", "__error", "__bad", "__first", F.posexplode_outer("__recs").alias("pos", "record")).select(
        "req_idx", (F.col("pos") + F.col("__first")).cast("int").alias("pos"), "record",
        F.coalesce("__error", F.get("__bad", "pos"), F.when(
            F.col("__bad").isNotNull() & F.col("pos").isNotNull() & F.col("record").isNull(),
            F.lit("record is too large"))).alias("error"))


#: Characters of a body's text in one row for the splitter; a batch has up to
#: 10,000 rows.
PIECE = 1024

_BLANK = re.compile(r"[ \t\n\r]*")
_MARK = re.compile(r'"(?:[^"\\]++|\\.)*+"|[\[\]{},]', re.DOTALL)
_DECODER = json.JSONDecoder()


class _NotJson(ValueError):
    pass


def _skip(s: str, at: int) -> int:
    return _BLANK.match(s, at).end()


def _value_end(s: str, at: int) -> int:
    """End of a JSON value that starts at ``at``, sound or not: the first comma
    or closing bracket outside its own brackets and texts."""
    depth = 0
    for m in _MARK.finditer(s, at):
        c = m.group()
        if c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            if depth < 0:
                return m.start()
        elif c == "," and depth == 0:
            return m.start()
    return len(s)


def _member(s: str, at: int, key: str) -> int | None:
    """Where the value of a key of the object at ``at`` starts (of repeated
    keys the last one's)."""
    found, at = None, _skip(s, at + 1)
    while at < len(s) and s[at] != "}":
        try:
            name, at = _DECODER.raw_decode(s, at)
        except ValueError as e:
            raise _NotJson from e
        at = _skip(s, at)
        if not isinstance(name, str) or s[at:at + 1] != ":":
            raise _NotJson
        start = _skip(s, at + 1)
        if name == key:
            found = start
        at = _skip(s, _value_end(s, start))
        if s[at:at + 1] == ",":
            at = _skip(s, at + 1)
    return found


def strict_json(value):
    """NaN and infinities as null, which strict JSON has no other word for."""
    if isinstance(value, float):
        return value if value - value == 0 else None
    if isinstance(value, list):
        return [strict_json(x) for x in value]
    if isinstance(value, dict):
        return {k: strict_json(x) for k, x in value.items()}
    return value


def _one(s: str, start: int, stop: int) -> tuple[str | None, str | None]:
    """(strict JSON text, None) of one element, or (None, why not)."""
    text = s[start:stop].strip(" \t\n\r")
    try:
        return json.dumps(strict_json(json.loads(text)), ensure_ascii=False), None
    except (ValueError, RecursionError) as e:
        return None, f"record is not valid JSON ({e}): {text[:200]}"


def split_elements(body: str, records_path: str | None) -> tuple[list, list, str | None]:
    """(texts, errors, error of the whole body): an entry per element."""
    at = _skip(body, 0)
    for key in records_path.split(".") if records_path else ():
        if at is not None and body[at:at + 1] != "{":
            return [], [], not_followed(records_path, key, _kind_of_text(body, at))
        at = _member(body, at, key)
        if at is None:
            at, body = 0, "[]"
    if body[at:at + 1] != "[":
        text, why = _one(body, at, _value_end(body, at) if records_path else len(body))
        if text == "null":
            return [], [], None
        return ([text], [None], None) if text else ([], [], "response is not valid JSON")
    texts, errors, at = _elements(body, at + 1, _value_end)
    if at >= len(body) and (not errors or errors[-1] is None):
        texts.append(None)
        errors.append(_CUT_OFF)
    return texts, errors, None


#: The array never ends: what was cut off is a bad record.
_CUT_OFF = "the response ends inside its records"


def _elements(s: str, at: int, end) -> tuple[list, list, int]:
    """(texts, errors, where the next element or the closing bracket is)."""
    texts, errors, at = [], [], _skip(s, at)
    while at < len(s) and s[at] != "]":
        stop = end(s, at)
        if stop is not None and s[stop:stop + 1] == "}":  # a stray bracket belongs to the broken element
            stop = end(s, stop + 1)
        if stop is None:
            break
        text, why = _one(s, at, stop)
        if why:
            stop = _before_next(s, at, stop)
        texts.append(text)
        errors.append(why)
        at = _skip(s, stop + 1) if s[stop:stop + 1] == "," else stop
    return texts, errors, at


_BORDER = re.compile(r"[}\]][ \t\n\r]*+(,)[ \t\n\r]*+[{\[]")


def _before_next(s: str, at: int, stop: int) -> int:
    """Where the broken element at ``at`` ends: at ``stop``, unless one of its
    texts spans a border of elements, as after a quote that is not closed;
    then at that border."""
    for m in _MARK.finditer(s, at, stop):
        border = _BORDER.search(s, m.start(), m.end()) if m.group()[0] == '"' else None
        if border:
            return border.start(1)
    return stop


def _kind_of_text(s: str, at: int) -> str:
    return {"[": "array", '"': "string", "t": "boolean", "f": "boolean", "n": "null"}.get(s[at:at + 1], "number")


# As _MARK; a text that is still open where the piece ends has no group.
_MARK_SO_FAR = re.compile(r'"(?:[^"\\]++|\\.)*+(?:(")|\\?\Z)|[\[\]{},]', re.DOTALL)


def _end_so_far(s: str, at: int) -> int | None:
    """``_value_end`` where more text may follow; None while the value is open."""
    depth = 0
    for m in _MARK_SO_FAR.finditer(s, at):
        c = s[m.start()]
        if c == '"':
            if m.group(1) is None:
                return None
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            if depth < 0:
                return m.start()
        elif depth == 0:
            return m.start()
    return None


class BodySplitter:
    """``split_elements`` of a body that comes piece by piece.  The elements of
    a body that is one array leave as soon as they end, so that little more
    than one is held; any other body is held whole."""

    def __init__(self, records_path: str | None):
        self.path, self.held, self.size, self.wanted = records_path, [], 0, 0
        self.is_array, self.done, self.why = None, False, None

    def feed(self, piece: str, last: bool) -> tuple[list, list, str | None]:
        if self.done:
            return [], [], None
        self.held.append(piece)
        self.size += len(piece)
        if not last and (self.path or self.is_array is False or self.size < self.wanted):
            return [], [], None
        text, at = "".join(self.held), 0
        if self.is_array is None:
            at = _skip(text, 0)
            if at < len(text):
                self.is_array = text[at] == "[" and not self.path
        if not self.is_array:
            self.held = [text]
            return split_elements(text, self.path) if last else ([], [], None)
        if self.wanted == 0:
            at += 1
        texts, errors, at = _elements(text, at, _value_end if last else _end_so_far)
        self.why = errors[-1] if errors else self.why
        self.done = text[at:at + 1] == "]"
        self.held, self.size = [text[at:]], len(text) - at
        self.wanted = self.size * 3 // 2 + 1  # an open element is read again once it has grown by half
        if last and at >= len(text) and self.why is None:
            texts.append(None)
            errors.append(_CUT_OFF)
        return texts, errors, None


def _splitter(records_path: str | None):
    def run(rows: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        split, n = None, 0
        for pieces, starts, ends in rows:
            out = []
            for piece, start, last in zip(pieces, starts, ends):
                if piece is None:
                    out.append((None, None, None, None, None))
                    continue
                if start:
                    split, n = BodySplitter(records_path), 0
                try:
                    texts, errors, error = split.feed(piece, bool(last))
                except _NotJson:
                    texts, errors, error = [], [], "response is not valid JSON"
                out.append((n, texts, errors, error, bool(texts) or bool(last) and n == 0))
                n += len(texts)
            yield pd.DataFrame(out, columns=["first", "texts", "errors", "error", "shown"])

    # not deterministic: it reads the rows of a body in their order, all of them, once
    return F.pandas_udf(run, "first int, texts array<string>, errors array<string>, error string, shown boolean").asNondeterministic()


def function_records(calls: DataFrame) -> DataFrame:
    """Landed rows of a function source as parsed records."""
    return calls.select("req_idx", "pos", F.try_parse_json("record").alias("record"), "error")


def records_of(parsed: DataFrame) -> DataFrame:
    """Only good records (drops dead letters, and marker rows of requests)."""
    return parsed.filter(F.col("pos").isNotNull() & F.col("error").isNull()).select("req_idx", "pos", "record")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Records that could not be read: (req_idx, pos, error)."""
    return parsed.filter(F.col("pos").isNotNull() & F.col("error").isNotNull()).select("req_idx", "pos", "error")


def request_outcomes(parsed: DataFrame) -> DataFrame:
    """(req_idx, error of the request, n_rows good records, n_bad records)."""
    whole, bad = F.col("pos").isNull(), F.col("error").isNotNull()
    return parsed.groupBy("req_idx").agg(
        F.max(F.when(whole, F.col("error"))).alias("error"),
        F.count(F.when(~whole & ~bad, 1)).alias("n_rows"), F.count(F.when(~whole & bad, 1)).alias("n_bad"))


# --- CSV -------------------------------------------------------------------

# A quoted cell may hold commas, line breaks and doubled quotes.  Possessive
# quantifiers: one pass over the text, no backtracking.
_QUOTED = r'"(?:[^"]++|"")*+"'
_PLAIN = rf"(?:{_QUOTED}[^,\n]*+|[^,\n]*+)"
_RECORD = rf"{_PLAIN}(?:,{_PLAIN})*+"


def _text_of(body: Column) -> Column:
    """The text with one kind of line break and without a byte order mark."""
    body = F.when(body.startswith("\ufeff"), F.substr(body, F.lit(2))).otherwise(body)
    return F.replace(F.replace(body, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def _raw_cells(record: Column, closed: bool = False) -> Column:
    """The cells of one record as they stand in it, quotes included; with
    ``closed`` not those that start with a quote that is never closed."""
    other = '(?!")[^,]*+' if closed else "[^,]*+"
    return F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(rf"(?s),({_QUOTED}[^,]*+|{other})"), F.lit(1))


def _cells(raw: Column) -> Column:
    """Raw cells as text; an empty cell, quoted or not, is NULL."""

    def plain(c: Column) -> Column:
        inner = F.replace(F.regexp_replace(c, rf'(?s)^"((?:[^"]++|"")*+)"([^,]*+)$', "$1$2"), F.lit('""'), F.lit('"'))
        return F.when(c.startswith('"'), F.nullif(inner, F.lit(""))).when(c != "", c)

    return F.transform(raw, plain)


def _names(header: Column) -> Column:
    """Field names: an empty one after its place, a repeated one numbered."""
    raw = F.transform(_cells(_raw_cells(header)), lambda c, i: F.coalesce(c, F.concat(F.lit("Unnamed: "), i.cast("string"))))

    def unique(raw: Column) -> Column:
        def add(done: Column, name: Column) -> Column:
            other = F.filter(F.transform(F.sequence(F.lit(1), F.size(raw)), lambda k: F.concat(name, F.lit("."), k.cast("string"))),
                             lambda n: ~F.array_contains(done, n) & ~F.array_contains(raw, n))
            return F.array_append(done, F.when(F.array_contains(done, name), F.get(other, F.lit(0))).otherwise(name))

        return F.aggregate(raw, F.array().cast("array<string>"), add)

    return F.element_at(F.transform(F.array(raw), unique), 1)


def parse_csv_records(bodies: DataFrame, body: str = "body") -> DataFrame:
    """CSV bodies: the first line that is not blank is the header; an empty
    body has no records; an empty cell is NULL.  Records are VARIANT objects
    of text values; cast them with a declared schema or ``infer_text_types``.

    Quoted cells may hold commas, quotes and line breaks.  An empty header
    name becomes ``Unnamed: <place>``, a repeated one gets a number (``a``,
    ``a.1``).  A record with fewer cells than the header has NULLs for the
    rest; one with more cells, or with a quote that is never closed, is a
    dead letter."""
    prior = F.col("error") if "error" in bodies.columns else F.lit(None).cast("string")
    records = F.filter(F.regexp_extract_all(F.col("__text"), F.lit(rf"({_RECORD})(?:\n|$)"), F.lit(1)),
                       lambda r: F.length(F.trim(r)) > 0)
    staged = bodies.select("req_idx", prior.alias("error"), _text_of(F.col(body)).alias("__text")) \
        .select("req_idx", "error", F.when(F.col("error").isNull(), records).alias("__records"))
    heads = staged.select(
        "req_idx", "error", _names(F.get("__records", F.lit(0))).alias("__names"),
        F.coalesce(F.slice("__records", 2, F.greatest(F.size("__records") - 1, F.lit(0))),
                   F.array().cast("array<string>")).alias("__records"))
    rows = heads.select("req_idx", "error", "__names", F.posexplode_outer("__records").alias("pos", "__record"))
    # The optimizer copies a column's expression into each filter on it, but not past a generator:
    # as the only element of an array, a record is split once however its errors are filtered.
    rows = rows.select("req_idx", "error", "__names", "pos", "__record",
                       F.explode(F.array(_raw_cells(F.col("__record"), closed=True))).alias("__raw"))
    n, width = F.size("__raw"), F.size("__names")
    open_quote = F.array_join("__raw", ",") != F.col("__record")  # a cell is left out
    bad = F.when(open_quote, F.lit("a quote is not closed")).when(
        n > width, F.concat(F.lit("record has "), n.cast("string"), F.lit(" cells, its header "), width.cast("string")))
    names, cells = F.col("__names"), _cells(F.col("__raw"))
    record = F.to_variant_object(F.when(n == width, F.map_from_arrays(names, cells)).otherwise(
        F.map_from_entries(F.arrays_zip(names.alias("k"), cells.alias("v")))))
    return rows.withColumn("__bad", F.when(F.col("pos").isNotNull(), bad)).select(
        "req_idx", F.col("pos").cast("int").alias("pos"),
        F.when(F.col("pos").isNotNull() & F.col("__bad").isNull(), record).alias("record"),
        F.coalesce("error", "__bad").alias("error"))


def csv_header_fields(bodies: DataFrame, body: str = "body") -> list[str]:
    """Field names over all CSV headers, by their first position in any header.

    Header lines are read on the executors; one row per distinct field name
    (as many as the schema has columns) reaches the driver, however many
    bodies or header layouts there are."""
    head = F.regexp_extract(_text_of(F.col(body)), rf"^(?:[ \t]*+\n)*+({_RECORD})(?:\n|$)", 1)
    heads = bodies.select(head.alias("h")).filter(F.length(F.trim("h")) > 0)
    fields = heads.groupBy("h").agg(F.lit(1)).select(F.posexplode(_names(F.col("h"))).alias("i", "name"))
    named = fields.groupBy("name").agg(F.min("i").alias("i")).collect()
    return [r["name"] for r in sorted(named, key=lambda r: (r["i"], r["name"]))]


# The text shapes inference counts as integers and as numbers
# (decimal or exponent form, or the NaN/Infinity words), and as booleans.
_INT_SHAPE = r"^\s*[+-]?\d{1,18}\s*$"
_NUM_SHAPE = r"(?i)^\s*([+-]?((\d+(\.\d*)?)|(\.\d+))(e[+-]?\d+)?|nan|[+-]?inf(inity)?)\s*$"
_BOOL_WORDS = ("true", "false")


def _type_checks(v: Column, name: str) -> list[Column]:
    # Shapes are matched, never cast: a failed text->double cast costs an
    # exception per value, and text columns would fail on every row.
    return [
        F.bool_and(v.isNull() | v.rlike(_INT_SHAPE)).alias(f"{name}\0int"),
        F.bool_and(v.isNull() | v.rlike(_NUM_SHAPE)).alias(f"{name}\0num"),
        F.bool_and(v.isNull() | F.lower(F.trim(v)).isin(*_BOOL_WORDS)).alias(f"{name}\0bool"),
    ]


def _pick(is_int, is_num, is_bool) -> str:
    return "bigint" if is_int else "double" if is_num else "boolean" if is_bool else "string"


def infer_text_types(records: DataFrame, record: str = "record",
                     fields: list[str] | None = None) -> list[tuple[str, str]]:
    """Types of text-valued record fields, as a CSV reader would infer them:
    bigint if every value is an integer, double if every value is a number,
    boolean if every value is true/false, else string.

    With ``fields`` known (CSV headers) it is one global aggregate with
    partial aggregation, no per-field rows; otherwise records are exploded
    into (field, value) rows and grouped by field."""
    if fields is not None:
        if not fields:
            return []
        # each field is extracted once, then checked three ways
        values = records.select(*[F.try_variant_get(F.col(record), "$['" + name.replace("'", "\\'") + "']",
                                                    "string").alias(f"v{i}") for i, name in enumerate(fields)])
        aggs = [a for i in range(len(fields)) for a in _type_checks(F.col(f"v{i}"), str(i))]
        r = values.agg(*aggs).first()
        return sorted((name, _pick(r[f"{i}\0int"], r[f"{i}\0num"], r[f"{i}\0bool"]))
                      for i, name in enumerate(fields))
    kv = records.select(F.explode(F.try_variant_get(F.col(record), "$", "map<string,string>")))
    checks = kv.groupBy("key").agg(*_type_checks(F.col("value"), "x"))
    return sorted((r["key"], _pick(r["x\0int"], r["x\0num"], r["x\0bool"])) for r in checks.collect())
