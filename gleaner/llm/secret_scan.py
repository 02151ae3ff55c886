"""Secret scans in DataFrame operations only.

Known shapes (assignments of secrets, access keys, long hex strings) are found
by pattern; their spans stay.  Beside them, candidate strings get a sliding
window over their characters: each step adds the entering character's count,
takes the leaving one's away and corrects the sum that Shannon entropy needs,
and the highest entropy of any window is held against the threshold of the
string's character class.  An allow-list suppresses known harmless shapes;
harmless words suppress only themselves, the rest of the string is still held
against the thresholds.

SQL patterns give matches without places.  ``split`` by the same pattern gives
what lies between them, and running sums of both lengths give the offsets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import documents, numbered, quoted
from gleaner.llm.quality_rules import let

# The known shapes.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Character classes: (name, what the whole string must match, least entropy in bits).
CLASSES = (("hex", r"^[0-9a-fA-F]+$", 3.0), ("alphanumeric", r"^[A-Za-z0-9]+$", 3.6), ("base64", r"", 3.8))
# Harmless shapes.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9+/_=-]+$",  # no letter: a number, a date, a rule
    r"^[A-Za-z+/_=-]+$",  # no digit: words, paths
    r"^[0-9]+[-/_][A-Za-z/_-]+$", r"^[A-Za-z/_-]+[-/_=][0-9]+$",  # a numbered name
)
HARMLESS = r"(?i)(?:example|sample|placeholder|changeme)s?|x{6,}"
_LOW, _HIGH = 43, 122  # code points of "+" and "z", the ends of the candidates' characters


def _spans(text: Column, pattern: str, group: int = 0) -> Column:
    """(start, end, value) of each match, in code points."""
    kind = "array<struct<start:bigint,end:bigint,value:string>>"

    def of_matches(m):
        parts = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m))
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else m

        def step(acc, x):
            start = acc["at"] + F.length(x["p"])
            end = start + F.length(x["m"])
            one = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), x["v"].alias("value"))
            return F.struct(end.cast("long").alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        zipped = F.arrays_zip(parts.alias("p"), m.alias("m"), value.alias("v"))
        return F.when(F.size(m) > 0, F.aggregate(
            zipped, F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as {kind})").alias("out")),
            step, lambda acc: acc["out"])).otherwise(F.expr(f"cast(array() as {kind})"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of_matches)


def highest_entropy(s: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy (bits) of any window of a string of
    candidate characters, by incremental counts."""
    size = _HIGH - _LOW + 1

    def term(c):
        return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(0.0)

    def code(i):
        return F.ascii(F.substring(s, i, F.lit(1))) - _LOW

    def step(acc, i):
        def moved(x):
            enter, leave = x["enter"], x["leave"]
            counts = F.transform(acc["counts"], lambda c, k: c + (k == enter).cast("int") - (k == leave).cast("int"))
            more, less = F.get(acc["counts"], enter), F.get(acc["counts"], leave)
            change = F.when(enter == leave, 0.0).otherwise(
                term(more + 1) - term(more) + F.when(leave >= 0, term(less - 1) - term(less)).otherwise(0.0))
            return let(acc["sum"] + change, lambda total: F.struct(
                counts.alias("counts"), total.alias("sum"),
                F.when(i >= window, F.greatest(acc["best"], math.log2(window) - total / window))
                .otherwise(acc["best"]).alias("best")))

        return let(F.struct(code(i).alias("enter"),
                            F.when(i > window, code(i - window)).otherwise(-1).alias("leave")), moved)

    start = F.struct(F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.length(s)), start, step, lambda acc: acc["best"])


def _suspicious(s: Column, allowed) -> Column:
    def allow(x):
        ok = F.lit(False)
        for p in allowed:
            ok = ok | x.rlike(p)
        return ok

    def high(x):
        least = F.lit(None).cast("double")
        for _, whole, bits in reversed(CLASSES):
            least = F.when(x.rlike(whole), bits).otherwise(least)
        return F.when((F.length(x) < WINDOW) | allow(x), False).otherwise(highest_entropy(x) >= least)

    pieces = F.split(s, HARMLESS, -1)  # what stands beside harmless words, without signs at its ends
    pieces = F.when(F.size(pieces) > 1, F.transform(
        pieces, lambda x: F.regexp_replace(x, r"^[+/_=-]+|[+/_=-]+$", ""))).otherwise(pieces)
    return F.when(allow(s), False).otherwise(F.exists(pieces, high))


def scan(df: DataFrame, text_col: str = "text", carry: list[str] | None = None, allowed=ALLOWED) -> DataFrame:
    """One row per row of ``df``: the columns ``carry`` (default: all but the
    text) with n_assign, n_access, n_hex (known shapes), n_entropy (strings
    that only their entropy shows), base_sha256 (of the known spans) and spans
    (all, as kind:start:end in code points, end exclusive).

    A null text counts as empty: no spans.  Repeated rows are scanned each.
    Input columns named like an output column are replaced.  An added span
    never overlaps a known one.  An empty table gives an empty result.
    """
    made = {*(f"n_{k}" for k in KINDS), "base_sha256", "spans"}
    names = [c for c in (df.columns if carry is None else carry)
             if c.lower() not in made and (carry is not None or c != text_col)]
    inner, outer = numbered(names)
    keep = [F.col(f"in{i}") for i in range(len(names))]
    text = F.col("__text")
    src = df.select(*inner, F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("__text"))
    found = src.select(
        *keep,
        F.filter(_spans(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= 8).alias("__assign"),
        F.filter(_spans(text, ACCESS), lambda x: F.length(x["value"]) >= 16).alias("__access"),
        _spans(text, HEX).alias("__hex"),
        F.filter(_spans(text, CANDIDATE), lambda x: _suspicious(x["value"], allowed)).alias("__entropy"))

    def of_kind(spans, j):
        return F.transform(spans, lambda x: F.struct(x["start"].alias("s"), F.lit(j).alias("k"), x["end"].alias("e")))

    found = found.withColumn("__base", F.concat(*(of_kind(F.col(f"__{k}"), j) for j, k in enumerate(KINDS[:3]))))
    added = F.filter("__entropy", lambda x: ~F.exists("__base", lambda y: (y["s"] < x["end"]) & (x["start"] < y["e"])))
    found = found.withColumn("__added", of_kind(added, 3))

    def line(spans):
        return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(
            ":", F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")

    return found.select(
        *outer, *(F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.size("__added").cast("long").alias("n_entropy"),
        F.sha2(line(F.col("__base")), 256).alias("base_sha256"),
        line(F.concat("__base", "__added")).alias("spans"))


def op9_secret_scan(spark, sf_dir):
    return scan(documents(spark, sf_dir, "doc_id", "text"))
