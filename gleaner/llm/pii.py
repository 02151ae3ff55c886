"""Personal data in texts, also behind disguises, with source offsets.

Plain identifiers (email, ip, card, phone) are found first; their spans stay.
Then the text goes through transducers that undo disguises: look-alike and
full-width characters become ASCII, invisible characters vanish, spelled
digits, also among groups of digits, become digits, "(at)" and "[dot]" become signs.  Each rewritten piece
remembers its source span, so what the same detectors find in the normalised
text is mapped back to source offsets.  A found span is added if it holds a
rewritten piece and overlaps no span of its kind found before.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from gleaner.llm.common import documents, map_texts

KINDS = ("email", "ip", "card", "phone")

# --- plain detectors -------------------------------------------------------
# The identifiers' patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Each "@" is tried once with the longest run of local characters before
    it: the leftmost match, in linear time also on long runs."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.groups())]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]


DETECTORS = dict(zip(KINDS, (emails, ips, cards, phones)))


def plain(text: str) -> dict[str, list[tuple[int, int]]]:
    return {kind: find(text) for kind, find in DETECTORS.items()}


# --- transducers -----------------------------------------------------------

# Letters of other scripts that look like ASCII ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "ԁ": "d", "һ": "h", "ո": "n", "ɡ": "g", "ⅼ": "l", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M",
    "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z",
    "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-",
}
_INVISIBLE = "­​‌‍⁠﻿"
# Blocks whose characters are ASCII ones in another form, and decimal digits of other scripts.
_FORMS = "！-～\U0001d400-\U0001d7ff⁰-₉٠-٩۰-۹०-९"
_ODD = re.compile("[" + "".join(map(re.escape, LOOKALIKES)) + _INVISIBLE + _FORMS + "]")

# Spelled digits in the four languages of the tables.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}
_DIGIT = "(?:" + "|".join(sorted(SPELLED, key=len, reverse=True)) + "|[0-9])"
_RUN = re.compile(rf"(?<!\w)(?:(?:plus|\+)[\s-]?\s*)?{_DIGIT}(?:[\s,-]{{1,3}}{_DIGIT}){{6,}}(?!\w)", re.I)
_GROUP = _DIGIT.replace("[0-9]", "[0-9]+")  # also several digits
_MIXED = re.compile(rf"(?<!\w)(?:(?:plus|\+)[\s-]?\s*)?\(?{_GROUP}(?:[\s,()-]{{1,3}}{_GROUP})+(?!\w)", re.I)
_TOKEN = re.compile(r"\+|plus|[0-9]+|[^\W\d_]+", re.I)

_LEAD = r"(?:(?<!\s)\s++)?"  # blanks before, tried once per run of blanks
_WRAP_AT = re.compile(_LEAD + r"[\[({<]\s*(?:at|arroba|@)\s*[\])}>]\s*", re.I)
_WRAPPED = r"[\[({<]\s*(?:dot|punkt|point|punto|\.)\s*[\])}>]\s*"
_WRAP_DOT = re.compile(_LEAD + _WRAPPED, re.I)
_DOT = rf"(?:\s+dot\s+|\s*{_WRAPPED})"
_WORDS_AT = re.compile(  # name at host dot tld, in words; the dots wrapped or not
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(\s+at\s+)[A-Za-z0-9-]+" + rf"(?:(?:{_DOT}|\.)[A-Za-z0-9-]+)*"
    rf"{_DOT}[A-Za-z]{{2,}}", re.I)
_WORD_DOT = re.compile(r"\s+dot\s+", re.I)


def _character(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c.isdecimal():
        return str(unicodedata.decimal(c))
    form = unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and form.isascii() else c


def _edits_characters(text: str):
    return [(m.start(), m.end(), r) for m in _ODD.finditer(text) if (r := _character(m.group())) != m.group()]


def _edits_digits(text: str, pattern=_RUN):
    """Runs of at least seven digits, one of them spelled, become digits."""
    for run in pattern.finditer(text):
        words = _TOKEN.findall(run.group())
        if any(w.lower() in SPELLED for w in words):
            digits = "".join("+" if w.lower() in ("+", "plus") else SPELLED.get(w.lower(), w) for w in words)
            if len(digits.lstrip("+")) >= 7:
                yield run.start(), run.end(), digits


def _edits_mixed(text: str):
    """The same, with digits in groups too."""
    return _edits_digits(text, _MIXED)


def _edits_signs(text: str):
    low = text.lower()
    found = [(m.start(), m.end(), "@") for m in _WRAP_AT.finditer(text)]
    sign = bool(found) or "@" in text
    wrapped = [(m.start(), m.end(), ".") for m in _WRAP_DOT.finditer(text)]
    found += wrapped
    if wrapped or " dot" in low or "\ndot" in low:
        for m in _WORDS_AT.finditer(text):
            sign = True
            found.append((*m.span(1), "@"))
            found += [(d.start(), d.end(), ".") for d in _WORD_DOT.finditer(text, m.end(1), m.end())]
        if sign:  # host part in words after a sign
            for m in re.finditer(r"(?<=[A-Za-z0-9-])\s+dot\s+(?=[A-Za-z]{2,}(?![A-Za-z]))", text):
                found.append((m.start(), m.end(), "."))
    last, out = -1, []
    for e in sorted(set(found)):
        if e[0] >= last:
            out.append(e)
            last = e[1]
    return out


class Normalised:
    """A text after transducers, with the way back to source offsets."""

    def __init__(self, text: str):
        self.text = text
        self.at = [0]  # start of each piece in the normalised text
        self.source = [(0, len(text), False)]  # its source span, and if it was rewritten

    def span(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of normalised [start, end), and if it was touched."""
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        touched = any(self.source[k][2] for k in range(i, j + 1))
        s, e = self.source[i], self.source[j]
        return (s[0] if s[2] else s[0] + start - self.at[i],
                e[1] if e[2] else e[0] + end - self.at[j], touched)

    def apply(self, edits) -> "Normalised":
        edits = sorted(edits)
        if not edits:
            return self
        out, at, source, pos, length = [], [], [], 0, 0

        def put(new: str, start: int, end: int, rewritten: bool):
            nonlocal length
            if not new:
                return
            a, b, touched = self.span(start, end)
            if rewritten or not touched:
                pieces = [(new, a, b, rewritten)]
            else:  # keep earlier pieces apart
                pieces, i = [], start
                while i < end:
                    k = bisect_right(self.at, i) - 1
                    stop = min(end, self.at[k + 1] if k + 1 < len(self.at) else len(self.text))
                    x, y, z = self.span(i, stop)
                    pieces.append((self.text[i:stop], x, y, z))
                    i = stop
            for p, x, y, z in pieces:
                out.append(p)
                at.append(length)
                source.append((x, y, z))
                length += len(p)

        for start, end, new in edits:
            put(self.text[pos:start], pos, start, False)
            put(new, start, end, True)
            pos = end
        put(self.text[pos:], pos, len(self.text), False)
        done = Normalised("".join(out))
        done.at, done.source = at or [0], source or [(0, 0, False)]
        return done


_MAY = re.compile(  # one cheap look: without any of these no transducer has work
    "[" + "".join(map(re.escape, LOOKALIKES)) + _INVISIBLE + _FORMS + "]"
    r"|[\[({<]\s*(?:at|arroba|@|dot|punkt|point|punto|\.)\s*[\])}>]|\sdot\s", re.I)


def normalised(text: str):
    """Yields the text after the transducers: with runs of single digits
    joined, and if there are others, with those of groups of digits."""
    out = Normalised(text)
    for edits in (_edits_characters, _edits_signs):
        out = out.apply(edits(out.text))
    single, mixed = list(_edits_digits(out.text)), list(_edits_mixed(out.text))
    yield out.apply(single)
    if mixed != single:
        yield out.apply(mixed)


def find(text: str):
    """(base spans by kind, added spans by kind) of one text."""
    base = plain(text) if any(c in text for c in "@.+0123456789") else {k: [] for k in KINDS}
    added: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if _MAY.search(text) or next(_edits_mixed(text), None):
        for norm in normalised(text):
            for kind, detect in DETECTORS.items():
                taken = base[kind] + added[kind]
                for a, b in detect(norm.text):
                    start, end, touched = norm.span(a, b)
                    if touched and all(end <= s or e <= start for s, e in taken):
                        added[kind].append((start, end))
                        taken.append((start, end))
    return base, added


def joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    ordered = sorted((s, KINDS.index(k), e) for k, found in spans.items() for s, e in found)
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in ordered)


FIELDS = [*(StructField(f"n_{k}", LongType()) for k in KINDS), StructField("n_added", LongType()),
          StructField("base_sha256", StringType()), StructField("spans", StringType())]


def find_pii(df: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per input row: the columns ``carry`` (default: all but the
    text) with n_email, n_ip, n_card, n_phone (plain ones), n_added (found
    behind disguises), base_sha256 (of the plain spans) and spans (all, as
    kind:start:end in code points, end exclusive).

    A null text counts as empty: no spans.  Repeated rows are treated each.
    An input column named like an output column is replaced.  Time grows with
    the length of a text, not with its square.
    """

    def start():
        def run(texts):
            rows = []
            for t in texts:
                base, added = find((t or b"").decode())
                line = joined(base)
                n_added = sum(map(len, added.values()))
                rows.append((*(len(base[k]) for k in KINDS), n_added, hashlib.sha256(line.encode()).hexdigest(),
                             joined({k: base[k] + added[k] for k in KINDS}) if n_added else line))
            return list(zip(*rows)) if rows else [[] for _ in FIELDS]

        return run

    return map_texts(df, text_col, start, FIELDS, carry)


def op7_pii(spark, sf_dir):
    return find_pii(documents(spark, sf_dir, "doc_id", "text"))
