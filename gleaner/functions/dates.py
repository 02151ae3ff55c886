"""strftime patterns rendered with Spark date functions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Strftime directive -> Spark datetime pattern.
STRFTIME_TO_SPARK = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm",
    "S": "ss", "f": "SSSSSS", "p": "a", "b": "MMM", "B": "MMMM", "a": "EEE",
    "A": "EEEE", "j": "DDD", "z": "xx", "Z": "z",
}

_DIRECTIVE = re.compile(r"%(.)")


def format_date(d: Column, fmt: str | None) -> Column:
    """Text of a DATE column under a strftime pattern; ISO when none.

    ``%s`` is seconds since the epoch of midnight UTC.
    """
    if not fmt:
        return F.date_format(d, "yyyy-MM-dd")
    pieces: list[Column] = []
    pos = 0
    for m in _DIRECTIVE.finditer(fmt):
        if m.start() > pos:
            pieces.append(F.lit(fmt[pos:m.start()]))
        code = m.group(1)
        if code == "%":
            pieces.append(F.lit("%"))
        elif code == "s":
            pieces.append(F.unix_timestamp(d.cast("timestamp")).cast("string"))
        elif code in STRFTIME_TO_SPARK:
            pieces.append(F.date_format(d, STRFTIME_TO_SPARK[code]))
        else:
            raise ValueError(f"Unsupported strftime directive %{code}")
        pos = m.end()
    if pos < len(fmt):
        pieces.append(F.lit(fmt[pos:]))
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)
