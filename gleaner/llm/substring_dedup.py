"""Substring dedup by hashing lines or paragraphs, with source offsets.

A text is cut into units.  ``unit="line"``: its lines.  ``unit="paragraph"``:

* its sentences of ``min_words`` words or more, whole, and its lines of so many
  words that are too short to hold a unit of the second kind for sure (under
  2 * min_words - 1 words);
* the whole text cut at words that the content picks: runs of ``min_words``
  words whose hash is the least of ``min_words`` runs in a row (winnowing).
  The words alone pick them, and each ``min_words`` runs hold one: any shared
  stretch of 2 * min_words - 1 words holds a unit in common, wherever it
  stands in its texts, and the picked runs cover it without a gap between the
  first and the last.

Units are normalised (lower case, white space as one blank) and hashed to 128
bits; units under ``min_words`` words are left alone.

Digests are grouped over all texts.  The occurrence of least rank (id, text,
start) stays; each other occurrence is a span to remove, in code points of the
original text.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from gleaner.llm.common import documents, quoted, saved, utf8

MIN_WORDS = 20
_WORD = re.compile(r"\S+")
_LINE = re.compile(r"[^\n]+")
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")


def units(text: str, unit: str = "paragraph", min_words: int = MIN_WORDS):
    """(start, end, digest, words) of each unit, by kind and in order."""
    if unit == "line":
        for m in _LINE.finditer(text):
            words = m.group().lower().split()
            if len(words) >= min_words:
                yield m.start(), m.start() + len(m.group().rstrip()), _digest(words), len(words)
        return
    words = text.lower().split()
    picks = _picked(words, min_words)
    places = [m.span() for m in _WORD.finditer(text)] if picks else []
    taken = {(places[i][0], places[i + min_words - 1][1]) for i in picks}
    for pattern, most in ((_LINE, 2 * min_words - 2), (_SENTENCE, len(words))) if len(words) >= min_words else ():
        for m in pattern.finditer(text):
            own = m.group().lower().split()
            if min_words <= len(own) <= most:
                span = (m.end() - len(m.group().lstrip()), m.start() + len(m.group().rstrip()))
                if span not in taken:
                    taken.add(span)
                    yield *span, _digest(own), len(own)
    for i in picks:
        yield places[i][0], places[i + min_words - 1][1], _digest(words[i:i + min_words]), min_words


def _folded(values: np.ndarray, size: int, fold) -> np.ndarray:
    """``fold`` of each ``size`` values in a row; fold(a, b, n) joins what
    stands for n values and what stands for the next ones."""
    out, done, power, n = None, 0, values, 1
    while True:
        if size & n:
            out = power.copy() if out is None else fold(out[:len(power) - done], power[done:], done)
            done += n
        if 2 * n > size:
            return out[:len(values) - size + 1]
        power = fold(power[:-n], power[n:], n)
        n *= 2


def _picked(words: list[str], size: int) -> list[int]:
    """Where the picked runs of ``size`` words start, in order."""
    if len(words) < size:
        return []
    hashes = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
    base = 0x9E3779B97F4A7C15
    runs = _folded(hashes, size, lambda a, b, n: a * np.uint64(pow(base, n, 1 << 64)) + b[:len(a)])
    runs = (runs ^ (runs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    if len(runs) < size:  # no stretch that must hold one, but a short text's own least
        return [int(runs.argmin())]
    least = _folded(runs, size, lambda a, b, n: np.minimum(a, b[:len(a)]))
    if len(np.unique(runs)) == len(runs):
        starts = np.lib.stride_tricks.sliding_window_view(runs, size).argmin(axis=1) + np.arange(len(least))
        return np.unique(starts).tolist()
    # equal runs: one stays picked as long as it is in reach and least
    values, out = runs.tolist(), []
    for j, low in enumerate(least.tolist()):
        if not out or out[-1] < j or values[out[-1]] != low:
            out.append(max(i for i in range(j, j + size) if values[i] == low))
    return out


def _digest(words: list[str]) -> int:
    return xxhash.xxh3_128_intdigest(" ".join(words).encode())


def repeated_spans(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", unit: str = "paragraph",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """A row per unit that repeats an earlier one: doc_id, start, end (code
    points, end exclusive), n_words, and the occurrence that stays, keep_doc_id
    and keep_start.  Where a unit overlaps the occurrence that stays, the span
    starts behind that.

    Null, empty and blank texts have no units.  Rows with a null id rank last
    (null after all ids).  Rows that repeat id and text are one document: their
    units have equal rank, and the first ones stay in each; rows of one id
    with different texts are documents each.  Other columns are ignored.  An
    empty table gives an empty result.
    """
    return _repeats(df, text_col, id_col, unit, min_words).drop("t")


def _repeats(df: DataFrame, text_col: str, id_col: str, unit: str, min_words: int) -> DataFrame:
    """``repeated_spans`` with ``t``, a hash of the row's whole text."""
    src = df.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            rows, starts, ends, high, low, words, texts = [], [], [], [], [], [], []
            for i, t in enumerate(utf8(b.column(1))):
                texts.append(text_hash(t))
                for start, end, digest, n in units((t or b"").decode(), unit, min_words):
                    rows.append(i)
                    starts.append(start)
                    ends.append(end)
                    high.append(digest >> 64)
                    low.append(digest & (1 << 64) - 1)
                    words.append(n)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), pa.array(texts, pa.int64()).take(at),
                 *(pa.array(np.array(c, np.uint64).view(np.int64)) for c in (high, low)),
                 *(pa.array(c, pa.int32()) for c in (starts, ends, words))],
                names=["doc_id", "t", "h", "l", "start", "end", "n_words"])

    found = saved(src.mapInArrow(run, "doc_id long, t long, h long, l long, start int, end int, n_words int"), "dedup-units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t", "start", "end")
    # written, so that the join reads two plain shuffles: a very common unit's
    # rows, which the partial aggregates folded before, can then be split there
    first = saved(found.groupBy("h", "l").agg(F.min(rank).alias("keep"), F.max(rank).alias("far"))
                  .where("keep.last <> far.last OR NOT keep.doc_id <=> far.doc_id OR keep.t <> far.t OR keep.start <> far.start")
                  .select("h", "l", "keep"), "dedup-first")
    same = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("t") == F.col("keep.t"))
    start = F.when(same, F.greatest("start", "keep.end")).otherwise(F.col("start"))
    return (found.join(first, ["h", "l"]).where(~(same & (F.col("start") == F.col("keep.start"))))
            .select("doc_id", "t", start.cast("long").alias("start"), F.col("end").cast("long").alias("end"),
                    F.col("n_words").cast("long").alias("n_words"),
                    F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.start").cast("long").alias("keep_start"))
            .where("start < end"))


def text_hash(text: bytes | None) -> int:
    return xxhash.xxh3_64_intdigest(text or b"") - (1 << 63)


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Their union, as spans that neither meet nor overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def without_repeats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", unit: str = "paragraph",
                    min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``df`` with the repeated spans cut out of their text, and
    ``removed``: the merged spans, as offsets of the original text.  An input
    column named removed is replaced.  Rows with a null id, and null texts,
    stay as they are; repeats of an empty table are empty."""
    spans = (_repeats(df, text_col, id_col, unit, min_words).where("doc_id IS NOT NULL").groupBy("doc_id", "t")
             .agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    names = [c for c in df.columns if c.lower() != "removed"]
    row = df.select(F.struct(*[F.col(quoted(c)) for c in names]).alias("row"), F.col(quoted(id_col)).cast("long").alias("doc_id"),
                    F.col(quoted(text_col)).cast("string").alias("text"))
    schema = StructType([*row.schema.fields[:1], StructField("t", LongType()), *row.schema.fields[1:]])

    def hashed(batches):
        for b in batches:
            t = pa.array([text_hash(x) for x in utf8(b.column(2))], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), t, b.column(1), b.column(2)], names=["row", "t", "doc_id", "text"])

    def cut(batches):
        for b in batches:
            texts, removed = [], []
            for text, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                gone = merged_spans([(s["start"], s["end"]) for s in found or ()])
                edges = [0, *(x for s in gone for x in s), None]
                texts.append(text if not gone else "".join(text[i:j] for i, j in zip(edges[::2], edges[1::2])))
                removed.append([{"start": i, "end": j} for i, j in gone])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(removed, kind)],
                                             names=["row", "text", "removed"])

    joined = row.mapInArrow(hashed, schema).join(spans, ["doc_id", "t"], "left").select("row", "text", "spans")
    out = joined.mapInArrow(cut, StructType([
        *row.schema.fields[:1], StructField("text", StringType()),
        StructField("removed", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())])))]))
    return out.select(*[(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in names], "removed")


def op6_substring_dedup(spark, sf_dir):
    return repeated_spans(documents(spark, sf_dir, "doc_id", "text"))
