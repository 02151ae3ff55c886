"""Token ids in binary shard files: patched frame-of-reference blocks.

Writing.  Rows are range-partitioned and sorted by id; each task tokenizes its
documents and writes shard files of about ``SHARD_IDS`` ids (whole documents)
into the shared folder.  A shard file is little-endian:

    magic "GTPF", u32 version, u64 documents, u64 ids, u64 blocks
    documents x i64   document id (0 where null)
    documents x u8    1 if the id is null
    documents x u64   ids of the document
    blocks x u64      start of the block in the payload
    blocks x u32      block minimum
    blocks x u8       bit width
    blocks x u8       number of exceptions
    payload           per block: 128 x width bits, then per exception its
                      position (u8), then per exception its value (u32)

A block holds 128 ids less the block minimum.  The width is the bit length
that ``PERCENTILE`` of its values need; larger values keep their low bits in
the packed part and their whole value in the exception list.  The last block
is filled up with its minimum.

Each attempt of a task writes files of its own names; only those named in the
manifest (the rows that Spark commits) count, so a lost executor or a second
attempt leaves at most unread files.

Reading.  The manifest is dealt over the cluster; each task reads its shard
files, unpacks block after block and yields one row per document.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gleaner.llm.common import Recent, documents, partitions, quoted, releasing, saved, small_batches, utf8
from gleaner.session import new_scratch

MAGIC, VERSION = b"GTPF", 1
BLOCK = 128
PERCENTILE = 0.9
SHARD_IDS = 1_000_000
END_ID = 2
CACHE_WORDS = 300_000  # words in each of a Python worker's two cache generations
LATIN_END = 0x250  # code points below are Latin letters of long-settled properties
CACHE_BYTES = 64  # longer words are encoded, not held
_HEAD = struct.Struct("<4sIQQQ")


# --- tokenizing ------------------------------------------------------------

def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _leaves_lower_case(tokenizer) -> bool:
    """Whether the normalizer only composes, folds white space and lower-cases."""
    own = json.loads(tokenizer.to_str()).get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = own["normalizers"] if own["type"] == "Sequence" else [own]
    return all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} for x in steps)


class Encoder:
    """Ids of a text as little-endian u32 bytes, with the tokenizers library.

    For a tokenizer that drops white space (asked of it by a probe), a text's
    ids are its words' ids one after the other.  Known words come from a
    bounded cache; a new word goes through the tokenizer's own normalizer,
    pre-tokenizer and model.  Other tokenizers get the whole text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        self.tokenize = t.model.tokenize
        self.cache = Recent(CACHE_WORDS)
        self.special = [x.content for x in t.get_added_tokens_decoder().values()]
        self.first = sorted({x[0] for x in self.special if x})
        cut = t.pre_tokenizer.pre_tokenize_str if t.pre_tokenizer else (lambda x: [(x, None)])
        self.cut = cut
        self.normal = t.normalizer.normalize_str if t.normalizer else str
        self.by_words = not any(c.isspace() for c in "".join(self.special)) and [
            p for p, _ in cut(self.normal(" a \n b\t"))] == [p for x in "ab" for p, _ in cut(self.normal(x))]
        self.signs = self.by_words and all(
            [p for p, _ in cut(self.normal("a" + x))] == [p for y in ("a", x) for p, _ in cut(self.normal(y))]
            for x in ",.")
        self.folds = self.by_words and self.normal("AZ") == "az"
        letters = "abcdefghijklmnopqrstuvwxyz"
        self.letters = self.by_words and [p for p, _ in cut(self.normal(letters))] == [letters]
        # Latin letters with marks, where the normalizer is known to leave composed lower-case text alone
        latin = "".join(c for c in map(chr, range(0x80, LATIN_END)) if c.isalpha() and c.lower() == c and is_normalized("NFC", c))
        # and the pre-tokenizer keeps a word of them in one piece, letter by letter
        self.pieces = {ord(c): "".join(p for p, _ in cut(c)) for c in latin}
        self.latin = self.letters and _leaves_lower_case(t) and [p for p, _ in cut(latin)] == [latin.translate(self.pieces)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        if self.signs and word[-1] in b".,":  # a lone sign after a letter is a piece of its own
            core = word[:-1]
            last = core.decode()[-1:]
            if last.isascii() and last.isalpha():
                return self.word(core) + self.word(word[-1:])
        text = word.decode()
        if any(c in text for c in self.first) and any(s in text for s in self.special):
            return self._whole(text)
        if self.letters and text.isalpha():  # one piece as it is
            if text.isascii():
                if text.islower():
                    return pack_ids([x.id for x in self.tokenize(text)])
            elif self.latin and text == text.lower() and max(text) < chr(LATIN_END) and is_normalized("NFC", text):
                return pack_ids([x.id for x in self.tokenize(text.translate(self.pieces))])
        return pack_ids([x.id for p, _ in self.cut(self.normal(text)) for x in self.tokenize(p)])

    def word(self, word: bytes) -> bytes:
        ids = self.cache.get(word)
        if ids is None:
            ids = self._word(word)
            if len(word) <= CACHE_BYTES:
                self.cache.put(word, ids)
        return ids

    def text(self, text: bytes) -> bytes:
        if not self.by_words:
            return self._whole(text.decode())
        if self.folds and b"<" not in text:  # special tokens are in lower or mixed case
            text = text.lower()
        words = text.split()
        ids = list(map(self.cache.young.get, words))
        if None in ids:
            ids = [self.word(w) if i is None else i for w, i in zip(words, ids)]
        return b"".join(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --- blocks ----------------------------------------------------------------

def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)  # exact below 2**53


def pack(ids: np.ndarray, percentile: float = PERCENTILE):
    """(starts, minima, widths, exceptions, payload) of an id sequence."""
    n_blocks = -(-len(ids) // BLOCK)
    filled = np.zeros(n_blocks * BLOCK, np.uint32)
    filled[:len(ids)] = ids
    if n_blocks and len(ids) % BLOCK:
        filled[len(ids):] = ids[(n_blocks - 1) * BLOCK:].min()
    blocks = filled.reshape(n_blocks, BLOCK)
    minima = blocks.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    values = blocks - minima[:, None]
    bits = _bit_length(values)
    k = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    widths = np.partition(bits, k, axis=1)[:, k] if n_blocks else np.zeros(0, np.uint8)
    over = bits > widths[:, None]
    exceptions = over.sum(axis=1).astype(np.uint8)
    sizes = BLOCK // 8 * widths.astype(np.int64) + 5 * exceptions.astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint64)
    payload = np.zeros(int(starts[-1]), np.uint8)
    starts = starts[:-1]
    for w in np.unique(widths):
        rows = np.flatnonzero(widths == w)
        if w:
            shifted = (values[rows][:, :, None] >> np.arange(w, dtype=np.uint32)).astype(np.uint8) & 1
            packed = np.packbits(shifted.reshape(len(rows), BLOCK * int(w)), axis=1, bitorder="little")
            at = starts[rows].astype(np.int64)[:, None] + np.arange(packed.shape[1])
            payload[at] = packed
    if exceptions.any():
        row, position = np.nonzero(over)
        rank = np.arange(len(row)) - np.repeat(np.cumsum(exceptions, dtype=np.int64) - exceptions, exceptions)
        base = starts[row].astype(np.int64) + BLOCK // 8 * widths[row].astype(np.int64)
        payload[base + rank] = position
        at = base + exceptions[row].astype(np.int64) + 4 * rank
        payload[at[:, None] + np.arange(4)] = (
            values[row, position].astype("<u4").view(np.uint8).reshape(-1, 4))
    return starts, minima, widths, exceptions, payload


def unpack(starts, minima, widths, exceptions, payload, n_ids: int) -> np.ndarray:
    values = np.zeros((len(starts), BLOCK), np.uint32)
    starts = starts.astype(np.int64)
    for w in np.unique(widths):
        if w:
            rows = np.flatnonzero(widths == w)
            size = BLOCK // 8 * int(w)
            packed = payload[starts[rows][:, None] + np.arange(size)]
            bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, int(w))
            out = np.zeros((len(rows), BLOCK), np.uint32)
            for i in range(int(w)):
                out |= bits[:, :, i].astype(np.uint32) << np.uint32(i)
            values[rows] = out
    if exceptions.any():
        row = np.repeat(np.arange(len(starts)), exceptions)
        rank = np.arange(len(row)) - np.repeat(np.cumsum(exceptions, dtype=np.int64) - exceptions, exceptions)
        base = starts[row] + BLOCK // 8 * widths[row].astype(np.int64)
        position = payload[base + rank]
        at = base + exceptions[row].astype(np.int64) + 4 * rank
        values[row, position] = payload[at[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    return (values + minima[:, None]).reshape(-1)[:n_ids]


def shard_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray,
                percentile: float = PERCENTILE) -> bytes:
    starts, minima, widths, exceptions, payload = pack(ids, percentile)
    return b"".join([
        _HEAD.pack(MAGIC, VERSION, len(doc_ids), len(ids), len(starts)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array(lengths, "<u8").tobytes(),
        starts.astype("<u8").tobytes(), minima.astype("<u4").tobytes(),
        widths.tobytes(), exceptions.tobytes(), payload.tobytes()])


def read_shard(data: bytes):
    """(document ids, lengths, all ids) of a shard file."""
    magic, version, n_docs, n_ids, n_blocks = _HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token shard file of a known version")
    at = _HEAD.size

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    doc_ids, null, lengths = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs)
    starts, minima = take("<u8", n_blocks), take("<u4", n_blocks)
    widths, exceptions = take("u1", n_blocks), take("u1", n_blocks)
    ids = unpack(starts, minima, widths, exceptions, take("u1", len(data) - at), n_ids)
    return [None if z else int(d) for d, z in zip(doc_ids, null)], lengths.astype(np.int64), ids


# --- Spark -----------------------------------------------------------------

def write_token_files(df: DataFrame, folder: str | None = None, text_col: str = "text",
                      id_col: str = "doc_id", tokenizer: str | None = None, end_id: int = END_ID,
                      percentile: float = PERCENTILE, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Tokenize every row's text and write shard files in ascending id order.

    Returns the manifest (part, seq, path, n_docs, n_ids), already committed
    below ``folder`` (default: a new folder in the shared one).  Shards are in
    order by (part, seq).  Null texts count as empty (the end id alone); rows
    with a null id come first; rows of equal id are ordered by a hash of their
    text and each kept.  Only the id and the text are read, so other columns
    of any name don't matter.  An empty table gives an empty manifest.
    """
    spark = df.sparkSession
    folder = folder or new_scratch(spark, "token-files")
    path = tokenizer or default_tokenizer()

    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        enc = encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        doc_ids, lengths, chunks, total = [], [], [], 0

        def flush():
            nonlocal seq, total
            name = f"{folder}/{part:06d}-{seq:05d}-{uuid.uuid4().hex}.tok"
            _write(name, shard_bytes(doc_ids, lengths, np.frombuffer(b"".join(chunks), "<u4"), percentile))
            row = pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "path": [name], "n_docs": [len(doc_ids)], "n_ids": [total]},
                schema=MANIFEST_ARROW)
            seq, total = seq + 1, 0
            for x in (doc_ids, lengths, chunks):
                x.clear()
            return row

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), map(enc.text, utf8(b.column(1)))):
                doc_ids.append(doc_id)
                chunks += (ids, end)
                lengths.append(len(ids) // 4 + 1)
                total += lengths[-1]
                if total >= shard_ids:
                    yield flush()
        if doc_ids:
            yield flush()

    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    rows = df.select(F.col(quoted(id_col)).cast("long").alias("id"), text.alias("text"))
    dealt = (rows.withColumn("tie", F.xxhash64("text"))
             .repartitionByRange(partitions(spark), "id", "tie")
             .sortWithinPartitions("id", "tie").select("id", "text"))
    small_batches(spark)
    return saved(dealt.mapInArrow(releasing(run), MANIFEST), "token-manifest")


MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"
MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()),
                            ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files alone: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (crc32 of the ids as
    little-endian u32)."""
    shards = _with_starts(manifest)
    n = max(1, min(shards.count(), partitions(manifest.sparkSession)))

    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                doc_ids, lengths, ids = read_shard(_read(path))
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(start + ends - lengths),
                     pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (shards.select("path", "start").repartition(n, "path")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def _with_starts(manifest: DataFrame) -> DataFrame:
    """Each shard's first position: running sums inside a part, and over the
    parts' totals (as many rows as write tasks, the only one-task window)."""
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.sum("n").over(before.orderBy("part")).alias("part_start"))
    inside = F.sum("n_ids").over(before.partitionBy("part").orderBy("seq"))
    return (manifest.withColumn("inside", inside).join(parts, "part")
            .withColumn("start", F.coalesce("part_start", F.lit(0)) + F.coalesce("inside", F.lit(0))))


def _write(path: str, data: bytes) -> None:
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(at) as out:
        out.write(data)


def _read(path: str) -> bytes:
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    with store.open_input_file(at) as f:
        return f.read()


def op10_token_files(spark, sf_dir):
    return read_token_files(write_token_files(documents(spark, sf_dir, "doc_id", "text")))
