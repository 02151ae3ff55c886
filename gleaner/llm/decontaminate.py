"""Benchmark decontamination: CGK walks, bit sampling, exact edit distance.

Texts and items are sequences of words (lower case, ASCII punctuation dropped).
An item leaks into a text if some stretch of the text is within ``max_edit``
word edits per item word.

* Windows: every stretch of an item of as many words as hold one edit on
  average (of a shorter item, of as many as one of its pieces between its
  allowed edits), and the windows of that size from every word of a text.
* CGK embedding: a random walk along a window gives two words per word of it;
  a word's own random bit of the step says whether the walk moves on.  An edit
  shifts the walk, which falls into step again after some words, so windows at
  a small edit distance come out at a small Hamming distance; the embedding's
  distance grows with the square of the edits, hence the windows' size.
* Bit sampling: a table holds the windows by some sampled places of a walk, one
  of each equal share of it.  The number of tables follows from ``max_edit``
  and the recall asked for: windows with an edit are simulated, and so many
  tables are made that one of them is met with that probability.  (Windows
  without an edit always meet; a leak has many windows.)
* Verification: exact edit distance of the item and the best stretch around.

``Index`` finds leaks by pieces that any leak keeps word by word: the brute
force that the recall is measured against in the tests.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gleaner.llm.common import documents, find_package, quoted, releasing, small_batches, utf8

SEED = 20240917
LONGEST = 8  # words of a longer piece that make its seed
MAX_EDIT = 0.2
RECALL = 0.9  # probability that a window with one edit is met
PER_WALK = 4  # tables sampled from one walk
TRIALS = 4000  # windows simulated to choose the number of tables
BLOCK_WORDS = 2_000_000  # item words that one pass holds in a task
CHUNK = 1 << 17  # words of text searched at a time
HITS = 1 << 20  # hits of seeds held at a time

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
               for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    text = text or b""
    if not text.isascii():
        text = text.decode().lower().encode()
    return text.translate(_TABLE).split()


def edit_within(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """(distance, end): smallest word edit distance of ``item`` to a stretch
    of ``region``, and where the first such stretch ends."""
    n = len(region)
    step = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    for w in item:
        new = row + 1
        np.minimum(new[1:], row[:-1] + (region != w), out=new[1:])
        row = np.minimum.accumulate(new - step) + step
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """A block of items, and the verification of where they may leak."""

    def __init__(self, items: list[tuple[int, list[bytes]]], max_edit: float):
        if not 0 <= max_edit < 1:
            raise ValueError(f"max_edit must be at least 0 and under 1, not {max_edit}")
        self.vocabulary: dict[bytes, int] = {}
        self.items = [(i, np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws], np.int32))
                      for i, ws in items]
        self.max_edit = max_edit
        self.allowed = [int(max_edit * len(ws)) for _, ws in items]
        self.prepare()

    def prepare(self) -> None:
        raise NotImplementedError

    def lookups(self, text: np.ndarray):
        """Yields (key of each place of the text, sorted keys, (item, place in
        it) of each, shift, bits set for the keys)."""
        raise NotImplementedError

    @staticmethod
    def table(key: np.ndarray, pieces: np.ndarray):
        order = np.argsort(key, kind="stable")
        shift = np.uint64(64 - min(24, max(16, 6 + len(key).bit_length())))
        bits = np.zeros(1 << (64 - int(shift)), bool)
        bits[(key >> shift).astype(np.int64)] = True
        return key[order], pieces[order], shift, bits

    def candidates(self, text: np.ndarray):
        """Yields (items, places of the hits, places where the items would
        start), of about HITS hits at a time."""
        for key, keys, pieces, shift, bits in self.lookups(text):
            hit = np.flatnonzero(bits[(key >> shift).astype(np.int64)])
            low = np.searchsorted(keys, key[hit])
            count = np.searchsorted(keys, key[hit], "right") - low
            hit, low, count = hit[count > 0], low[count > 0], count[count > 0]
            total = np.cumsum(count)
            cuts = np.flatnonzero(np.diff(total // HITS, prepend=0)).tolist()
            for i, j in zip([0, *cuts], [*cuts, len(hit)]):
                if i < j:
                    n = count[i:j]
                    rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    item, at = pieces[np.repeat(low[i:j], n) + rank].T
                    here = np.repeat(hit[i:j], n)
                    yield item, here, here - at

    def regions(self, text: np.ndarray, first: np.ndarray, lengths: np.ndarray):
        """Yields (slot, item, low, high): the stretches of the texts at
        ``first`` worth an exact comparison, one per place of a candidate to
        four words, in which enough words are the item's at all."""
        held, size = [], 0
        for items, hits, places in self.candidates(text):
            slots = np.searchsorted(first, hits, "right") - 1
            held.append((items, slots, places - first[slots]))
            size += len(items)
            if size >= HITS:
                yield from self.near(text, first, lengths, *map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:  # the tables' hits of one place count once
            yield from self.near(text, first, lengths, *map(np.concatenate, zip(*held)))

    def near(self, text, first, lengths, items, slots, offsets):
        order = np.lexsort((offsets, slots, items))
        same = np.stack([items, slots, offsets // 4])[:, order]
        new = np.ones(len(order), bool)
        new[1:] = (same[:, 1:] != same[:, :-1]).any(axis=0)
        pick = order[new]
        items, slots, offsets = items[pick], slots[pick], offsets[pick]
        own = np.zeros(len(self.vocabulary) + 1, bool)
        cuts = np.flatnonzero(np.diff(items, prepend=-1))
        for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(items)]):
            item = int(items[i])
            words, allowed = self.items[item][1], self.allowed[item]
            here = slots[i:j]
            low = np.maximum(0, offsets[i:j] - allowed - 4)
            high = np.minimum(lengths[here], np.maximum(0, offsets[i:j] + len(words) + allowed + 4))
            own[words] = True
            got = np.empty(j - i, np.int64)
            wide = len(words) + 2 * allowed + 8
            step = max(1, 1_000_000 // wide)
            for k in range(0, j - i, step):  # blocks bound the memory of long items
                at = low[k:k + step, None] + np.arange(wide)
                inside = at < high[k:k + step, None]
                at = np.where(inside, at + first[here[k:k + step], None], 0)
                got[k:k + step] = (own[text[at]] & inside).sum(axis=1)
            own[words] = False
            for k in np.flatnonzero(got >= len(words) - allowed).tolist():
                yield int(here[k]), item, int(low[k]), int(high[k])

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))

    def matches(self, texts: list[bytes | None]):
        """Yields (row, item_id, start, n_words, distance) for each text and
        item that leaks into it; start and n_words count words."""
        pad = np.zeros(2 * LONGEST, np.int32)  # no item's word; as long as the longest window
        held, bounds, size = [], [], 0

        def flush():
            text = np.concatenate([x for _, ids in held for x in (ids, pad)])
            first = np.array(bounds)
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            present = np.zeros(len(self.vocabulary) + 1, bool)
            lengths = np.array([len(ids) for _, ids in held])
            for slot, item, low, high in self.regions(text, first, lengths):
                if best.get((slot, item), (1,))[0] == 0:
                    continue
                words, allowed = self.items[item][1], self.allowed[item]
                region = held[slot][1][low:high]
                present[region] = True  # at least this many words must be there
                common = int(present[words].sum())
                present[region] = False
                if common < len(words) - allowed:
                    continue
                distance, end = edit_within(words, region)
                if distance <= allowed:
                    back, length = edit_within(words[::-1], region[:end][::-1])
                    got = (distance, int(low + end - length), int(length))
                    best[slot, item] = min(best.get((slot, item), got), got)
            for (slot, item), (distance, start, length) in sorted(best.items()):
                yield held[slot][0], self.items[item][0], start, length, distance

        for row, text in enumerate(texts):
            ids = self.ids(words_of(text))
            if not ids.any():
                continue
            bounds.append(size)
            held.append((row, ids))
            size += len(ids) + len(pad)
            if size >= CHUNK:
                yield from flush()
                held, bounds, size = [], [], 0
        if held:
            yield from flush()


def mixed(total: np.ndarray) -> np.ndarray:
    return (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


class Index(Items):
    """By pieces: an item of n words that may differ by k edits has k + 1 pieces
    of n // (k + 1) words or more, of which a leak keeps one word by word."""

    def prepare(self) -> None:
        self.weights = np.random.default_rng(SEED).integers(1, 1 << 62, LONGEST, np.uint64) | np.uint64(1)
        pieces: dict[int, list[tuple[int, int]]] = {}  # by words of a seed: (item, place in it)
        for k, ((_, words), allowed) in enumerate(zip(self.items, self.allowed)):
            n = allowed + 1
            pieces.setdefault(min(LONGEST, len(words) // n), []).extend((k, len(words) * j // n) for j in range(n))
        self.seeds = []
        for size, mine in sorted(pieces.items()):
            key = self.keys(np.concatenate([self.items[k][1][at:at + size] for k, at in mine]), size)[::size]
            self.seeds.append((size, self.table(key, np.array(mine))))

    def keys(self, text: np.ndarray, size: int) -> np.ndarray:
        """A hash of each ``size`` words in a row."""
        n = max(0, len(text) - size + 1)
        total = np.zeros(n, np.uint64)
        for j in range(size):
            total += text[j:j + n].astype(np.uint64) * self.weights[j]
        return mixed(total)

    def lookups(self, text: np.ndarray):
        for size, table in self.seeds:
            yield self.keys(text, size), *table


class Walks:
    """The CGK walks over windows of one size, and the places sampled from them."""

    def __init__(self, size: int, n_words: int, n_tables: int, seed: int):
        rng = np.random.default_rng([SEED, size, seed])
        self.size, self.steps = size, 2 * size
        n_walks = -(-n_tables // PER_WALK)
        self.moves = rng.integers(0, 2, (n_walks, self.steps, n_words + 2), np.int8)
        self.moves[:, :, -1] = 0  # the end stays the end
        share = max(2, size - 1)  # sampled places, one of each share of the steps
        edges = np.linspace(0, self.steps, share + 1).astype(int)
        self.sampled = [[[int(rng.integers(a, b)) for a, b in zip(edges, edges[1:])]
                         for _ in range(min(PER_WALK, n_tables - w * PER_WALK))] for w in range(n_walks)]
        self.weights = rng.integers(1, 1 << 62, self.steps, np.uint64) | np.uint64(1)
        self.end = n_words + 1

    def keys(self, text: np.ndarray):
        """Of each table the keys of the windows from each word on."""
        n = max(0, len(text) - self.size + 1)
        begin = np.arange(n, dtype=np.int64)
        padded = np.append(text, self.end)
        for moves, tables in zip(self.moves, self.sampled):
            place, wanted = begin.copy(), {t for table in tables for t in table}
            total = [np.zeros(n, np.uint64) for _ in tables]
            for t in range(max(wanted) + 1):
                word = padded[place]
                over = place - begin >= self.size
                word[over] = self.end
                if t in wanted:
                    part = word.astype(np.uint64) * self.weights[t]
                    for k, table in enumerate(tables):
                        if t in table:
                            total[k] += part
                place += moves[t][word]
            for k in range(len(tables)):
                yield mixed(total[k])


def tables_for(size: int, recall: float = RECALL) -> int:
    """Tables of which one holds a window together with its like of one edit
    with probability ``recall``: the share of tables that do is simulated."""
    if size < 2:
        return 1
    rng = np.random.default_rng([SEED, size])
    n = 64  # words of the simulated texts
    a = rng.integers(1, n + 1, (TRIALS, size))
    b = a.copy()
    at = rng.integers(0, size, TRIALS)
    for row, (i, kind) in enumerate(zip(at.tolist(), rng.integers(0, 3, TRIALS).tolist())):
        if kind == 0:
            b[row, i] = 0
        elif kind == 1:
            b[row] = np.append(np.delete(b[row], i), rng.integers(1, n + 1))
        else:
            b[row] = np.insert(b[row], i, 0)[:size]
    tables = Walks(size, n, 30, 1)
    met = np.mean([ka[::size] == kb[::size] for ka, kb in zip(
        tables.keys(a.ravel().astype(np.int32)), tables.keys(b.ravel().astype(np.int32)))])
    return int(np.ceil(np.log(1 - recall) / np.log(1 - met))) if 0 < met < 1 else 1


class Sampled(Items):
    """The windows of a block of items in the sampled tables of CGK walks."""

    def prepare(self) -> None:
        usual = round(1 / self.max_edit) if self.max_edit else 2 * LONGEST
        windows: dict[int, list[tuple[int, int]]] = {}
        for k, ((_, words), allowed) in enumerate(zip(self.items, self.allowed)):
            size = usual if len(words) >= 2 * usual else max(1, len(words) // (allowed + 1))
            size = min(size, usual, 2 * LONGEST)
            windows.setdefault(size, []).extend((k, at) for at in range(len(words) - size + 1))
        self.tables = []
        for size, mine in sorted(windows.items()):
            walks = Walks(size, len(self.vocabulary), tables_for(size), 2)
            flat = np.concatenate([self.items[k][1][at:at + size] for k, at in mine])
            pieces = np.array(mine)
            self.tables.append((walks, [self.table(key[::size], pieces) for key in walks.keys(flat)]))

    def lookups(self, text: np.ndarray):
        for walks, tables in self.tables:
            for key, table in zip(walks.keys(text), tables):
                yield key, *table


def _blocks(benchmark: DataFrame, text_col: str, id_col: str):
    """The items in blocks of at most about BLOCK_WORDS words each: one for a
    benchmark of usual size, else as many passes over the texts."""
    items = benchmark.select(F.col(quoted(id_col)).cast("long").alias("i"),
                             F.col(quoted(text_col)).cast("string").alias("t")).where("t IS NOT NULL")
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = 1 + size // (4 * BLOCK_WORDS)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()
        block = [(r.i, ws) for r in sorted(rows, key=lambda r: (r.i is None, r.i or 0, r.t))
                 if (ws := words_of(r.t.encode()))]
        if block:
            yield block


MATCH = [StructField(n, LongType()) for n in ("item_id", "start_word", "n_words", "distance")]


def leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
          item_text_col: str = "text", item_id_col: str = "item_id", max_edit: float = MAX_EDIT) -> DataFrame:
    """One row per text and benchmark item that leaks into it: the text's id,
    item_id, start_word and n_words of the stretch, distance (word edits).

    Null texts and items, and those without a word, never match; short items
    do, and a one-word item matches wherever its word stands.  Repeated rows are each searched; rows with a null id are returned
    with it.  Equal items each match.  Other columns are ignored.  Without
    texts or items the result is empty.
    """
    spark = df.sparkSession
    small_batches(spark)
    src = df.select(F.col(quoted(id_col)).alias(id_col), F.col(quoted(text_col)).cast("string").alias("__text"))
    schema = StructType([src.schema[0], *MATCH])
    out = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item_text_col, item_id_col):
        out = out.unionByName(src.mapInArrow(releasing(_search(spark, block, max_edit, schema)), schema))
    return out


def _search(spark, block, max_edit, schema):
    shared = spark.sparkContext.broadcast(block)  # bounded by BLOCK_WORDS

    def run(batches):
        index = Sampled(shared.value, max_edit)
        for b in batches:
            found = list(index.matches(utf8(b.column(1))))
            rows, *columns = zip(*found) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)],
                names=[f.name for f in schema])

    return run


def without_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text",
                  item_id_col: str = "item_id", max_edit: float = MAX_EDIT) -> DataFrame:
    """The rows of ``df`` into whose text no benchmark item leaks, whole.  Null
    texts, and those without a word, stay; without items all rows do; an empty
    table gives an empty result."""
    at = df.columns.index(text_col)
    small_batches(df.sparkSession)
    for block in _blocks(benchmark, item_text_col, item_id_col):
        shared = df.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            index = Sampled(shared.value, max_edit)
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[m[0] for m in index.matches(utf8(b.column(at)))]] = False
                yield b.filter(pa.array(keep))

        df = df.mapInArrow(releasing(run), df.schema)
    return df


def op4_decontamination(spark, sf_dir):
    find_package(spark)
    return leaks(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))
