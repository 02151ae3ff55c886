"""N-gram Jaccard join with prefix filters under several global orders.

Documents link when the Jaccard similarity of their sets of word n-grams is at
least a threshold.  The join is exact and never lists all pairs of a group:

1. *Classes.*  One pass makes each document's set, a 64-bit class id (a sum of
   the set's hashes), a sketch and a few min-hash keys.  Documents of one
   class are copies; from here on a class counts once.
2. *Stars.*  In each group of one key, every class is paired with a fixed
   number of the group's classes (centres).  The pairs of a class whose
   sketches agree best are verified exactly, and the links' components formed;
   classes that fail near a component are compared with its middle ones.
   This folds large groups of near copies with linear work.
3. *Prefix filters.*  Under a global order of all n-grams, two linked sets
   share an n-gram among the first ``n - ceil(t n) + 1`` of each.  Each class
   posts its prefix under each of several orders (frequent n-grams last, the
   others by a hash of the order), with its component so far.  Two classes of
   different components are candidates only if they share a posted n-gram, at
   compatible set sizes and positions, under every one of the orders.  (A link inside a
   component would change nothing.)
4. *Verification.*  Candidates are compared exactly, and the components
   completed with alternating stars.

Which n-grams count as frequent only shapes the order, hence the work, never
the result: any order that all documents share gives every link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from gleaner.llm.common import documents, lower_ascii, partitions, quoted, releasing, saved, saved_even, small_batches, utf8

ORDERS = 2  # global orders whose filters are intersected
KEYS = 6  # min-hash keys per class for the stars
PICKED = 6  # centres per key that a hash picks, beside three ends
BEST = 6  # centres a class is compared with
MIDDLE = 4  # middle classes of a component that the second stars use
SKETCH = 64  # bins of the sketch
SKETCH_AGREE = 0.6  # share of agreeing bins from which a star's pair is verified
LEVEL_BITS = 22  # n-grams that occur often go last in the orders: by a table of so many bits' slots
LEVELS, SLOTS_IN_BLOB = 1 << LEVEL_BITS, 1 << 14
FREQUENT_IN_TASK = 2  # classes of one task's block that share an n-gram before it counts as frequent
BLOCK = 2_000_000  # n-grams or postings a task holds before it passes them on
PIECE = 1 << 18  # bytes of text cut into words at a time
BROADCAST_ROWS = 500_000  # rows of (long, long, long) up to which a side is broadcast

_M = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
      0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]  # odd multipliers


# --- sets ------------------------------------------------------------------

def _mix(h: np.ndarray, k: int = 0) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_M[k % 8])
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_M[(k + 3) % 8])
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWER = _powers(_M[0], PIECE + 2)
_INVERSE = _powers(pow(_M[0], -1, 1 << 64), PIECE + 2)
LONG_WORD = 256  # longer words get a stronger hash


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the words of at most PIECE bytes that begin and end
    with a blank: polynomial hashes from one running sum, then mixed."""
    text = np.frombuffer(raw, np.uint8)
    space = _SPACE[text]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    total = np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _POWER[:len(text)])
    size = (ends - starts).astype(np.uint64)
    w = _mix((total[ends - 1] - total[starts - 1]) * _INVERSE[starts] + size)
    for i in np.flatnonzero(size > LONG_WORD):
        w[i] = xxhash.xxh3_64_intdigest(raw[starts[i]:ends[i]])
    return w, starts


def _grams(w: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n words that follow each other."""
    if len(w) < n:
        return w[:0]
    h = w[:len(w) - n + 1] * np.uint64(_M[1])
    for i in range(1, n):
        h = (h + w[i:len(w) - n + 1 + i]) * np.uint64(_M[(i + 1) % 8])
    return _mix(h ^ np.uint64(n), 2)


def _unique(s: np.ndarray) -> np.ndarray:
    s = np.sort(s)
    if len(s) > 1:
        new = np.ones(len(s), bool)
        np.not_equal(s[1:], s[:-1], out=new[1:])
        s = s[new]
    return s


def _long_text(text: bytes) -> np.ndarray:
    out, at = [], 0
    while at < len(text):  # cut at white space; a word longer than a piece stays whole
        stop = min(len(text), at + PIECE - 2)
        while stop < len(text) and text[stop] not in b" \t\n\x0b\x0c\r":
            stop += 1
        if stop - at <= PIECE - 2:
            out.append(_word_hashes(b" " + text[at:stop] + b" ")[0])
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(x) if len(x) > LONG_WORD
                                 else int(_word_hashes(b" " + x + b" ")[0][0])
                                 for x in text[at:stop].split()], np.uint64))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _of_words(w: np.ndarray, words: int) -> np.ndarray:
    return _unique(_grams(w, min(words, len(w)))) if len(w) else w


def shingle_sets(texts, words: int = 5):
    """The sorted distinct n-gram hashes of each text, in order: with fewer
    words than n its whole sequence as one, without words none.  Short texts
    are hashed together, a piece at a time."""
    held: list[bytes] = []
    size = 1

    def flush():
        raw = b" " + b" ".join(held) + b" "
        w, starts = _word_hashes(raw)
        ends = np.cumsum([len(t) + 1 for t in held])
        cut = np.searchsorted(starts, ends + 1).tolist()
        grams, at = _grams(w, words), 0
        for stop in cut:
            if stop - at >= words:
                yield _unique(grams[at:stop - words + 1])
            else:
                yield _of_words(w[at:stop], words)
            at = stop

    for t in texts:
        t = lower_ascii(t or b"")
        if held and size + len(t) + 1 > PIECE:
            yield from flush()
            held, size = [], 1
        if len(t) + 2 > PIECE:
            yield _of_words(_long_text(t), words)
            continue
        held.append(t)
        size += len(t) + 1
    if held:
        yield from flush()


def shingles(text: bytes | None, words: int = 5) -> np.ndarray:
    return next(shingle_sets([text], words))


def class_of(s: np.ndarray) -> int:
    total = int(_mix(s, 5).sum(dtype=np.uint64)) if len(s) else 0
    return (total ^ len(s)) - (1 << 63)


def sketch_of(s: np.ndarray) -> bytes:
    """One byte of the smallest hash in each of SKETCH equal ranges."""
    edges = np.searchsorted(s, (np.arange(SKETCH, dtype=np.uint64) << np.uint64(64 - SKETCH.bit_length() + 1)))
    first = s[np.minimum(edges, len(s) - 1)]
    empty = np.append(edges[1:], len(s)) == edges
    return np.where(empty, 0, 1 + (first & np.uint64(0xFF)) % np.uint64(255)).astype(np.uint8).tobytes()


def required(n, percent: int):
    """Smallest intersection a set of n needs for the threshold."""
    return -(-percent * n // 100)


def linked(both: int, na: int, nb: int, percent: int) -> bool:
    return 100 * both >= percent * (na + nb - both)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


# --- the operator ----------------------------------------------------------

def jaccard_components(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 5,
                       percent: int = 80, orders: int = ORDERS) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles (set size), class_id
    (equal for copies) and component_id (the smallest doc_id reachable by
    links, itself included).

    Texts are lower-cased in A-Z and cut into words at ASCII white space.  A
    text with fewer than ``words`` words has its whole sequence as its only
    n-gram; a null, empty or blank text has none, links with nothing and is
    its own component.  Rows with a null id link nothing and get a null
    component.  Repeated rows each get their row; rows of one id with
    different texts each follow their own text.  Other columns are ignored,
    whatever their names.  An empty table gives an empty result.
    """
    spark = df.sparkSession
    small_batches(spark)
    docs = df.select(F.col(quoted(id_col)).cast("long").alias("doc_id"),
                     F.col(quoted(text_col)).cast("string").alias("text"))
    first = saved(_sets(docs, words), "jaccard-sets")
    sets = first.where("kind = 0")
    classes = saved(sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("class_id").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
        F.first("sketch").alias("sketch"), F.first("keys").alias("keys")), "jaccard-classes")
    texts = _texts_of(docs, sets)

    star = _verify(_stars(classes), texts, words)
    labels = components(star.where(_links(percent)).select("a", "b"))
    again = _verify(_second_stars(classes, star, labels, percent), texts, words).where(_links(percent))
    labels = components(again.select("a", "b").unionByName(
        labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    candidates = _candidates(docs, sets, classes, labels, _frequent(first), words, percent, orders)
    more = _verify(candidates, texts, words).where(_links(percent))
    if not more.isEmpty():
        labels = components(more.select("a", "b").unionByName(
            labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    rep = classes.select("class_id", "rep")
    smallest = labels.join(rep.withColumnRenamed("class_id", "node"), "node").groupBy("component").agg(
        F.min("rep").alias("component_id"))
    of_class = labels.join(smallest, "component").select(F.col("node").alias("class_id"), "component_id")
    own = rep.join(of_class, "class_id", "left").select(
        "class_id", F.coalesce("component_id", "rep").alias("component_id"))
    return (sets.select("doc_id", "n_shingles", "class_id").join(own, "class_id", "left")
            .select("doc_id", "n_shingles", "class_id",
                    F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def _links(percent: int):
    return F.expr(f"100 * both >= {percent} * (na + nb - both)")


SETS = "kind int, doc_id long, n_shingles long, class_id long, sketch binary, keys array<long>"


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """A row per document (kind 0); and, of kind 1, n-grams that at least
    FREQUENT_IN_TASK classes of one block share (class_id: the n-gram,
    n_shingles: how many classes)."""

    def run(batches):
        held, size, seen = [], 0, set()

        def frequent():
            found, count = np.unique(np.concatenate(held), return_counts=True)
            often = count >= FREQUENT_IN_TASK
            k = int(often.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array([1] * k, pa.int32()), pa.nulls(k, pa.int64()), pa.array(count[often]),
                 pa.array(found[often].view(np.int64)), pa.nulls(k, pa.binary()),
                 pa.nulls(k, pa.list_(pa.int64()))], names=names)

        for b in batches:
            n, ids, sketches, keys = [], [], [], []
            for s in shingle_sets(utf8(b.column(1)), words):
                n.append(len(s))
                ids.append(class_of(s))
                sketches.append(sketch_of(s) if len(s) else None)
                keys.append([int((s * np.uint64(_M[(k + 4) % 8])).min().view(np.int64)) for k in range(KEYS)] if len(s) else None)
                if len(s) and ids[-1] not in seen:
                    seen.add(ids[-1])
                    held.append(s)
                    size += len(s)
                if size >= BLOCK:
                    yield frequent()
                    held, size, seen = [], 0, set()
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * len(n), pa.int32()), b.column(0), pa.array(n, pa.int64()),
                 pa.array(ids, pa.int64()), pa.array(sketches, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=names)
        if held:
            yield frequent()

    names = ["kind", "doc_id", "n_shingles", "class_id", "sketch", "keys"]
    return docs.mapInArrow(releasing(run), SETS)


def _frequent(first: DataFrame) -> np.ndarray:
    """How frequent the n-grams of each of LEVELS slots are (a slot: the upper
    bits of an n-gram), as one byte on a log scale.  Its size is fixed: this
    table is all that the driver gathers and broadcasts, whatever the corpus."""
    slot = F.shiftrightunsigned("class_id", 64 - LEVEL_BITS)
    counts = (first.where("kind = 1").groupBy(slot.alias("slot")).agg(F.sum("n_shingles").alias("n"))
              .select("slot", F.least(F.lit(255), 1 + 8 * F.log2("n")).cast("int").alias("level")))
    blobs = (counts.groupBy((F.col("slot") / SLOTS_IN_BLOB).cast("int").alias("blob"))
             .agg(F.collect_list((F.col("slot") % SLOTS_IN_BLOB * 256 + F.col("level")).cast("int")).alias("packed")))
    table = np.zeros(LEVELS, np.uint8)
    for batch in blobs.toArrow().to_batches():
        for blob, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            packed = packed.values.to_numpy()
            table[blob * SLOTS_IN_BLOB + (packed >> 8)] = packed & 255
    return table


def _stars(classes: DataFrame) -> DataFrame:
    """Pairs (a > b) of a class with centres that share a key with it: of each
    key's centres (smallest set, smallest and largest id, and a few that a
    hash picks) those BEST whose sketches agree most."""
    keyed = classes.select("class_id", "n", "sketch", F.posexplode("keys").alias("k", "key"))
    one = F.struct("class_id", "sketch")
    ends = [F.min_by(one, F.struct("n", "class_id")), F.min_by(one, "class_id"), F.max_by(one, "class_id"),
            *(F.min_by(one, F.xxhash64("class_id", F.lit(i))) for i in range(PICKED))]
    centre = keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("size"),
                                           F.array_distinct(F.array(*ends)).alias("ends"))
    pairs = (keyed.join(centre.where("size > 1").select("k", "key", F.explode("ends").alias("c")), ["k", "key"])
             .where("class_id <> c.class_id")
             .select("class_id", F.col("c.class_id").alias("centre"), "sketch", F.col("c.sketch").alias("other")))

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SKETCH)
                    for i in (2, 3))
            used = np.maximum(1, ((x > 0) | (y > 0)).sum(axis=1))
            agree = ((x == y) & (x > 0)).sum(axis=1) / used
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(agree)],
                                             names=["x", "y", "agree"]).filter(pa.array(agree >= SKETCH_AGREE))

    best = Window.partitionBy("x").orderBy(F.desc("agree"), "y")
    return (pairs.mapInArrow(releasing(run), "x long, y long, agree double").distinct()
            .withColumn("rank", F.row_number().over(best)).where(f"rank <= {BEST}")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def _second_stars(classes: DataFrame, star: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of a class that failed to link with a centre and the MIDDLE
    classes of that centre's component: those nearest to what they were
    compared with, which in a group of edited copies are the least edited.
    And the middle classes of components that share a key, in a star."""
    both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b"), "na", "nb", "both"))
    of = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    near = Window.partitionBy("ca").orderBy(F.desc("near"), "a")
    middle = (both.groupBy("a").agg(F.avg(F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("near"))
              .join(of, "a").withColumn("rank", F.row_number().over(near)).where(f"rank <= {MIDDLE}")
              .select(F.col("a").alias("m"), F.col("ca").alias("cb")))
    failed = (both.where(~_links(percent)).join(of, "a", "left")
              .join(of.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b")
              .where(~F.col("cb").eqNullSafe(F.col("ca"))).select("a", "cb").distinct())
    at_key = (classes.select(F.col("class_id").alias("a"), F.posexplode("keys").alias("k", "key")).join(of, "a")
              .groupBy("k", "key", "ca").agg(F.count(F.lit(1)).alias("size")))
    low = at_key.groupBy("k", "key").agg(F.min("ca").alias("cb"), F.count(F.lit(1)).alias("n")).where("n > 1")
    meet = at_key.join(low, ["k", "key"]).where("ca <> cb").select("ca", "cb").distinct()
    across = meet.join(middle.select(F.col("m").alias("a"), F.col("cb").alias("ca")), "ca").select("a", "cb")
    return (failed.unionByName(across).join(middle, "cb")
            .select(F.greatest("a", "m").alias("a"), F.least("a", "m").alias("b")).distinct())


def _attached(df: DataFrame, side: DataFrame, on: str, how: str) -> DataFrame:
    """Join a side of plain numbers: broadcast up to a counted number of rows,
    else shuffled like any join."""
    small = side.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(side) if small else side, on, how)


def _texts_of(docs: DataFrame, sets: DataFrame):
    """A function: class ids -> (class_id, text) of one document each."""
    ids = sets.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("class_id").agg(F.min("doc_id").alias("doc_id"))
    mixed = sets.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        (F.min("class_id") != F.max("class_id")).alias("mixed"))

    def texts(wanted: DataFrame, words: int) -> DataFrame:
        side = saved(ids.join(wanted, "class_id").join(mixed, "doc_id"), "jaccard-wanted")
        got = _attached(docs, side, "doc_id", "inner")
        plain = got.where("NOT mixed").select("class_id", "text")
        # ids that stand for several texts: look for the class among them

        def run(batches):
            for b in batches:
                c = b.column(0).to_pylist()
                t = utf8(b.column(1))
                yield b.filter(pa.array([class_of(shingles(x, words)) == k for k, x in zip(c, t)], pa.bool_()))

        other = got.where("mixed").select("class_id", "text").mapInArrow(run, "class_id long, text string")
        return saved(plain.unionByName(other).dropDuplicates(["class_id"]), "jaccard-texts")

    return texts


def _verify(pairs: DataFrame, texts, words: int) -> DataFrame:
    """The pairs (a, b) with na, nb (set sizes) and both (common n-grams)."""
    pairs = saved_even(pairs.select("a", "b"), "jaccard-pairs")  # distinct ones
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).distinct()
    text = texts(wanted, words)
    full = (pairs.join(text.select(F.col("class_id").alias("a"), F.col("text").alias("ta")), "a")
            .join(text.select(F.col("class_id").alias("b"), F.col("text").alias("tb")), "b")
            .select("a", "b", "ta", "tb"))

    def run(batches):
        last: dict[int, np.ndarray] = {}

        def of(k, text):
            if k not in last:
                if len(last) >= 64:
                    last.clear()
                last[k] = shingles(text, words)
            return last[k]

        for b in batches:
            rows = []
            for ka, kb, ta, tb in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                      utf8(b.column(2)), utf8(b.column(3))):
                x, y = of(ka, ta), of(kb, tb)
                rows.append((ka, kb, len(x), len(y), overlap(x, y)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)],
                names=["a", "b", "na", "nb", "both"])

    return saved(full.mapInArrow(releasing(run), "a long, b long, na long, nb long, both long"), "jaccard-verified")


def _candidates(docs, sets, classes, labels, frequent, words, percent, orders) -> DataFrame:
    """Class pairs (a > b) of different components that share a prefix n-gram
    under every order."""
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(frequent)
    # a row per document that copies another (it posts nothing) or whose class
    # is in a component; all others post with their class alone
    one = sets.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").agg(
        F.min("class_id").alias("class_id"), F.max("class_id").alias("other")).where("class_id = other")
    of_class = labels.select(F.col("node").alias("class_id"), "component")
    role = saved(one.join(classes.select("class_id", "rep"), "class_id").join(of_class, "class_id", "left")
                 .where("rep <> doc_id OR component IS NOT NULL")
                 .select("doc_id", (F.col("rep") == F.col("doc_id")).alias("post"), "component"), "jaccard-roles")
    src = (_attached(docs.where("doc_id IS NOT NULL"), role, "doc_id", "left")
           .where("post IS NULL OR post").select("component", "text"))
    n_parts = partitions(spark)

    def prefixes(s: np.ndarray, of_order: int) -> np.ndarray:
        level = levels.value[s >> np.uint64(64 - LEVEL_BITS)].astype(np.uint64)
        key = (level << np.uint64(56)) | (_mix(s, of_order + 1) >> np.uint64(8))
        k = len(s) - required(len(s), percent) + 1
        first = np.argpartition(key, k - 1)[:k] if k < len(s) else np.arange(len(s))
        return s[first[np.argsort(key[first])]]

    def post(batches):
        held: list[tuple[np.ndarray, int, int, int, int | None]] = []
        size = 0

        def pack():
            token = np.concatenate([x[0] for x in held])
            reps = [len(x[0]) for x in held]

            def column(i, kind):
                return np.repeat(np.array([x[i] for x in held], kind), reps)

            row = np.empty(len(token), POSTING)
            row["t"] = (token >> np.uint64(32)).astype(np.uint32)
            row["c"] = column(1, np.int64)
            row["n"] = column(2, np.uint32)
            row["p"] = np.concatenate([np.arange(k) for k in reps])
            part = ((token & np.uint64(0xFFFFFFFF)) % np.uint64(n_parts)).astype(np.int32) + column(3, np.int32) * n_parts
            alone = np.array([x[4] is None for x in held])
            member = np.repeat(~alone, reps)
            component = np.repeat(np.array([x[4] or 0 for x in held], np.int64), reps)
            order = np.lexsort((member, part))
            row, part, member, component = row[order], part[order], member[order], component[order]
            starts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
            stops = np.append(starts[1:], len(part))
            mid = [i + int(np.searchsorted(member[i:j], True)) for i, j in zip(starts, stops)]
            return pa.RecordBatch.from_arrays(
                [pa.array(part[starts]),
                 pa.array([row[i:m].tobytes() for i, m in zip(starts, mid)], pa.binary()),
                 pa.array([row[m:j].tobytes() for m, j in zip(mid, stops)], pa.binary()),
                 pa.array([component[m:j].tobytes() for m, j in zip(mid, stops)], pa.binary())],
                names=["part", "alone", "members", "components"])

        for b in batches:
            for component, s in zip(b.column(0).to_pylist(), shingle_sets(utf8(b.column(1)), words)):
                if not len(s):
                    continue
                c = class_of(s)
                for k in range(orders):
                    p = prefixes(s, k)
                    held.append((p, c, min(len(s), 0xFFFFFFFF), k, component))
                    size += len(p)
                if size >= BLOCK:
                    yield pack()
                    held, size = [], 0
        if held:
            yield pack()

    def match(batches):
        held: dict[int, list[tuple]] = {}
        for b in batches:
            for part, *blobs in zip(*(b.column(i).to_pylist() for i in range(4))):
                held.setdefault(part, []).append(blobs)
        for part in list(held):
            alone, members, of = zip(*held.pop(part))
            rows = np.frombuffer(b"".join(alone + members), POSTING)
            component = rows["c"].copy()
            found = np.frombuffer(b"".join(of), np.int64)
            if len(found):
                component[-len(found):] = found
            for a, b in _pairs(rows["t"], rows["n"].astype(np.int64), rows["p"], rows["c"], component, percent):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(np.full(len(a), 1 << (part // n_parts), np.int64))],
                    names=["a", "b", "seen"])

    posted = src.mapInArrow(releasing(post), "part int, alone binary, members binary, components binary").repartition(orders * n_parts, "part")
    return (posted.mapInArrow(releasing(match), "a long, b long, seen long").groupBy("a", "b")
            .agg(F.bit_or("seen").alias("seen")).where(f"seen = {(1 << orders) - 1}").select("a", "b"))


POSTING = np.dtype([("t", "<u4"), ("n", "<u4"), ("p", "<u4"), ("c", "<i8")])


SMALL_GROUP = 32


def _pairs(t, n, p, c, m, percent: int):
    """Distinct pairs of classes (c) of different components (m) that share an
    n-gram (t) at compatible sizes (n) and positions (p), in blocks."""
    order = np.lexsort((m, t))
    t, n, c, m = t[order], n[order], c[order], m[order]
    rest = n - p[order].astype(np.int64)  # n-grams from this one on
    new = np.ones(len(t), bool)
    new[1:] = t[1:] != t[:-1]
    other = new.copy()
    other[1:] |= m[1:] != m[:-1]
    group = np.cumsum(new) - 1
    n_components = np.bincount(group, weights=other) if len(t) else np.zeros(0)
    keep = n_components[group] > 1  # an n-gram of one component joins nothing
    t, n, rest, c, m, group, other = (x[keep] for x in (t, n, rest, c, m, group, other))
    if not len(t):
        return
    size = np.bincount(group)[group]
    out_a, out_b, held = [], [], 0

    def put(x, y):
        nonlocal held
        out_a.append(np.maximum(x, y))
        out_b.append(np.minimum(x, y))
        held += len(x)

    small = size <= SMALL_GROUP
    gs, ns, rs, cs, ms = (x[small] for x in (group, n, rest, c, m))
    for shift in range(1, SMALL_GROUP):
        x, y = slice(None, -shift), slice(shift, None)
        ok = (gs[x] == gs[y]) & (ms[x] != ms[y]) & _compatible(ns[x], rs[x], ns[y], rs[y], percent)
        put(cs[x][ok], cs[y][ok])
        if held >= BLOCK:
            yield _distinct(out_a, out_b)
            out_a, out_b, held = [], [], 0
    large = np.flatnonzero(~small)
    if len(large):
        starts = large[np.flatnonzero(np.diff(group[large], prepend=-1))]
        for i in starts.tolist():
            j = i + int(size[i])
            blocks = i + np.flatnonzero(other[i:j])
            for start, q in zip(blocks.tolist(), blocks[1:].tolist()):  # each component with those after it
                for r in range(start, q):
                    ok = _compatible(n[r], rest[r], n[q:j], rest[q:j], percent)
                    y = c[q:j][ok]
                    put(np.full(len(y), c[r]), y)
                    if held >= BLOCK:
                        yield _distinct(out_a, out_b)
                        out_a, out_b, held = [], [], 0
    if held:
        yield _distinct(out_a, out_b)


def _compatible(nx, restx, ny, resty, percent: int):
    """Whether two sets may link if this is the first n-gram they share: no
    more than the n-grams from here on can be common.  (Two that link pass
    at their first common n-gram of the order.)"""
    return (100 + percent) * np.minimum(restx, resty) >= percent * (nx + ny)


def _distinct(a: list[np.ndarray], b: list[np.ndarray]):
    both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
    return both[:, 0].copy(), both[:, 1].copy()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b), by alternating large
    and small stars; component is the smallest node.  Each round is written
    below the shared folder, and only two sums come to the driver."""
    e = saved_even(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), "components")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).distinct()
        e = saved_even(small, "components")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def op8_jaccard_join(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir, "doc_id", "text"))
