"""SimHash near duplicates with pivot distance tables.

A document's fingerprint has a bit set where over half of its shingles' hashes
have it.  Fingerprints at ``distance`` or fewer differing bits link:

1. *Fingerprints.*  From here on a fingerprint counts once, however many
   documents have it.
2. *Pivot table.*  Each fingerprint gets its Hamming distances to PIVOTS fixed
   reference fingerprints.  By the triangle inequality two that link differ by
   at most ``distance`` in every coordinate.
3. *Groups.*  Two that link agree in one of ``distance + 1`` parts of their
   bits, so each fingerprint goes to one group per part.  A group above GROUP
   members is cut again by parts of its remaining bits, and so on: a group
   ends when it is small enough or its bits do, so none stands whole in a
   task, and no link is lost.
4. *Pairs.*  In a group, sorted by the first pivot, the pairs whose largest
   coordinate difference is within the distance are verified exactly.  Only
   links that join something new in the group are passed on: a star per
   component, so a group of n never gives more than n rows.

The links' components are completed over all groups with alternating stars.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.common import documents, partitions, quoted, saved, utf8
from gleaner.llm.jaccard_join import components

WORDS, HASH_SEED, DISTANCE = 3, 42, 2
PIVOTS = 16  # reference fingerprints of the table
GROUP = 2048  # members from which a group is cut again
ROWS = 1 << 16  # rows of whole groups that a task compares at a time
PAIRS = 1 << 20  # pairs held at a time
HELD = 1 << 16  # shingles hashed before their bits are counted


# --- fingerprints ----------------------------------------------------------

def _bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit, bit 0 (the lowest) first."""
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, words: int = WORDS, seed: int = HASH_SEED) -> int:
    w = (text or b"").lower().split()
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    n = max(1, len(w) - words + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, HELD):
        counts += _bit_counts([digest(b" ".join(w[i:i + words]), seed) for i in range(at, min(n, at + HELD))])
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int = WORDS, seed: int = HASH_SEED) -> DataFrame:
    """(doc_id, fp) of every row, the 64 bits as a signed long."""
    src = df.select(F.col(quoted(id_col)).cast("long").alias("doc_id"),
                    F.col(quoted(text_col)).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, words, seed) for t in utf8(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return src.mapInArrow(run, "doc_id long, fp long")


# --- pivot tables ----------------------------------------------------------

def pivots(n: int = PIVOTS) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.sha256(f"pivot {i}".encode()).digest()[:8], "little") for i in range(n)],
                    np.uint64)


def pivot_table(fp: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint (uint64) to each reference."""
    return np.bitwise_count(fp[:, None] ^ refs[None]).astype(np.int8)


def close_pairs(fp: np.ndarray, group: np.ndarray, refs: np.ndarray, distance: int):
    """Blocks of index pairs of one group whose fingerprints differ in at most
    ``distance`` bits: near at the first pivot by sorting, near at all others
    by their largest coordinate difference, then verified."""
    table = pivot_table(fp, refs)
    order = np.lexsort((table[:, 0], group))
    fp, group, table = fp[order], group[order], table[order]
    key = group.astype(np.int64) * 256 + table[:, 0]  # rows of one group within ``distance`` of each other's key
    reach = np.searchsorted(key, key + distance, "right") - np.arange(len(key)) - 1
    at = 0
    while at < len(key):
        stop = at + max(1, int(np.searchsorted(np.cumsum(reach[at:]), PAIRS, "right")))
        n = reach[at:stop]
        x = np.repeat(np.arange(at, min(stop, len(key))), n)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        for p in range(1, table.shape[1]):
            if not len(x):
                break
            near = np.abs(table[x, p] - table[y, p]) <= distance
            x, y = x[near], y[near]
        ok = np.bitwise_count(fp[x] ^ fp[y]) <= distance
        yield order[x[ok]], order[y[ok]]
        at = stop


def stars(n: int, blocks) -> np.ndarray:
    """For each of n points the smallest point it is linked with by the pairs."""
    root = np.arange(n)
    for x, y in blocks:
        while len(x):
            a, b = root[x], root[y]
            open_ = a != b
            x, y, a, b = x[open_], y[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    return root


# --- groups ----------------------------------------------------------------

def _parts(mask: int, n: int) -> list[int]:
    """The set bits of ``mask`` dealt to n masks of (nearly) equal size."""
    bits = [i for i in range(64) if mask >> i & 1]
    cut = [len(bits) * k // n for k in range(n + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cut, cut[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _cut(rows: DataFrame, masks: dict[str, int], distance: int) -> tuple[DataFrame, dict[str, int]]:
    """Deal the groups' members to groups by parts of their remaining bits.
    ``masks``: a group's path -> the bits that its members are known to share."""
    out, made = [], {}
    for path, known in masks.items():
        for k, part in enumerate(_parts(~known & ((1 << 64) - 1), distance + 1)):
            made[f"{path}{k}"] = known | part
            out.append((path, f"{path}{k}", _signed(known | part)))
    options = F.create_map(*[x for path in masks for x in (F.lit(path), F.array(*(
        F.struct(F.lit(to).alias("path"), F.lit(mask).alias("mask")) for of, to, mask in out if of == path)))])
    return (rows.select("fp", F.explode(options[F.col("path")]).alias("to"))
            .select("fp", F.col("to.path").alias("path"), F.col("fp").bitwiseAND(F.col("to.mask")).alias("bits"))), made


def _star_links(members: DataFrame, distance: int, n_parts: int) -> DataFrame:
    """(a, b): links inside the groups (path, bits), a star per component."""
    refs = pivots()

    def run(batches):
        paths, bits, fps, size = [], [], [], 0

        def linked(last: bool):
            """Compare the whole groups held; the last one may go on."""
            nonlocal paths, bits, fps, size
            p, k, f = (np.concatenate(x) for x in (paths, bits, fps))
            new = np.append(True, (p[1:] != p[:-1]) | (k[1:] != k[:-1]))
            stop = len(f) if last else int(np.flatnonzero(new)[-1])
            paths, bits, fps, size = [p[stop:]], [k[stop:]], [f[stop:]], len(f) - stop
            if not stop:
                return
            of, group = f[:stop].view(np.uint64), np.cumsum(new[:stop])
            root = stars(stop, close_pairs(of, group, refs, distance))
            tied = np.flatnonzero(root != np.arange(stop))
            yield pa.RecordBatch.from_arrays([pa.array(f[tied]), pa.array(f[root[tied]])], names=["a", "b"])

        for b in batches:
            paths.append(b.column(0).to_numpy(zero_copy_only=False).astype(str))
            bits.append(b.column(1).to_numpy())
            fps.append(b.column(2).to_numpy())
            size += b.num_rows
            if size >= ROWS:
                yield from linked(False)
        if size:
            yield from linked(True)

    dealt = members.select("path", "bits", "fp").repartition(n_parts, "path", "bits").sortWithinPartitions("path", "bits")
    return dealt.mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """(a, b): links between fingerprints (column fp, each once), enough of
    them to make every component of the links at ``distance`` bits or fewer."""
    n_parts = partitions(distinct.sparkSession)
    rows, masks = distinct.select("fp", F.lit("").alias("path")), {"": 0}
    found = None
    while masks:
        cut, masks = _cut(rows, masks, distance)
        cut = saved(cut, "simhash-groups")
        count = saved(cut.groupBy("path", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-counts")
        # a group with no more than ``distance + 1`` bits left has few members
        ends = [p for p, known in masks.items() if 64 - known.bit_count() <= distance + 1]
        large = (F.col("n") > group) & ~F.col("path").isin(ends)
        kind = cut.join(count.select("path", "bits", large.alias("large")), ["path", "bits"])
        part = saved(_star_links(kind.where("NOT large"), distance, n_parts), "simhash-links")
        found = part if found is None else found.unionByName(part)
        met = sorted(r["path"] for r in count.where(large).select("path").distinct().collect())
        rows = kind.where("large").select("fp", "path").distinct()
        masks = {p: masks[p] for p in met}
    return found


# --- the operator ----------------------------------------------------------

def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                       distance: int = DISTANCE, seed: int = HASH_SEED, group: int = GROUP) -> DataFrame:
    """One row per row of ``df``: doc_id, fingerprint (16 lowercase hex
    digits), component_id (the smallest doc_id reachable by links, itself
    included).

    Texts are lower-cased in A-Z and cut into words at ASCII white space;
    shingles are runs of ``words`` words with repeats, a text with fewer words
    is one shingle.  A null, empty or blank text has fingerprint zero, and
    links like any other.  Rows with a null id keep their fingerprint, link
    nothing and get a null component.  Repeated rows each get their row; rows
    of one id with different texts each follow their own.  Other columns are
    ignored, whatever their names.  An empty table gives an empty result.
    """
    docs = saved(fingerprints(df, id_col, text_col, words, seed), "simhash-fingerprints")
    distinct = saved(docs.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first")),
                     "simhash-distinct")
    labels = saved(components(links(distinct, distance, group)), "simhash-labels")
    tied = distinct.join(labels.withColumnRenamed("node", "fp"), "fp")
    low = tied.groupBy("component").agg(F.min("first").alias("low"))
    of = distinct.join(saved(labels.join(low, "component").select(F.col("node").alias("fp"), "low"), "simhash-lows"),
                       "fp", "left").select("fp", F.coalesce("low", "first").alias("component_id"))
    # one row per fingerprint on the right; a fingerprint with many documents
    # is split by the adaptive join
    return docs.join(saved(of, "simhash-components"), "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op13_simhash_neardup(spark, sf_dir):
    return simhash_components(documents(spark, sf_dir, "doc_id", "text"))
