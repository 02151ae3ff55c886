"""Ranked lexical search by range-maximum sparse tables over posting lists.

Documents are ranked for each item by integer impacts summed over the item's
terms.  Three jobs over the documents:

1. *Postings.*  Each text is cut into terms once; of a document only the
   items' terms stay, with their counts.
2. *Statistics.*  Number of documents, of terms, and documents per item term.
3. *Search.*  A task indexes its documents in blocks.  Each posting list of a
   block (impacts in document order) gets a sparse table for range maxima, so
   an interval of documents is bounded by the sum of its terms' maxima.  Per
   item, best first: the interval of the highest bound is split at the
   document of its largest impact, that document is scored, and both sides are
   bounded anew.  The search ends once no interval left can change the best;
   later blocks of the task start from the best of the earlier ones.

A task returns at most ``k`` documents per item, and a window keeps the best.
Items are searched in blocks of bounded size, which are all that is broadcast.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from gleaner.llm.common import documents, quoted, saved, utf8

BEST = 10
ITEM_BYTES = 4 << 20  # item text searched (and broadcast) at a time
POSTINGS = 1 << 20  # postings of an index block
STEPS = 64  # intervals split together at most

# Terms are runs of ASCII letters, digits and all characters beyond ASCII.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text with repeats, A-Z lower-cased."""
    return (text or b"").translate(_TERM).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term with these counts adds to a document's score."""
    return weights * (1_000_000_000 * tf // (1000 * tf + 8 * m))


# --- index of one block ----------------------------------------------------

class Index:
    """Posting lists one behind the other (by term, then document), with one
    sparse table over all of them: ``table[j, i]`` is where the largest impact
    of the 2**j postings from i on stands, the first of equals."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int):
        self.n_docs = n_docs
        self.key = term.astype(np.int64) * n_docs + doc
        order = np.argsort(self.key)
        self.key, self.impact = self.key[order], impact[order]
        n = len(order)
        met, first = np.unique(self.key // max(1, n_docs), return_index=True)
        longest = int(np.diff(np.append(first, n)).max(initial=1))
        self.log = np.zeros(longest + 2, np.int8)
        for i in range(2, len(self.log)):
            self.log[i] = self.log[i >> 1] + 1
        self.table = np.empty((int(self.log[longest]) + 1, n), np.int32)
        self.table[0] = np.arange(n)
        for j in range(1, len(self.table)):
            half, last = 1 << (j - 1), self.table[j - 1]
            self.table[j] = last
            a, b = last[:n - half], last[half:]
            self.table[j, :n - half] = np.where(self.impact[a] >= self.impact[b], a, b)

    def at(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """First posting of each term from each document on."""
        return np.searchsorted(self.key, term * self.n_docs + doc)

    def largest(self, start: np.ndarray, stop: np.ndarray):
        """(posting, impact) of the largest impact in each range; impact 0 if empty."""
        some = stop > start
        start = np.where(some, start, 0)
        n = np.where(some, stop - start, 1)
        j = self.log[n]
        a, b = self.table[j, start], self.table[j, start + n - (1 << j.astype(np.int64))]
        where = np.where(self.impact[a] >= self.impact[b], a, b)
        return where, np.where(some, self.impact[where], 0)


def search(index: Index, ids: np.ndarray, term: np.ndarray, k: int, best: list[tuple[int, int, int]], block: int) -> int:
    """Best-first search of one block for the item with these terms.

    ``ids`` rises along the block's documents.  ``best`` has at most k of
    (score, -id, place) with place = (block, document) as one integer, a heap
    whose root is the worst; it is brought up to date.  Returns how many documents were scored."""
    if not index.n_docs or not len(index.key):
        return 0
    start = index.at(term, np.zeros(len(term), np.int64))
    stop = index.at(term, np.full(len(term), index.n_docs))
    here = stop > start
    term, start, stop = term[here], start[here], stop[here]
    heap: list[tuple[int, int, int, np.ndarray, np.ndarray]] = []  # -bound, first document, split at, ranges
    where, top = index.largest(start, stop)
    if len(term) and int(top.sum()) > 0:
        heap.append((-int(top.sum()), 0, int(index.key[where[top.argmax()]] % index.n_docs), start, stop))
    scored, steps = 0, 4

    def hopeless(bound: int, first: int) -> bool:
        return len(best) == k and (bound, -int(ids[first])) < best[0][:2]

    while heap:
        taken = []
        while heap and len(taken) < steps:
            x = heapq.heappop(heap)
            if hopeless(-x[0], x[1]):
                heap = []  # those behind have lower bounds, or equal ones and later documents
                break
            taken.append(x)
        if not taken:
            break
        steps = min(STEPS, 2 * steps)
        first = np.array([x[1] for x in taken])
        doc = np.array([x[2] for x in taken])
        start, stop = np.stack([x[3] for x in taken]), np.stack([x[4] for x in taken])
        key = term[None] * index.n_docs + doc[:, None]
        cut = np.searchsorted(index.key, key)
        own = np.minimum(cut, len(index.key) - 1)
        hit = index.key[own] == key
        score = np.where(hit, index.impact[own], 0).sum(axis=1)
        scored += len(taken)
        for s, d in zip(score.tolist(), doc.tolist()):
            entry = (s, -int(ids[d]), block << 40 | d)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
        start, stop = np.concatenate([start, cut + hit]), np.concatenate([cut, stop])
        first = np.concatenate([first, doc + 1])
        where, top = index.largest(start, stop)
        bound = top.sum(axis=1)
        split = index.key[where[np.arange(len(where)), top.argmax(axis=1)]] % index.n_docs
        for i in np.flatnonzero(bound > 0).tolist():
            b, f = int(bound[i]), int(first[i])
            if not hopeless(b, f):
                heapq.heappush(heap, (-b, f, int(split[i]), start[i], stop[i]))
    return scored


# --- the operator ----------------------------------------------------------

NO_ID = (1 << 63) - 1  # null ids rank behind all others of one score
_POSTINGS = "doc_id long, n long, term binary, tf binary"


def _postings(docs: DataFrame, vocabulary) -> DataFrame:
    """A row per document with a term: its number of terms, and numbers and
    counts of the vocabulary's terms in it."""

    def run(batches):
        number = vocabulary.value
        for b in batches:
            n, term, tf = [], [], []
            for text in utf8(b.column(1)):
                found = terms(text)
                n.append(len(found))
                known = [x for x in map(number.get, found) if x is not None]
                t, c = np.unique(np.array(known, np.int32), return_counts=True)
                term.append(t.tobytes())
                tf.append(c.astype(np.int32).tobytes())
            out = pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(term, pa.binary()), pa.array(tf, pa.binary())],
                names=["doc_id", "n", "term", "tf"])
            yield out.filter(pa.array([x > 0 for x in n], pa.bool_()))

    return docs.mapInArrow(run, _POSTINGS)


def _statistics(postings: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms in all, and documents per term."""
    total = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32), minlength=n_terms)
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(df[met])], names=["term", "df"])

    df = np.zeros(n_terms, np.int64)
    counts = postings.select("term").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for b in counts.toArrow().to_batches():  # one row per term of the items searched
        df[b.column(0).to_numpy()] = b.column(1).to_numpy()
    return total[0], total[1], df


def _searched(postings: DataFrame, shared, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of each item."""

    def run(batches):
        wanted, weights, n_docs, n_all = shared.value
        best: list[list] = [[] for _ in wanted]
        ids_of: list[np.ndarray] = []
        null_of: list[np.ndarray] = []
        held, size = [], 0

        def index():
            doc_id = np.concatenate([x[0] for x in held])
            null = np.concatenate([x[1] for x in held])
            n = [v for x in held for v in x[2]]
            term = [v for x in held for v in x[3]]
            tf = [v for x in held for v in x[4]]
            order = np.lexsort((null, doc_id))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            sizes = np.array([len(v) // 4 for v in term])
            m = np.array([10 + 90 * v * n_docs // n_all for v in n], np.int64)
            t = np.frombuffer(b"".join(term), np.int32)
            c = np.frombuffer(b"".join(tf), np.int32).astype(np.int64)
            block = Index(t, np.repeat(rank, sizes), impacts(weights[t], c, np.repeat(m, sizes)), len(order))
            ids_of.append(doc_id[order])
            null_of.append(null[order])
            for i, own in enumerate(wanted):
                search(block, ids_of[-1], own, k, best[i], len(ids_of) - 1)
            met = {p >> 40 for x in best for _, _, p in x}
            for j in range(len(ids_of)):  # blocks without a document among the best are let go
                if j not in met:
                    ids_of[j] = null_of[j] = None

        for b in batches:
            null = ~np.asarray(b.column(0).is_valid())
            held.append((b.column(0).fill_null(NO_ID).to_numpy(), null, b.column(1).to_pylist(),
                         b.column(2).to_pylist(), b.column(3).to_pylist()))
            size += sum(map(len, held[-1][3])) // 4
            if size >= POSTINGS:
                index()
                held, size = [], 0
        if held:
            index()
        rows = [(i, None if null_of[p >> 40][p & (1 << 40) - 1] else -d, s)
                for i, x in enumerate(best) for s, d, p in x if s > 0]
        item, doc_id, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc_id, pa.int64()),
                                          pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return postings.mapInArrow(run, "item int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = BEST) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id (named as in
    ``items``), rank (from 1, unique, highest first), doc_id, score.

    A term is a run of ASCII letters and digits and of characters beyond
    ASCII, lower-cased in A-Z.  Only scores above 0 are returned; equal scores
    by rising doc_id, null ids last.  A null or term-less text has no terms,
    is not counted among the documents and never returned; such an item
    returns nothing.  Repeated document rows are documents each; item rows that
    repeat id and text are one item; rows of one id with different texts are
    items each.  Other columns are ignored, whatever their names.  An empty
    table on either side gives an empty result.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"),
                      F.col(quoted(text_col)).cast("string").alias("text"))
    kind = items.select(F.col(quoted(item_col)).alias("item")).schema["item"]
    asked = saved(items.select(F.col(quoted(item_col)).alias("item"), F.col(quoted(item_text_col)).cast("string").alias("text"))
                  .where("text IS NOT NULL").distinct(), "search-items")
    n_blocks = max(1, -(-int(asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // ITEM_BYTES))
    out = spark.createDataFrame([], StructType([
        StructField("item", kind.dataType), StructField("rank", IntegerType()), StructField("doc_id", LongType()),
        StructField("score", LongType())]))
    for block in range(n_blocks):
        part = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block).orderBy("item", "text").collect()
        names = [r["item"] for r in part]
        of_item = [sorted(set(terms(r["text"].encode()))) for r in part]
        number = {t: i for i, t in enumerate(sorted({t for x in of_item for t in x}))}
        if not number:
            continue
        shared = spark.sparkContext.broadcast(number)
        postings = saved(_postings(src, shared), "search-postings")
        n_docs, n_all, df = _statistics(postings, len(number))
        weights = np.array([weight(n_docs, int(v)) for v in df], np.int64)
        wanted = [np.array([number[t] for t in x], np.int64) for x in of_item]
        model = spark.sparkContext.broadcast((wanted, weights, n_docs, n_all))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = saved(_searched(postings, model, k).withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}"),
                     "search-best")
        shared.unpersist()
        model.unpersist()
        named = spark.createDataFrame(list(enumerate(names)), StructType([
            StructField("at", IntegerType()), StructField("named", kind.dataType)]))
        out = out.unionByName(best.join(F.broadcast(named), best["item"] == named["at"]).select(
            F.col("named").alias("item"), "rank", "doc_id", "score"))  # the names of one block of items
    return out.select(F.col("item").alias(item_col), "rank", "doc_id", "score")


def op12_ranked_search(spark, sf_dir):
    return ranked(documents(spark, sf_dir, "doc_id", "text"),
                  spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


# Terms by splitting at everything that is no term character; TRANSLATE lower-cases A-Z alone.
_SPLIT = r"""string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
RANKED_SQL = f"""
WITH cut AS (
  SELECT doc, doc_id, unnest({_SPLIT}) AS term
  FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM documents WHERE text IS NOT NULL)),
counted AS (SELECT doc, doc_id, term, count(*) AS tf FROM cut WHERE term <> '' GROUP BY ALL),
sizes AS (SELECT doc, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM sizes),
asked AS (
  SELECT DISTINCT item_id, text, term FROM (
    SELECT item_id, text, unnest({_SPLIT}) AS term FROM benchmark WHERE text IS NOT NULL) WHERE term <> ''),
postings AS (SELECT * FROM counted JOIN sizes USING (doc) WHERE term IN (SELECT term FROM asked)),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM postings, totals GROUP BY term),
scores AS (
  SELECT item_id, asked.text, doc, doc_id, CAST(sum(weight * ((1000000000 * tf) //
           (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_all))))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 10
"""
