"""Mixing sources to target weights by exact token lengths.

Sources in code point order (null last) weigh 3, 1, 2, repeating.  They share
``share`` times all words; a target stops at ``repeat`` times its source's
words, and the excess is shared by weight until none is above.

A source's target T is met so: with S words in the source, every document is
taken T // S times.  The rest R is fitted as a subset sum over the counts of
documents by exact length: first in proportion to the counts, then large
lengths greedily, then bounded-knapsack dynamic programming over the remaining
budget.  Which documents of a length are taken is decided by a seeded hash.
Only (source, length, count) rows meet in one task per source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField

from gleaner.llm.common import documents, map_texts, numbered, quoted, saved

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEAT = 2
SEED = 17
BUDGET = 20_000  # words left to the dynamic programming, plus one longest document
BUCKETS = 256  # hash ranges that a length's documents are counted in


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take (at most counts) for a total
    of ``budget`` words, or as near as the dynamic programming gets."""
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    take = np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):  # large lengths down to the last budget
        if left <= BUDGET:
            break
        k = min(int(counts[i] - take[i]), (left - BUDGET) // max(1, int(lengths[i])))
        take[i] += k
        left -= k * int(lengths[i])
    # bounded knapsack: bit b of reach is set if b words can be made; counts
    # are split into powers of two, and each step's bits are kept to go back
    limit = left + int(lengths.max())
    mask, reach, steps = (1 << (limit + 1)) - 1, 1, []
    for i in np.argsort(lengths, kind="stable"):
        size, spare, part = int(lengths[i]), int(counts[i] - take[i]), 1
        if size == 0:
            continue
        spare = min(spare, limit // size)
        while spare > 0 and not reach >> left & 1:
            k = min(part, spare)
            steps.append((i, k, reach))
            reach |= (reach << (k * size)) & mask
            spare -= k
            part *= 2
        if reach >> left & 1:
            break
    under = (reach & ((1 << (left + 1)) - 1)).bit_length() - 1
    over = reach >> left
    above = left + (over & -over).bit_length() - 1 if over else None
    at = under if above is None or left - under <= above - left else above
    for i, k, before in reversed(steps):
        if not before >> at & 1:
            take[i] += k
            at -= k * int(lengths[i])
    return take


def sizes(df: DataFrame, text_col: str, id_col: str, source_col: str) -> DataFrame:
    src = df.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(source_col)).cast("string").alias("source"),
                    F.xxhash64(F.col(quoted(text_col)).cast("string")).alias("tie"),
                    F.col(quoted(text_col)).alias("text"))

    def start():
        return lambda texts: [[len((t or b"").split()) for t in texts]]

    return map_texts(src, "text", start, [StructField("size", LongType())])


def targets(by_source: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """(source, source_size, target).  The windows see one row per source."""
    everything = Window.partitionBy()
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    rows = by_source.select("source", "source_size", w.alias("w"), (F.lit(repeat) * F.col("source_size")).alias("cap"),
                            (F.lit(share) * F.sum("source_size").over(everything)).alias("budget"))
    # sources in the order they reach their cap: with those before it capped,
    # the level per weight that the others share
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("budget") - before) / rest)
    capped = F.col("cap") <= F.col("w") * F.col("level")
    level = F.first(F.when(~capped, F.col("level")), ignorenulls=True).over(order.rowsBetween(*whole))
    return rows.select("source", "source_size", F.when(capped, F.col("cap").cast("double"))
                       .otherwise(F.col("w") * level).alias("target"))


def mix(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT, seed: int = SEED) -> DataFrame:
    """One row per row of ``df``: doc_id, source, tie (a hash of the text),
    size (words), source_size, target (its source's, in words), copies (0 to
    ``repeat``) and taken = copies * size.

    A null text has size 0; documents of size 0 are never taken.  Rows of a
    null source form a source of their own.  Rows that repeat, ids that are
    null or stand for several texts: each row counts and is chosen by its
    id and text; equal rows are exchangeable.  Other columns are ignored.  An
    empty table gives an empty result.
    """
    pick = F.xxhash64("doc_id", "tie", F.lit(seed))
    rows = saved(sizes(df, text_col, id_col, source_col).select(
        "*", F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit(""))).alias("key"),
        pick.alias("pick"), F.pmod(F.shiftright(pick, 20), F.lit(BUCKETS)).alias("bucket")), "mix-sizes")
    buckets = saved(rows.groupBy("key", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "mix-buckets")
    lengths = buckets.groupBy("key", "size").agg(F.sum("n").alias("n"))
    source = F.when(F.col("key").startswith("s"), F.expr("substring(key, 2)")).alias("source")
    goal = targets(lengths.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
                   .select(source, "source_size"), weights, share, repeat)
    goal = saved(goal.withColumn("key", F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"),
                                                 F.coalesce("source", F.lit(""))))
                 .select("key", "source_size", "target"), "mix-targets")

    def plan(rows: pa.Table) -> pa.Table:
        total, target = rows["source_size"][0].as_py(), rows["target"][0].as_py()
        want = int(round(target))
        whole = min(repeat, want // total) if total else 0
        rows = rows.sort_by("size")
        extra = fit(rows["size"].to_numpy(), rows["n"].to_numpy(),
                    want - whole * total if whole < repeat else 0)
        return pa.table({"key": rows["key"], "size": rows["size"], "whole": pa.repeat(pa.scalar(whole, pa.int64()), len(extra)),
                         "extra": pa.array(extra, pa.int64())})

    planned = (lengths.join(goal, "key").groupBy("key")
               .applyInArrow(plan, "key string, size long, whole long, extra long"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("key", "size").orderBy("bucket")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = saved(buckets.join(planned, ["key", "size"]).withColumn("quota", F.greatest(
        F.lit(0), F.least("n", F.col("extra") - before))), "mix-quota")
    marked = rows.join(quota, ["key", "size", "bucket"])
    clear = marked.where("quota = 0 OR quota = n").withColumn("more", (F.col("quota") > 0).cast("long"))
    nth = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("pick", "doc_id", "tie"))
    split = marked.where("quota > 0 AND quota < n").withColumn("more", (nth <= F.col("quota")).cast("long"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("more")).otherwise(F.lit(0))
    return (clear.unionByName(split).join(goal, "key")
            .select("doc_id", "source", "tie", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken")))


def mixed(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them, whole; none of an
    empty table, and none of a null, empty or blank text.

    The mix's copies are matched to rows by id and text; rows equal in both
    are numbered on either side.  All columns are kept, whatever their names."""
    taken = mix(df, text_col, id_col, source_col, **how)
    same = [F.col("__id"), F.col("__tie")]
    number = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0)))
    side = (taken.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), F.col("copies").alias("__copies"))
            .withColumn("__n", number))
    inner, outer = numbered(df.columns)
    left = df.select(*inner, F.col(quoted(id_col)).alias("__id"),
                     F.xxhash64(F.col(quoted(text_col)).cast("string")).alias("__tie")).withColumn("__n", number)
    on = left["__id"].eqNullSafe(side["__id"]) & (left["__tie"] == side["__tie"]) & (left["__n"] == side["__n"])
    return (left.join(side.where("__copies > 0"), on)
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*outer))


def op5_mixing(spark, sf_dir):
    return mix(documents(spark, sf_dir, "doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")
