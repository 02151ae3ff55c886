"""Makers of inputs for queries and tests: pages of rows as a remote API would
send them, and recorded responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def pages_of(df: DataFrame, page_size: int, order: list[str]) -> DataFrame:
    """Group rows into pages of at most ``page_size`` rows: ``(page, rows)``.

    Pages follow the input partitions, never a data key, so a hot key cannot
    make a page larger than ``page_size``.  Rows are sorted by ``order``
    inside each partition first: a retried task (whose input arrives in a
    different order after a shuffle) then cuts the same pages.
    """
    rid = F.monotonically_increasing_id()
    keyed = df.sortWithinPartitions(*order).select((rid / page_size).cast("bigint").alias("page"), rid.alias("__rid"),
                      F.struct(*[F.col(c) for c in df.columns]).alias("__row"))
    pages = keyed.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("__rid", "__row"))).alias("__rows"))
    return pages.select("page", F.transform("__rows", lambda x: x["__row"]).alias("rows"))


class RecordedTransport:
    """Replays recorded responses: ``rules`` is a list of
    ``(match_params: dict, status, body)``; the first rule whose params all
    equal the request's answers it.  Each call is recorded with the headers
    and params sent, for checks of auth placement."""

    def __init__(self, rules, default=(404, "")):
        self.rules = list(rules)
        self.default = default

    def __call__(self, method, url, params, headers, timeout):
        for match, status, body in self.rules:
            if all(str(params.get(k)) == str(v) for k, v in match.items()):
                return status, body
        return self.default
