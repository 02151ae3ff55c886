"""Run outcome summaries from per-request outcome rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def run_summary(outcomes: DataFrame, run: str | None = None, error: str = "error") -> DataFrame:
    """Per run: requests, failed requests and the status.

    ``FAILED`` when every request failed, ``complete with errors`` when some
    did, ``complete`` otherwise.
    """
    failed = F.col(error).isNotNull()
    groups = [run] if run else []
    agg = outcomes.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count_if(failed).alias("n_failed"),
    )
    status = (F.when(F.col("n_failed") == F.col("n_requests"), F.lit("FAILED"))
              .when(F.col("n_failed") > 0, F.lit("complete with errors"))
              .otherwise(F.lit("complete")))
    return agg.select(*groups, "n_requests", "n_failed", status.alias("status"),
                      F.concat_ws("/", F.col("n_failed").cast("string"),
                                  F.col("n_requests").cast("string")).alias("failed_of"))


def rows_per_request(records: DataFrame, req: str = "req_idx") -> DataFrame:
    """Rows per request; requests with no rows do not appear (they are skipped)."""
    return records.groupBy(req).agg(F.count(F.lit(1)).alias("n_rows"))
