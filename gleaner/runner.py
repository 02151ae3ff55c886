"""One collection run: plan -> fetch -> land -> parse -> project -> write.

Every stage is a DataFrame; the driver only holds the spec, a handful of
counts and the run summary.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.operators.project import project_schema
from gleaner.operators.summary import run_summary
from gleaner.plans.requests import (build_plan, categorical_axis, date_range_axis, plan_limit,
                                    request_params)
from gleaner.sinks.write import write
from gleaner.sources.fetch import fetch_function, fetch_http, land
from gleaner.sources.records import (csv_header_fields, function_records, infer_text_types, parse_csv_records, parse_json_records,
                                     records_of, request_outcomes)
from gleaner.spec import Categorical, Collector, Column, DateRange, FunctionSource, HttpSource, MessageSource

BROADCAST_PLAN_ROWS = 1_000_000


@dataclass
class RunResult:
    n_requests: int
    summary: dict
    outcomes: DataFrame
    versions: dict


def plan_for(spark: SparkSession, collector: Collector, limit: int | None = None,
             overrides: dict | None = None, today: _dt.date | None = None) -> tuple[DataFrame, int]:
    src = collector.source
    defs = {p.name: p for p in src.params}
    axes = []
    for a in collector.cadence.iterate:
        axes.append(date_range_axis(a, defs, today) if isinstance(a, DateRange) else categorical_axis(spark, a))
    plan = plan_limit(build_plan(spark, axes), limit)
    total = 1
    for a in axes:
        total *= a.size
    total = min(total, limit) if limit is not None else total
    static = {p.name: p.value for p in src.params if p.value is not None}
    return request_params(plan, static, overrides), total


def run_collector(spark: SparkSession, collector: Collector, root: str, limit: int | None = None,
                  overrides: dict | None = None, transport=None, today: _dt.date | None = None,
                  concurrency: int | None = None) -> RunResult:
    collector.validate()
    src = collector.source
    if isinstance(src, MessageSource):
        raise ValueError("message collectors run as streams: see gleaner.streaming")
    plan, n_requests = plan_for(spark, collector, limit, overrides, today)

    fetched = fetch_function(plan, src) if isinstance(src, FunctionSource) else \
        fetch_http(plan, src, transport, concurrency)
    bodies = land(spark, fetched)

    fmt = src.response.format if isinstance(src, HttpSource) else "json"
    if isinstance(src, FunctionSource):
        parsed = function_records(bodies)
    elif fmt == "csv":
        parsed = parse_csv_records(bodies)
    else:
        parsed = parse_json_records(bodies, src.response.records_path if isinstance(src, HttpSource) else None)

    # Parsed once for both the run outcomes and the batch.  Persisting is
    # enough here: the lineage behind it is the landed bodies, so a lost
    # executor re-reads files and never calls the API again.
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    outcomes = request_outcomes(parsed)
    summary_row = run_summary(outcomes).first()
    summary = summary_row.asDict() if summary_row else {"n_requests": 0, "n_failed": 0, "status": "complete"}

    records = records_of(parsed)
    columns = src.schema
    if columns is None and fmt == "csv":
        columns = [Column(n, n, {"bigint": "integer", "double": "float"}.get(t, t))
                   for n, t in infer_text_types(records, fields=csv_header_fields(bodies))]
    batch = project_schema(records, columns)

    members = None
    staging = collector.cadence.staging
    if staging is not None:
        p = F.col("params")[staging.partition_param]
        side = plan.select("req_idx", p.alias("_member"))
        if n_requests <= BROADCAST_PLAN_ROWS:
            side = F.broadcast(side)
        batch = batch.join(side, "req_idx", "left")
        members = _members(collector, staging.partition_param)
    versions = write(spark, collector, batch, root, members=members)
    parsed.unpersist()
    return RunResult(n_requests=n_requests, summary=summary, outcomes=outcomes, versions=versions)


def _members(collector: Collector, param: str) -> list:
    for a in collector.cadence.iterate:
        if isinstance(a, Categorical) and a.param == param:
            return [None if v is None else str(v) for v in a.values]
    for p in collector.source.params:
        if p.name == param and p.value is not None:
            return [str(p.value)]
    return [None]
