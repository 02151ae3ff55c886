"""Fetch one response per request row, on the executors.

The request plan is a DataFrame; the calls run inside the tasks that hold its
rows, so nothing passes through the driver, and responses leave a task one by
one.  The output is landed (written to the shared folder) before it is parsed:
a lost executor then re-reads what was landed instead of calling again.

Two sources: ``fetch_http`` calls a REST API per request, and ``fetch_function``
a user's Python function, as a table function that SQL can call too
(``register_function``).
"""

from __future__ import annotations

import codecs
import importlib
import json
import math
import time
import urllib.error
import urllib.parse
import urllib.request

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.functions.casts import SPARK_TYPES
from gleaner.session import new_scratch
from gleaner.sources.records import strict_json
from gleaner.spec import Auth, FunctionSource, HttpSource

FETCH_SCHEMA = "req_idx BIGINT, status INT, body STRING, error STRING"
CALL_SCHEMA = "req_idx BIGINT, pos INT, record STRING, error STRING"
TIMEOUT_SECONDS = 60
USUAL_SECONDS = 5  # a response's time that the default number of paced tasks allows for

# Hints added to the error text of these HTTP statuses.
HTTP_HINTS = {
    401: "Check that your API token or key is correct and has not expired.",
    403: "Your credentials may lack the required permissions for this endpoint.",
    404: "The URL may be wrong, or this resource does not exist.",
    429: "Rate limit exceeded. Add a rate_limit block to the collector spec to slow down requests.",
}

_MARKS = [(codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"),
          (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")]


def decode_body(raw: bytes, charset: str | None) -> str:
    """A body's text: by its byte order mark, else by the charset its header
    names, else as UTF-8, and as Latin-1 where it is not UTF-8."""
    marked = next((name for mark, name in _MARKS if raw.startswith(mark)), None)
    for name in filter(None, (marked, charset, "utf-8")):
        try:
            return raw.decode(name)
        except (UnicodeDecodeError, LookupError):
            continue
    return raw.decode("latin-1")


def urllib_transport(method: str, url: str, params: dict, headers: dict, timeout: float) -> tuple[int, str]:
    """Default transport: GET and POST both send the params as query string."""
    query = urllib.parse.urlencode({k: v for k, v in params.items() if v is not None}, doseq=True)
    full = f"{url}{'&' if '?' in url else '?'}{query}" if query else url
    try:
        answer = urllib.request.urlopen(urllib.request.Request(full, method=method, headers=headers), timeout=timeout)
    except urllib.error.HTTPError as e:
        answer = e
    with answer:
        return answer.status, decode_body(answer.read(), answer.headers.get_content_charset())


def http_error(status: int, url: str) -> str | None:
    if status // 100 == 2:
        return None
    return "; ".join(filter(None, [f"{url} answered with status {status}", HTTP_HINTS.get(status)]))


def credentials(auth: Auth | None) -> tuple[dict, dict]:
    """(params, headers) that a request carries for an auth."""
    if auth is None:
        return {}, {}
    places = {"query_param": (0, auth.key, auth.value), "header": (1, auth.key, auth.value),
              "bearer": (1, "Authorization", f"Bearer {auth.value}")}
    place, name, value = places[auth.type]
    sent: tuple[dict, dict] = ({}, {})
    sent[place][name] = value
    return sent


def _resolve(fn):
    if callable(fn):
        return fn
    mod, _, name = fn.partition(":")
    return getattr(importlib.import_module(mod), name)


def paced_tasks(spark: SparkSession, interval: float) -> int:
    """Tasks that keep a rate though responses take a while: no more than run
    at the same time, as a task that waits for its slot holds a core."""
    return max(1, min(spark.sparkContext.defaultParallelism, math.ceil(USUAL_SECONDS / interval)))


def fetch_http(plan: DataFrame, source: HttpSource, transport=None, concurrency: int | None = None) -> DataFrame:
    """One call per plan row: (req_idx, status, body, error).  ``plan.params``
    must already hold static and dynamic values.  Auth travels in the task
    closure, never as a column.

    With a rate limit, requests are dealt to ``concurrency`` tasks in turn
    (request i to task i modulo their number) and each has a time slot: task r
    sends its k-th request ``(r + k * tasks) * interval`` after it began, and
    never less than ``tasks * interval`` after its last.  Tasks that run at
    once share the limit evenly; tasks that run later only lower the rate.
    """
    transport = transport or urllib_transport
    extra, headers = credentials(source.auth)
    url, method = source.url, source.method
    interval = source.rate_limit.interval_seconds if source.rate_limit is not None else 0.0
    if interval and not concurrency:
        concurrency = paced_tasks(plan.sparkSession, interval)
    plan = plan.select("req_idx", "params")
    if concurrency:
        turn = F.pmod(F.col("req_idx"), F.lit(concurrency)).cast("int")
        plan = plan.repartitionById(concurrency, turn).sortWithinPartitions("req_idx")

    def run(batches):
        call = _resolve(transport)
        began, due = time.monotonic(), None
        for batch in batches:
            for req_idx, params in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if interval:
                    due = began + (req_idx % concurrency) * interval if due is None else due
                    time.sleep(max(0.0, due - time.monotonic()))
                    due = max(due, time.monotonic()) + concurrency * interval
                status = body = None
                try:
                    status, body = call(method, url, {**dict(params or {}), **extra}, dict(headers), TIMEOUT_SECONDS)
                    if isinstance(body, bytes):
                        body = decode_body(body, None)
                    error = http_error(status, url)
                except Exception as e:  # noqa: BLE001 - a failed request is a row, not a crash
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays(
                    [pa.array([req_idx], pa.int64()), pa.array([status], pa.int32()),
                     pa.array([None if error else body], pa.string()), pa.array([error], pa.string())],
                    names=["req_idx", "status", "body", "error"])

    return plan.mapInArrow(run, FETCH_SCHEMA)


# --- functions -------------------------------------------------------------

def function_calls(function):
    """A Python table function over a table argument: one call of ``function``
    per row, one output row per record (req_idx, pos, record as JSON text).

    The function gets a dict of the row's columns, with their types; columns
    ``req_idx`` and ``params`` (a map, whose entries become params of their
    own) are not passed on.  A call that raises gives one row with its error,
    a call without records one row without position."""

    class Calls:
        def __init__(self):
            self.function = _resolve(function)

        def eval(self, row):
            given = row.asDict()
            req_idx, params = given.pop("req_idx", None), given.pop("params", None)
            if params is not None:  # typed columns stand for the map's texts, where it has them
                given = {**params, **{k: v for k, v in given.items() if k in params and v is not None}}
            try:
                texts = [json.dumps(strict_json(r), default=str, ensure_ascii=False) for r in self.function(given) or ()]
            except Exception as e:  # noqa: BLE001 - a failed call is a row, not a crash
                yield req_idx, None, None, f"{type(e).__name__}: {e}"
                return
            for pos, text in enumerate(texts):
                yield req_idx, pos, text, None
            if not texts:
                yield req_idx, None, None, None

    return F.udtf(Calls, returnType=CALL_SCHEMA)


def register_function(spark: SparkSession, name: str, function) -> None:
    """Let SQL call it: ``SELECT * FROM name(TABLE(SELECT id AS req_idx, ... FROM t))``."""
    spark.udtf.register(name, function_calls(function))


def fetch_function(plan: DataFrame, source: FunctionSource) -> DataFrame:
    """One call of ``fn(params) -> list[dict]`` per plan row, one row per record
    (``CALL_SCHEMA``).  Params that the source declares as integer, float or
    boolean reach the function as such, all others as text."""
    typed = [F.col("params")[p.name].try_cast(SPARK_TYPES[p.type]).alias(p.name) for p in source.params
             if p.type in ("integer", "float", "boolean") and p.name not in ("req_idx", "params")]
    return function_calls(source.function)(plan.select("req_idx", "params", *typed).asTable())


def land(spark: SparkSession, fetched: DataFrame, folder: str | None = None) -> DataFrame:
    """Write fetched rows to the shared folder and read them back."""
    folder = folder or new_scratch(spark, "landing")
    fetched.write.mode("overwrite").parquet(folder)
    return spark.read.schema(fetched.schema).parquet(folder)
