"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from gleaner.session import saved

# Fixed value: a word is a run of code points other than the six ASCII white
# space characters.  ``bytes.split()`` cuts UTF-8 text at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 4 << 20  # of an Arrow batch that goes to a Python worker, one row at least


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def carried(df: DataFrame, text_col: str, fields: Sequence[StructField],
            carry: Sequence[str] | None) -> list[str]:
    """Input columns passed on: ``carry`` (default: all but the text), without
    those an output field of the same name (in any case) replaces."""
    taken = {f.name.lower() for f in fields}
    names = [c for c in df.columns if c != text_col] if carry is None else list(carry)
    return [c for c in names if c.lower() not in taken]


def numbered(names: Sequence[str]) -> tuple[list, list]:
    """(inner, outer): input columns under names of their own, which no
    internal column has, and those columns back under the names they came with."""
    return ([F.col(quoted(c)).alias(f"in{i}") for i, c in enumerate(names)],
            [F.col(f"in{i}").alias(c) for i, c in enumerate(names)])


def map_texts(df: DataFrame, text_col: str, start: Callable[[], Callable],
              fields: Sequence[StructField], carry: Sequence[str] | None = None) -> DataFrame:
    """Run a function over batches of texts in Arrow batches, one row per row.

    ``start()`` is called once per task and returns ``f(texts) -> columns``:
    ``texts`` is a list of UTF-8 bytes (None for null), ``columns`` a list of
    values for each of ``fields``.  Nothing is kept between batches except
    what ``start`` made.
    """
    names = carried(df, text_col, fields, carry)
    inner, _ = numbered(names)
    src = df.select(*inner, F.col(quoted(text_col)).cast("string").alias("text"))
    small_batches(df.sparkSession)
    schema = StructType([*(StructField(c, f.dataType, f.nullable) for c, f in zip(names, src.schema.fields)), *fields])
    out_names = [f.name for f in schema.fields]
    types = [_arrow(f.dataType) for f in fields]
    n = len(names)

    def run(batches):
        f = start()
        for b in batches:
            columns = f(utf8(b.column(n)))
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(n)]
                + [pa.array(c, type=t) for c, t in zip(columns, types)], names=out_names)

    return src.mapInArrow(releasing(run), schema)


def small_batches(spark: SparkSession) -> None:
    """From now on rows of this session go to Python workers in batches of
    ``BATCH_BYTES``: every running task holds a batch in the JVM's buffers, in
    Arrow's and as Python objects, on the way in and out, and Spark's own
    limits (10,000 rows, 64 MB) let whole files of texts be one batch.  A
    limit that the session was given stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # Spark's own
        spark.conf.set(key, f"{BATCH_BYTES}b")


def releasing(run: Callable) -> Callable:
    """``run``, and then memory it has freed goes back to the system: Python
    workers live on after a task, beside the executor's other memory."""
    def run_and_release(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
            if trim is not None:
                trim(0)
    return run_and_release


def utf8(column: pa.Array) -> list[bytes | None]:
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def _arrow(t):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def saved_even(df: DataFrame, kind: str) -> DataFrame:
    """``saved`` for small rows that a shuffle has dealt evenly: a few files
    per core, however many partitions the shuffle has."""
    return saved(df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism), kind)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package where the driver
    found it; a cluster gets it as a wheel (``--py-files``)."""
    import os

    import gleaner

    root = os.path.dirname(os.path.dirname(os.path.abspath(gleaner.__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(*columns)


def lower_ascii(text: bytes) -> bytes:
    """Lower-case A-Z only (``bytes.lower`` leaves other code points alone)."""
    return text.lower()


SPACE = re.compile(r"[\x20\x09-\x0D]+")


class Recent:
    """A bounded cache in two generations: when the young one is full it
    becomes the old one, whose entries are dropped unless used again."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        self.young[key] = value
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
