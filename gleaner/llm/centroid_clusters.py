"""Centroid clustering with a Walsh-Hadamard progressive search.

Vectors become integers, floor(scale * x), and are kept as their exact integer
Walsh-Hadamard coefficients in order of sequency (coarse to fine).  By
Parseval the squared coefficient differences of a vector and a centroid add
up to ``dimensions`` times their squared distance, and a sum over the first
coefficients is a lower bound of it.  The search adds blocks of coefficients,
drops a centroid once its sum is strictly above a distance already known, and
finishes all coefficients of those that are left: their distances are exact,
and ties keep all their centroids.

The transform is linear, so a round adds up coefficients: a task sends one row
per cluster, and the driver gets one row per cluster and round.  Coefficients
are written once below the shared folder; every round reads them again, so a
lost executor costs the tasks it ran.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from gleaner.llm.common import quoted, saved

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
PLAIN = 1 << 23  # components up to here keep every sum of squares within 64 bits
LARGEST = 1e24  # components beyond are refused: sums of billions of rows must fit a decimal(38)
FIRST_GUESS = 4  # coefficients after which a first full distance is taken as the bound


def transform(x: np.ndarray) -> np.ndarray:
    """Exact Walsh-Hadamard transform of the rows, natural order (its own
    inverse up to the factor ``columns``)."""
    x = x.copy()
    n, size, half = len(x), x.shape[1], 1
    while half < size:
        v = x.reshape(n, size // (2 * half), 2, half)
        a, b = v[:, :, 0].copy(), v[:, :, 1].copy()
        v[:, :, 0], v[:, :, 1] = a + b, a - b
        half *= 2
    return x


def sequency(size: int) -> np.ndarray:
    """Positions of the natural order, by rising number of sign changes."""
    signs = transform(np.eye(size, dtype=np.int64))
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def coefficients(x: np.ndarray) -> np.ndarray:
    return transform(x)[:, sequency(x.shape[1])]


def components(c: np.ndarray) -> np.ndarray:
    """Back from coefficients; exact."""
    natural = np.empty_like(c)
    natural[:, sequency(c.shape[1])] = c
    return transform(natural) // c.shape[1]


def blocks(size: int) -> list[tuple[int, int]]:
    """0:1, 1:2, 2:4, 4:8, ... of the coefficients."""
    out, at = [(0, 1)], 1
    while at < size:
        out.append((at, 2 * at))
        at *= 2
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row of coefficients ``x`` among the
    centroids' coefficients ``c``; of equals the smaller number.  Both are
    int64 within the plain range, or Python integers (dtype object)."""
    n, size = x.shape
    sums = np.zeros((n, len(c)), x.dtype)
    alive = np.ones((n, len(c)), bool)
    bound = None
    for start, stop in blocks(size):
        row, at = np.nonzero(alive)
        d = x[row, start:stop] - c[at, start:stop]
        sums[row, at] += (d * d).sum(axis=1)
        if bound is None and stop >= min(FIRST_GUESS, size):
            guess = sums.argmin(axis=1)
            d = x - c[guess]
            bound = (d * d).sum(axis=1)
        if bound is not None:
            alive &= sums <= bound[:, None]  # strictly worse ones go
    far = np.where(alive, sums, sums.max(initial=0) + 1)
    best = far.argmin(axis=1)
    return best, sums[np.arange(n), best] // size


# --- the operator ----------------------------------------------------------

def _kept(column, size: int):
    """(rows, their components) of the vectors of the right size without null,
    NaN or infinity."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(np.asarray(column.offsets))
    ok = (lengths == size) & np.asarray(column.is_valid())
    rows = np.flatnonzero(ok)
    values = column.take(pa.array(rows)).flatten()
    flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
    finite = np.isfinite(flat).all(axis=1)
    return rows[finite], flat[finite]


def _integer(x: float, scale: int) -> int:
    if abs(x) > LARGEST:
        raise ValueError(f"vector component {x!r} is beyond {LARGEST:g}, too large to add up exactly")
    return int(x) * scale if abs(x) >= 2.0 ** 53 else math.floor(scale * x)


def _is_plain(x: np.ndarray) -> bool:
    return x.dtype != object and (x.size == 0 or int(np.abs(x).max()) <= PLAIN * x.shape[1])


def _encoded(df: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """A row per kept vector: its id, and its coefficients as 32-bit integers,
    or as decimal text where they are too large for those."""
    src = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(vector_col)).cast("array<double>").alias("v"))

    def run(batches):
        for b in batches:
            rows, x = _kept(b.column(1), size)
            plain = np.abs(x).max(axis=1, initial=0) * scale < PLAIN
            packed: list = [None] * len(rows)
            wide: list = [None] * len(rows)
            c = coefficients(np.floor(scale * np.where(plain[:, None], x, 0)).astype(np.int64)).astype("<i4")
            for i in range(len(rows)):
                if plain[i]:
                    packed[i] = c[i].tobytes()
                else:
                    whole = np.array([[_integer(v, scale) for v in x[i].tolist()]], object)
                    wide[i] = ",".join(map(str, coefficients(whole)[0]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array(packed, pa.binary()), pa.array(wide, pa.string())],
                names=["id", "packed", "wide"])

    return src.mapInArrow(run, StructType([src.schema["id"], *_schema("packed binary, wide string")]))


def _schema(text: str):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(text).fields


def _decoded(packed, wide, size: int):
    """The coefficients of a batch, in one or two runs: (rows, array)."""
    valid = np.asarray(packed.is_valid())
    rows = np.flatnonzero(valid)
    if len(rows):
        flat = np.frombuffer(b"".join(packed.drop_null().to_pylist()), "<i4")
        yield rows, flat.reshape(-1, size).astype(np.int64)
    rows = np.flatnonzero(~valid)
    if len(rows):
        yield rows, np.array([[int(v) for v in wide[i].as_py().split(",")] for i in rows.tolist()], object)


def _search(x: np.ndarray, c: np.ndarray):
    if _is_plain(x) and _is_plain(c):
        return nearest(x, c)
    return nearest(x.astype(object), c.astype(object))


def _as_array(rows: list[list[int]]) -> np.ndarray:
    out = np.array(rows, object)
    small = all(abs(v) <= PLAIN * out.shape[1] for v in out.ravel().tolist())
    return out.astype(np.int64) if small else out


def _round(encoded: DataFrame, c: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (members, sums of their coefficients), of one assignment."""
    k, size = c.shape

    def run(batches):
        count = [0] * k
        sums = [np.zeros(size, object) for _ in range(k)]
        for b in batches:
            for _, x in _decoded(b.column(0), b.column(1), size):
                cluster, _ = _search(x, c)
                for j in np.unique(cluster).tolist():
                    own = x[cluster == j]
                    count[j] += len(own)
                    sums[j] += own.sum(axis=0).astype(object)
        met = [j for j in range(k) if count[j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array([count[j] for j in met], pa.int64()),
             pa.array([[str(v) for v in sums[j].tolist()] for j in met], pa.list_(pa.string()))],
            names=["cluster", "n", "sums"])

    parts = encoded.select("packed", "wide").mapInArrow(run, "cluster int, n long, sums array<string>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(
        F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)))
    return {r["cluster"]: (r["n"], [int(r[f"s{i}"]) for i in range(size)]) for r in total.collect()}


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, size: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row per kept vector: its id, cluster, distance (squared Euclidean,
    of the integer vectors), cluster_inertia and inertia (distances summed
    over its cluster and over all), centroid_sha256 (of its final centroid's
    components in decimal, joined by commas).

    Kept are vectors with exactly ``size`` components (a power of two), none
    null, NaN or infinite.  Centroids start as the vectors of the smallest
    SHA-256 of ``<seed>:<id>`` (null ids last; repeated ids by coefficients);
    with fewer vectors than ``clusters`` there are as many centroids.  Each
    round replaces the non-empty ones by the floor of their members' mean;
    rounds end early once none changes, as all later ones would equal them.
    Repeated rows count each.  Other columns are ignored, whatever their
    names.  A sum of distances above 64 bits, or a distance, is null; a
    component beyond 1e24 raises.  An empty table gives an empty result.
    """
    spark = df.sparkSession
    encoded = saved(_encoded(df, id_col, vector_col, size, scale), "cluster-coefficients")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = (encoded.select(key.alias("key"), "packed", "wide").orderBy(F.asc_nulls_last("key"), "packed", "wide")
             .limit(clusters).collect())
    first = [[int(v) for v in (r["wide"].split(",") if r["packed"] is None else np.frombuffer(r["packed"], "<i4"))]
             for r in start]
    c = _as_array(first) if first else np.zeros((0, size), np.int64)
    for _ in range(rounds if first else 0):
        centroids = components(c.astype(object)).tolist()
        for j, (n, sums) in _round(encoded, c).items():
            centroids[j] = [v // n for v in components(np.array([sums], object))[0]]
        new = _as_array(coefficients(np.array(centroids, object)).tolist())
        done = (new.astype(object) == c.astype(object)).all()
        c = new
        if done:
            break

    def assign(batches):
        for b in batches:
            cluster = np.zeros(b.num_rows, np.int32)
            distance: list = [None] * b.num_rows
            for rows, x in _decoded(b.column(1), b.column(2), size):
                best, d = _search(x, c)
                cluster[rows] = best
                for i, v in zip(rows.tolist(), d.tolist()):
                    distance[i] = v if v < 1 << 63 else None
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cluster), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    found = saved(encoded.select("id", "packed", "wide").mapInArrow(assign, StructType(
        [encoded.schema["id"], StructField("cluster", IntegerType()), StructField("distance", LongType())])), "clusters")
    own = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(F.when(
        F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("inertia")).collect()}
    all_of = None if None in own.values() else sum(own.values())
    fits = lambda v: None if v is None or v >= 1 << 63 else int(v)
    finals = components(c.astype(object)).tolist() if len(c) else []
    per_cluster = spark.createDataFrame(
        [(j, fits(own.get(j, 0)), fits(all_of), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
         for j, v in enumerate(finals)],
        StructType([StructField("cluster", IntegerType()), StructField("cluster_inertia", LongType()),
                    StructField("inertia", LongType()), StructField("centroid_sha256", StringType())]))
    # one row per cluster: bounded by the parameter
    return found.join(F.broadcast(per_cluster), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clusters(spark, sf_dir):
    return cluster_vectors(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
