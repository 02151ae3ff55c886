import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, FloatType, LongType, StringType, StructField, StructType

from gleaner.llm import centroid_clusters as cc


@pytest.fixture(scope="module")
def vectors(spark):
    from gleaner.llm.common import find_package

    find_package(spark)
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType())),
                         StructField("cluster", StringType()), StructField("id", StringType()),
                         StructField("packed", StringType())])

    def of(rows):
        return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], schema)
    return of


def brute(rows, clusters=8, rounds=10):
    """The clustering in plain Python integers, components only."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in named[:clusters]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        for j, members in groups.items():
            centroids[j] = [sum(col) // len(members) for col in zip(*members)]
    found = [(i, *assign(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, j, d in found:
        inertia[j] = inertia.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, j, d in found], key=repr)


def some(n, seed, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [rng.gauss(m, spread) for m in rng.choice(centres)]) for i in range(n)]


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_transform_is_exact_and_keeps_distances():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-2000, 2000, (2, 30, 64))
    a, b = cc.coefficients(x), cc.coefficients(y)
    assert (cc.components(a) == x).all()
    assert (((a - b) ** 2).sum(axis=1) == 64 * ((x - y) ** 2).sum(axis=1)).all()
    assert (a[:, 0] == x.sum(axis=1)).all()  # coarsest: the sum


def test_search_equals_brute_force_with_ties():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-3, 3, (400, 64)), rng.integers(-3, 3, (8, 64))
    c[5], c[3] = c[1], c[0]  # equal centroids: the smaller number wins
    best, d = cc.nearest(cc.coefficients(x), cc.coefficients(c))
    plain = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (best == plain.argmin(axis=1)).all() and (d == plain.min(axis=1)).all()
    wide = cc.nearest(cc.coefficients(x).astype(object), cc.coefficients(c).astype(object))
    assert (wide[0] == best).all() and (wide[1] == d).all()


def test_clusters_equal_brute_force(vectors):
    rows = some(300, 7)
    rows += [(1000, rows[0][1]), (3, rows[5][1]), (4, rows[4][1])]  # copies, repeated ids, repeated rows
    rows += [(1, None), (2, []), (5, [0.5] * 63), (6, [0.5] * 65), (7, [None] + [0.1] * 63),
             (8, [math.nan] * 64), (9, [math.inf] + [0.0] * 63), (10, [-math.inf] + [0.0] * 63)]
    got = cc.cluster_vectors(vectors(rows))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert dict(got.dtypes)["cluster"] == "int" and dict(got.dtypes)["inertia"] == "bigint"
    assert rows_of(got) == brute(rows)


def test_few_and_no_vectors(vectors):
    rows = some(3, 9)
    assert rows_of(cc.cluster_vectors(vectors(rows))) == brute(rows)
    same = [(i, [0.25] * 64) for i in range(20)]
    assert rows_of(cc.cluster_vectors(vectors(same))) == brute(same)
    assert cc.cluster_vectors(vectors([])).count() == 0
    assert cc.cluster_vectors(vectors([(1, None), (2, [1.0])])).count() == 0


def test_null_ids_are_clustered_but_start_nothing(vectors):
    rows = some(40, 11)
    assert rows_of(cc.cluster_vectors(vectors(rows + [(None, v) for _, v in rows[:5]]))) == brute(
        rows + [(None, v) for _, v in rows[:5]])


def test_large_components(vectors):
    rows = some(30, 13) + [(100, [3e5 * (1 + j % 3) for j in range(64)]), (101, [-7e6] * 64)]
    assert rows_of(cc.cluster_vectors(vectors(rows))) == brute(rows)
    beyond = rows + [(102, [1e15] + [0.0] * 63)]
    got = cc.cluster_vectors(vectors(beyond), rounds=1).collect()
    assert len(got) == len(beyond)
    with pytest.raises(Exception, match="too large"):
        cc.cluster_vectors(vectors([(1, [1e30] * 64)])).collect()


def test_query_on_the_table(spark):
    import pyarrow.parquet as pq

    d = "/root/testdata/sf0.001"
    table = pq.read_table(f"{d}/embeddings.parquet").to_pylist()
    assert rows_of(cc.op11_centroid_clusters(spark, d)) == brute([(r["vec_id"], r["embedding"]) for r in table])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    import duckdb

    from gleaner.llm.clusters_sql import CLUSTERS_SQL
    from gleaner.llm.common import find_package

    find_package(spark)
    d = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    expected = con.sql(CLUSTERS_SQL)
    got = cc.op11_centroid_clusters(spark, d)
    assert sorted(expected.columns) == sorted(got.columns)
    assert rows_of(got.select(*expected.columns)) == sorted(expected.fetchall(), key=repr)
