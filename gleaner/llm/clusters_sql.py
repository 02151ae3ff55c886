"""The clustering of ``op11_centroid_clusters`` as DuckDB SQL, its rounds
written out one after the other."""

from __future__ import annotations

from gleaner.llm.centroid_clusters import CLUSTERS, DIMENSIONS, ROUNDS, SCALE, SEED

_START = f"""
numbered AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
parts AS MATERIALIZED (
  SELECT r, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM numbered),
kept AS MATERIALIZED (
  SELECT r FROM parts GROUP BY r
  HAVING count(*) = {DIMENSIONS} AND count(x) = {DIMENSIONS} AND bool_and(isfinite(coalesce(x, 0)))),
v AS MATERIALIZED (SELECT r, i, CAST(floor({SCALE} * x) AS BIGINT) AS x FROM parts WHERE r IN (SELECT r FROM kept)),
first AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST) - 1 AS c, r
  FROM numbered WHERE r IN (SELECT r FROM kept) ORDER BY c LIMIT {CLUSTERS}),
c0 AS MATERIALIZED (SELECT c, i, x FROM first JOIN v USING (r))"""


def _assigned(k: int) -> str:
    return f"""
d{k} AS MATERIALIZED (
  SELECT v.r, c{k}.c, CAST(sum((v.x - c{k}.x) * (v.x - c{k}.x)) AS BIGINT) AS d FROM v JOIN c{k} USING (i) GROUP BY ALL),
a{k} AS MATERIALIZED (
  SELECT r, c, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""


def _moved(k: int) -> str:
    """Floor of the members' mean: the sum less its remainder, which is never negative."""
    return f"""
c{k + 1} AS MATERIALIZED (
  SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x
  FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{k} JOIN v USING (r) GROUP BY c, i)
  UNION ALL SELECT c, i, x FROM c{k} WHERE c NOT IN (SELECT c FROM a{k}))"""


CLUSTERS_SQL = "WITH" + ",".join([_START, *(part for k in range(ROUNDS) for part in (_assigned(k), _moved(k))),
                                  _assigned(ROUNDS)]) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.sha AS centroid_sha256
FROM a{ROUNDS} a JOIN numbered USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS sha FROM c{ROUNDS} GROUP BY c) h ON h.c = a.c
"""
