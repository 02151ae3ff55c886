import math
import random
import re

import numpy as np
import pytest

from gleaner.llm import ranked_search as rs

from .conftest import words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    found = [(i, plain_terms(t)) for i, t in docs]
    found = [(i, w) for i, w in found if w]
    n_docs, n_all = len(found), sum(len(w) for _, w in found)
    df = {}
    for _, w in found:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in sorted({(i, t) for i, t in items if t is not None}, key=repr):
        asked = set(plain_terms(text))
        scored = []
        for i, w in found:
            m = 100 - 90 + (90 * len(w) * n_docs) // n_all
            s = 0
            for t in asked:
                tf = w.count(t)
                if tf:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                        (1000000000 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_terms():
    for text in ["A-b_c d9 É é日本 \x00x\x7fy😀z", "", " .,", "ÀÉ Ab1\tC3\n4", None]:
        assert [t.decode() for t in rs.terms(None if text is None else text.encode())] == plain_terms(text)


def test_largest_of_every_range():
    rng = np.random.default_rng(3)
    n_docs = 60
    key = np.sort(rng.choice(5 * n_docs, 150, replace=False))
    impact = rng.integers(1, 9, 150)
    index = rs.Index(key // n_docs, key % n_docs, impact, n_docs)
    for a in range(150):
        stop = int(np.searchsorted(key, (key[a] // n_docs + 1) * n_docs))
        for b in range(a, stop + 1):
            where, top = index.largest(np.array([a]), np.array([b]))
            assert top[0] == (impact[a:b].max() if b > a else 0)
            assert b == a or where[0] == a + impact[a:b].argmax()


@pytest.mark.parametrize("seed", range(6))
def test_search_over_blocks_is_exact(seed):
    rng = random.Random(seed)
    n_docs, n_terms, k = 200, 12, 5
    best: list = []
    everything = []
    scored = 0
    wanted = np.arange(0, n_terms, 2)
    for block in range(3):
        ids = np.sort(np.array([rng.randrange(1000) for _ in range(n_docs)]))  # repeats
        rows = [(t, d, rng.choice([1, 1, 2, 50])) for t in range(n_terms) for d in range(n_docs) if rng.random() < 0.3]
        t, d, v = (np.array(x, np.int64) for x in zip(*rows))
        scored += rs.search(rs.Index(t, d, v, n_docs), ids, wanted, k, best, block)
        total = np.zeros(n_docs, np.int64)
        for a, b, c in rows:
            if a % 2 == 0:
                total[b] += c
        everything += [(s, -i) for s, i in zip(total.tolist(), ids.tolist()) if s > 0]
    assert sorted([x[:2] for x in best], reverse=True) == sorted(everything, reverse=True)[:k]
    assert scored < 3 * n_docs  # not every document


def test_copies_are_not_all_scored():
    """Equal scores: the first k documents are enough."""
    n = 5000
    index = rs.Index(np.zeros(n, np.int64), np.arange(n), np.full(n, 7), n)
    best: list = []
    assert rs.search(index, np.arange(n), np.array([0]), 10, best, 0) < 200
    assert sorted(-i for _, i, _ in best) == list(range(10))


@pytest.fixture(scope="module")
def items(spark):
    def of(rows):
        return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, rank int, score string")
    return of


def test_ranking_equals_brute_force(make, items, hard, monkeypatch):
    rng = random.Random(4)
    pool = words(4000, 9, 80)
    docs = [(100 + i, " ".join(rng.choices(pool, k=rng.randint(1, 60)))) for i in range(150)]
    docs += [(400 + i, docs[3][1]) for i in range(30)] + [(None, docs[3][1]), (103, docs[3][1]), (103, docs[3][1])]
    docs += [h for h in hard if h[0] not in (7, 8)]
    asked = [(i, " ".join(rng.choices(pool, k=12))) for i in range(8)]
    asked += [(20, docs[3][1]), (20, docs[3][1]), (21, None), (22, " . "), (23, ""), (None, docs[5][1]), (20, docs[9][1]),
              (24, "word É"), (25, "nowhere")]
    expected = brute(docs, asked)
    got = rs.ranked(make(docs), items(asked))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == expected
    assert rs.ranked(make([]), items(asked)).count() == 0
    assert rs.ranked(make(docs), items([])).count() == 0
    monkeypatch.setattr(rs, "ITEM_BYTES", 300)  # several blocks of items
    assert rows_of(rs.ranked(make(docs), items(asked))) == expected


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    import duckdb

    from gleaner.llm.common import find_package

    find_package(spark)
    d = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    expected = con.sql(rs.RANKED_SQL)
    got = rs.op12_ranked_search(spark, d)
    assert expected.columns == got.columns
    assert rows_of(got) == sorted(expected.fetchall(), key=repr)
