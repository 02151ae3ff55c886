"""Recall of CGK walks and bit sampling, held against the exact search."""

import random

import numpy as np
import pytest

from gleaner.llm import decontaminate as dc

from .conftest import words


def _planted(n, share, trials=150):
    rng = random.Random(1000 * n + int(100 * share))
    pool = ["i%d" % k for k in range(400)]
    items = [[rng.choice(pool) for _ in range(n)] for _ in range(8)]
    texts, owners = [], []
    for k in range(trials):
        w = list(items[k % 8])
        for _ in range(int(share * n)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], ["zz"], [w[at], "yy"], [rng.choice(pool)]])
        before = rng.choice([0, 1, 2, 3, 5, rng.randrange(300)])
        texts.append(" ".join(words(before, k) + w + words(rng.choice([0, 1, 90]), k + 99)).encode())
        owners.append(k % 8)
    block = [(i, [w.encode() for w in item]) for i, item in enumerate(items)]
    return block, texts, owners


@pytest.mark.parametrize("share", [0, 0.1, 0.2])
@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 16, 17, 18, 24, 32, 33, 38, 40, 59, 70, 200])
def test_recall_of_every_length(n, share):
    block, texts, owners = _planted(n, share)
    exact = {m[:2]: m[2:] for m in dc.Index(block, 0.2).matches(texts)}
    found = {m[:2]: m[2:] for m in dc.Sampled(block, 0.2).matches(texts)}
    planted = {(row, own) for row, own in enumerate(owners)}
    assert planted <= set(exact)
    assert len(planted & set(found)) >= 0.9 * len(planted)
    assert set(found) <= set(exact) and all(found[k][2] <= int(0.2 * n) for k in found)  # verified
    if share == 0:
        assert planted <= set(found)  # word by word: always met


def test_short_items_are_searched(make, spark):
    bench = spark.createDataFrame([(1, "seven words stand here in a row"), (2, "one"), (3, ""), (4, None), (5, ",.")],
                                  "item_id long, text string")
    got = dc.leaks(make([(1, "x seven words stand here in a row y"), (2, "no such thing"), (3, "there is ONE, here"), (4, None),
                         (5, "")]), bench)
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got.collect()) == [(1, 1, 0), (3, 2, 0)]


@pytest.mark.parametrize("max_edit", [0.0, 0.05, 0.1, 0.3])
def test_other_shares_of_edits(max_edit):
    n = 40
    block, texts, owners = _planted(n, max_edit)
    found = {m[:2] for m in dc.Sampled(block, max_edit).matches(texts)}
    planted = {(row, own) for row, own in enumerate(owners)}
    assert len(planted & found) >= 0.9 * len(planted)


def test_walks_fall_into_step_again():
    """One edit at the start leaves most of the embedding as it was."""
    rng = np.random.default_rng(3)
    size, near, far = 12, [], []
    for k in range(60):
        a = rng.integers(1, 100, size).astype(np.int32)
        b = np.append(a[1:], rng.integers(1, 100)).astype(np.int32)  # first word dropped
        c = rng.integers(1, 100, size).astype(np.int32)
        walks = dc.Walks(size, 100, 30, k)
        x, y, z = (np.array([key[0] for key in walks.keys(t)]) for t in (a, b, c))
        near.append((x == y).mean())
        far.append((x == z).mean())
    assert np.mean(near) > 0.02 and np.mean(far) == 0


def test_tables_follow_from_the_recall():
    assert dc.tables_for(5, 0.5) < dc.tables_for(5, 0.9) < dc.tables_for(5, 0.99)
    assert dc.tables_for(5) == dc.tables_for(5)
