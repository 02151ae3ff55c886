import random
import re

import numpy as np
import pytest
import xxhash

from gleaner.llm import simhash_dedup as sd

from .conftest import words

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in SPACE.split(lowered) if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=2):
    """point -> component, by comparing all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def brute(rows):
    known = [r for r in rows if r[0] is not None]
    fps = [plain_fingerprint(t) for _, t in known]
    of = plain_components(fps)
    low = {}
    for (i, _), c in zip(known, of):
        low[c] = min(low.get(c, i), i)
    out = [(i, f"{f:016x}", low[c]) for (i, _), f, c in zip(known, fps, of)]
    return sorted(out + [(None, f"{plain_fingerprint(t):016x}", None) for i, t in rows if i is None], key=repr)


def test_fingerprints_equal_the_definition(hard):
    for text in [t for _, t in hard] + ["a b", "A  b\tC\x0bd", "É é b", "x " * 5]:
        assert sd.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)
    long = " ".join(words(70_000, 3))
    whole, sd.HELD, held = sd.fingerprint(long.encode()), 1000, sd.HELD
    try:
        assert sd.fingerprint(long.encode()) == whole  # counted in pieces
    finally:
        sd.HELD = held


def scattered(n, seed, flips=3):
    """Fingerprints around few centres, so that links chain."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)] + [0, (1 << 64) - 1]
    out = set()
    while len(out) < n:
        f = rng.choice(centres)
        for _ in range(rng.randint(0, flips)):
            f ^= 1 << rng.randrange(64)
        out.add(f if rng.random() < 0.8 else rng.getrandbits(64))
    return sorted(out)


def test_pivots_discard_no_close_pair():
    fps = scattered(500, 4)
    group = np.array([i % 3 for i in range(len(fps))])
    got = {tuple(sorted((int(x), int(y)))) for xs, ys in sd.close_pairs(
        np.array(fps, np.uint64), group, sd.pivots(), 2) for x, y in zip(xs, ys)}
    assert got == {(i, j) for j in range(len(fps)) for i in range(j) if i % 3 == j % 3
                   and (fps[i] ^ fps[j]).bit_count() <= 2}
    held, sd.PAIRS = sd.PAIRS, 7
    try:  # the same in small blocks
        assert got == {tuple(sorted((int(x), int(y)))) for xs, ys in sd.close_pairs(
            np.array(fps, np.uint64), group, sd.pivots(), 2) for x, y in zip(xs, ys)}
    finally:
        sd.PAIRS = held


@pytest.mark.parametrize("group", [3, 2048])
def test_links_lose_no_component(spark, make, group):
    """Small groups: hot ones are cut again down to their last bits."""
    from gleaner.llm.jaccard_join import components

    make([])
    fps = scattered(600, 5)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = {r["node"]: r["component"] for r in components(sd.links(
        spark.createDataFrame([(f,) for f in signed], "fp long"), 2, group)).collect()}
    of = plain_components(fps)
    expected = {}
    for f, c in zip(signed, of):
        expected.setdefault(c, set()).add(f)
    got = {}
    for f in signed:
        got.setdefault(found.get(f, f), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_components_equal_brute_force(make, hard):
    rng = random.Random(8)
    base = [words(rng.randint(60, 200), 100 + i) for i in range(12)]
    rows = [(i + 100, " ".join(w)) for i, w in enumerate(base)]
    for k in range(60):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "changed"
        rows.append((500 + k, " ".join(w)))
    rows += [(5, rows[0][1]), (None, rows[0][1]), (500, rows[3][1])] + [h for h in hard if h[0] not in (7, 8, 9)]
    got = sd.simhash_components(make(rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows)
    assert sd.simhash_components(make([])).count() == 0


def test_query_on_the_table(spark):
    import pyarrow.parquet as pq

    d = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{d}/documents.parquet").to_pylist()]
    assert sorted([tuple(r) for r in sd.op13_simhash_neardup(spark, d).collect()], key=repr) == brute(rows)
