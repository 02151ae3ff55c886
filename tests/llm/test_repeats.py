import random
import re

import pytest

from gleaner.llm import substring_dedup as sd

from .conftest import words


def brute(rows, unit, min_words):
    """Every repeated unit by one dictionary over all rows."""
    docs = sorted({(i is None, i, sd.text_hash((t or "").encode()), t or "") for i, t in rows}, key=lambda r: (r[0], r[1] or 0, r[2]))
    first, out = {}, []
    for last, i, h, t in docs:
        for start, end, digest, n in sorted(sd.units(t, unit, min_words)):
            if digest not in first:
                first[digest] = (i, h, start, end)
                continue
            j, g, at, to = first[digest]
            begin = max(start, to) if (j, g) == (i, h) else start
            if begin < end:
                times = sum(1 for r in rows if r == (i, t) or (r[0] == i and (r[1] or "") == t))
                out += [(i, begin, end, n, j, at)] * times
    return sorted(out, key=repr)


def plain_units(text, min_words):
    """Units by the definition: short lines whole, and the least of each
    ``min_words`` runs, by trying every window."""
    w = text.lower().split()
    picks = sd._picked(w, min_words)
    out = {tuple(w[i:i + min_words]) for i in picks}
    out |= {tuple(x) for x in (line.lower().split() for line in text.split("\n")) if min_words <= len(x) < 2 * min_words - 1}
    ends = re.sub(r"([.!?]+)", "\\1\n", text).split("\n")
    return out | {tuple(x) for x in (sentence.lower().split() for sentence in ends) if len(x) >= min_words}


@pytest.mark.parametrize("unit", ["paragraph", "line"])
def test_whole_result_equals_brute_force(make, hard, unit):
    rng = random.Random(5)
    base = [words(120, 40 + k) for k in range(4)]
    rows = list(hard)
    for k in range(40):
        w = words(rng.randrange(60), 500 + k)
        b = rng.choice(base)
        at = rng.randrange(60)
        w += b[at:at + rng.choice([10, 25, 45, 60])]
        w += words(rng.randrange(30), 900 + k)
        for _ in range(rng.randrange(4)):
            w.insert(rng.randrange(len(w) + 1), "\n")
        rows.append((rng.choice([100 + k, 100 + k, 100, None]), " ".join(w)))
    rows += [rows[-1], rows[-1], (5000, rows[-2][1])]
    got = sd.repeated_spans(make(rows), unit=unit)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows, unit, sd.MIN_WORDS)


def test_units_are_the_defined_ones():
    rng = random.Random(6)
    for n in (0, 19, 20, 30, 45, 200):
        w = words(n, n)
        for _ in range(n // 25):
            w.insert(rng.randrange(len(w)), "\n")
            w[rng.randrange(len(w))] += rng.choice(".!?")
        text = " ".join(w)
        got = list(sd.units(text))
        assert {tuple(text[a:b].lower().split()) for a, b, _, _ in got} == plain_units(text, 20)
        assert len({u[:2] for u in got}) == len(got) and all(len(text[a:b].split()) == c for a, b, _, c in got)


def test_rows_are_matched_by_id_and_text(make):
    p, tail, other = (" ".join(words(n, s)) for n, s in ((60, 1), (30, 2), (60, 3)))
    cut = {(r.doc_id, r.text) for r in sd.without_repeats(make([(1, p), (2, p + " " + tail), (2, other)])).collect()}
    assert (1, p) in cut and (2, other) in cut and not any(p in t for i, t in cut if i == 2)


def test_cutting_keeps_rows_and_columns(spark):
    from gleaner.llm.common import find_package

    find_package(spark)
    p = " ".join(words(30, 4))  # a line of its own: one unit, cut whole up to its ends
    df = spark.createDataFrame([(1, "a\n" + p, "x", 5), (2, p + "\nb", "y", 6), (None, p, "z", 7), (3, None, "w", 8), (4, "", "v", 9)],
                               "doc_id int, text string, removed string, __id int")
    got = sd.without_repeats(df)
    assert got.columns == ["doc_id", "text", "__id", "removed"]
    assert sorted([(r[0], r[1], r[2], [tuple(s) for s in r[3]]) for r in got.collect()], key=repr) == sorted(
        [(1, "a\n" + p, 5, []), (2, "\nb", 6, [(0, len(p))]), (None, p, 7, []), (3, None, 8, []), (4, "", 9, [])], key=repr)
    assert sd.without_repeats(df.limit(0)).count() == 0 and sd.repeated_spans(df.limit(0)).count() == 0


def test_long_text_of_many_repeats_takes_linear_time(make):
    import time

    text = " ".join(words(60, 1) * 3000)
    t0 = time.time()
    cut = sd.without_repeats(make([(1, text)])).collect()[0]
    assert len(cut.text.split()) < 200 and time.time() - t0 < 60
