"""Joins, dedup, decontamination, mixing, rules, scans and scoring: against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gleaner.llm import (decontaminate as dc, jaccard_join as jj, lm_scoring as lm, mixing as mx,
                         quality_rules as qr, secret_scan as ss, substring_dedup as sd)
from tests.llm.conftest import words


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [(i, grams(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and sets[x][0] is not None and sets[y][0] is not None and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(x)] = root(y)
    low = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            low[root(x)] = min(low.get(root(x), i), i)
    return sorted((i is None, i or 0, len(s), low.get(root(x)) if i is not None else None) for x, (i, s) in enumerate(sets))


def family(seed, copies, n, edits):
    rng, base = random.Random(seed), words(n, seed)
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(n)] = "q%d" % rng.randrange(10**6)
        yield " ".join(w)


def test_components(make, hard):
    rows = [r for r in hard]
    texts = [*family(1, 40, 60, 4), *family(2, 30, 100, 6), *family(3, 20, 8, 1), *family(4, 60, 40, 2)]
    passage = " ".join(words(30, 99))
    texts += [passage + " " + " ".join(words(k % 40, k)) for k in range(40)]
    texts += ["A b", "a B", "a b c d e", "a b c d e f", "x " * 50, "x " * 60]
    rows += list(enumerate(texts, 100))
    got = jj.jaccard_components(make(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == brute_components(rows)
    assert jj.jaccard_components(make([])).count() == 0


def test_pairs_lose_no_link():
    rng = np.random.default_rng(0)
    for trial in range(20):
        n = rng.integers(2, 90)
        t, m = rng.integers(0, 4, n), rng.integers(0, 12, n)
        got = {(int(x), int(y)) for a, b in jj._pairs(t, np.full(n, 10), np.zeros(n, np.int64), np.arange(n), m, 80)
               for x, y in zip(a, b)}
        want = {(x, y) for x in range(n) for y in range(x) if t[x] == t[y] and m[x] != m[y]}
        assert got == want


def test_repeated_spans(make, hard):
    passage = " ".join(words(60, 7)).capitalize() + ". " + " ".join(words(30, 8)).capitalize() + "."
    rows = hard + [(10, "Intro here. " + passage + " End of it."), (11, "Other words.\n" + passage.upper()),
                   (12, " ".join(words(40, 50)) + "."), (13, passage + " " + passage)]
    got = [r for r in sd.repeated_spans(make(rows)).collect()]
    assert {r.doc_id for r in got if r.doc_id != 9} >= {11, 13} and 10 not in {r.doc_id for r in got}
    assert 12 not in {r.doc_id for r in got}
    cut = {r.doc_id: r for r in sd.without_repeats(make(rows)).collect()}
    assert cut[10].text == rows[len(hard)][1] and cut[11].text.split() == ["Other", "words."]
    text = rows[-1][1]
    assert "".join(text[s.start:s.end] for s in cut[13].removed).count(".") >= 4  # both copies went
    lines = sd.repeated_spans(make([(1, "x y\n" + passage), (2, passage + "\nz")]), unit="line").collect()
    assert [(r.doc_id, r.start, r.keep_doc_id, r.keep_start) for r in lines] == [(2, 0, 1, 4)]


def test_shared_stretch_without_sentence_ends(make):
    rng, size = random.Random(11), 2 * sd.MIN_WORDS - 1
    for trial in range(200):
        shared = words(size, trial, 300 if trial % 4 else 2)  # also with equal runs
        texts = [words(rng.randrange(80), 1000 + trial) + shared + words(rng.randrange(80), 2000 + trial),
                 words(rng.randrange(80), 3000 + trial) + [w.upper() for w in shared] + words(rng.randrange(80), 4000 + trial)]
        a, b = ({u[2] for u in sd.units(" ".join(t))} for t in texts)
        assert a & b, trial
    # sentences that merge with other words at both ends, and none at all
    for n, stop in ((60, ""), (150, "."), (150, "")):
        passage = words(n, n)
        texts = [" ".join(words(40, k)) + " lead " + " ".join(passage) + stop + " tail " + " ".join(words(25, k + 9)) for k in (70, 90)]
        cut = [r for r in sd.without_repeats(make(list(enumerate(texts)))).collect()]
        gone = {r.doc_id: " ".join(texts[r.doc_id][s.start:s.end] for s in r.removed) for r in cut}
        assert not gone[0] and gone[1] in texts[0]
        assert len(gone[1].split()) >= n - 2 * (sd.MIN_WORDS - 1)


def test_picked_runs_cover():
    for n in (0, 19, 20, 21, 38, 39, 40, 500):
        for vocabulary in (1, 2, 300):
            w = words(n, n, vocabulary)
            picks = sd._picked(w, 20)
            assert picks == sorted(set(picks)) and all(p + 20 <= n for p in picks)
            assert bool(picks) == (n >= 20) and all(b - a <= 20 for a, b in zip(picks, picks[1:]))
            if n >= 39:
                assert picks[0] < 20 and n - 20 - picks[-1] < 20
            if vocabulary == 1:
                assert len(picks) <= 1 + n // 20


def edit(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row = row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1)
    return min(row)


def test_decontamination_recall(make, hard, spark):
    rng = random.Random(5)
    items = [(i, " ".join(words(rng.randint(12, 70), 1000 + i))) for i in range(40)] + [(90, None), (91, "too short")]
    rows, planted = list(hard), set()
    for k in range(120):
        item, text = items[k % 40]
        w = text.split()
        for _ in range(int(0.1 * len(w) * rng.random())):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], ["zz"], [w[at], "yy"]])
        body = words(rng.randint(0, 200), 7000 + k)
        at = rng.randint(0, len(body))
        rows.append((100 + k, " ".join(body[:at] + [", ".join(w).upper() if k % 5 == 0 else " ".join(w)] + body[at:])))
        planted.add((100 + k, item))
    rows += [(500 + k, " ".join(words(200, 9000 + k))) for k in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.leaks(make(rows), bench).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert len(pairs & planted) >= 0.98 * len(planted) and not {d for d, _ in pairs if d >= 500}
    texts = dict(rows)
    by_id = dict(items)
    for r in got[:40]:
        item = dc.words_of(by_id[r.item_id].encode())
        found = dc.words_of(texts[r.doc_id].encode())
        assert r.distance == edit(item, found) and r.distance <= 0.2 * len(item)
    clean = dc.without_leaks(make(rows), bench)
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r[0] for r in rows} - {d for d, _ in pairs}
    assert clean.columns == make([]).columns
    assert dc.leaks(make([]), bench).count() == 0 and dc.leaks(make(rows), bench.limit(0)).count() == 0


@pytest.mark.parametrize("share", [0, 0.1, 0.2])
@pytest.mark.parametrize("n", [8, 10, 15, 16, 17, 18, 32, 33, 38, 40, 70])
def test_decontamination_loses_no_length(n, share):
    rng = random.Random(n)
    item = ["i%d" % rng.randrange(10**6) for _ in range(n)]
    other = [["o%d" % rng.randrange(10**6) for _ in range(n)] for _ in range(5)]
    index = dc.Index([(0, [w.encode() for w in item])] + [(1 + k, [w.encode() for w in ws]) for k, ws in enumerate(other)], 0.2)
    texts = []
    for k in range(60):
        w = list(item)
        for _ in range(int(share * n)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], ["zz"], [w[at], "yy"]])
        before = rng.choice([0, 1, 2, 3, 4, 5, rng.randrange(300)])
        texts.append(" ".join(words(before, k) + w + words(rng.choice([0, 1, 90]), k + 99)).encode())
    got = {row: (start, size, distance) for row, i, start, size, distance in index.matches(texts) if i == 0}
    assert sorted(got) == list(range(60))  # recall 1
    for row, (start, size, distance) in got.items():
        found = [w.decode() for w in dc.words_of(texts[row])][start:start + size]
        assert distance == edit(item, found) <= int(share * n)


def water(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > 2 * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mixing(make, hard):
    rng = random.Random(2)
    rows = [(*r, "h") for r in hard] + [(100 + i, "w " * rng.randint(1, 80), rng.choice(["a", "b", "B", None, "é"]))
                                        for i in range(600)]
    rows += [(100, rows[len(hard)][1], rows[len(hard)][2])]
    df = make(rows)
    got = mx.mix(df).collect()
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    for s, t in water(sizes).items():
        assert abs(next(r.target for r in got if r.source == s) - t) < 1e-6 * max(1, t)
        # "h" holds texts of 30,000 and 20,000 words and few small ones
        assert abs(taken[s] - t) <= (1 if s != "h" else 10_000)
    again = mx.mix(make(rows[::-1])).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.tie, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    out = mx.mixed(df)
    assert out.columns == df.columns
    assert Counter(r.source for r in out.collect() for _ in (r.text or "").split()) == +taken
    assert mx.mix(make([])).count() == 0


@pytest.mark.parametrize("budget", [0, 1, 7, 100, 999, 5000, 10**6])
def test_fit_is_nearest(budget):
    lengths, counts = np.array([0, 3, 7, 50, 4000]), np.array([5, 4, 9, 11, 2])
    take = mx.fit(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    reach = {0}
    for size, n in zip(lengths.tolist(), counts.tolist()):
        reach = {r + size * k for r in reach for k in range(n + 1)}
    assert abs(int((take * lengths).sum()) - budget) == min(abs(r - budget) for r in reach)


def measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    g, inside = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if g[tuple(w[i:i + 3])] > 1:
            inside.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))


def test_quality_rules(make, hard):
    rng = random.Random(4)
    rows = list(hard)
    for k in range(80):
        w = [x[:5] for x in words(rng.randint(60, 200), k)]
        rows.append((100 + k, ". ".join([" ".join(w[:30]), " ".join(w[30:])])))
        if k < 12:
            rows.append((300 + k, " ".join(x + "###$$$" for x in w)))
            rows.append((400 + k, "!! ".join(w).upper() + "!!"))
    rows.append((500, "a\nb\na\n \n\na b c a b c"))
    got = {(r.doc_id, r.n_words): r for r in qr.judged(make(rows)).collect()}
    for i, t in rows:
        m = measures(t)
        r = got[i, m[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and not (r.base_failed and r.kept)
        assert not (i or 0) >= 300 or not r.kept
        assert not 100 <= (i or 0) < 300 or r.base_failed or r.kept
    kept = qr.kept_documents(make(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for (i, _), r in got.items() if r.kept)
    assert kept.columns == make([]).columns and qr.judged(make([])).count() == 0


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def known(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(spans)


def test_secret_scan(make, hard):
    rng = random.Random(6)
    parts = ["token=", "secret: ", "Api_KEY = '", "abcd1234", "AKIA", "ABCD1234EFGH", "0123456789abcdef", "é", " ", "\n", "x"]
    rows = hard + [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))) for i in range(300)]
    rows += [(900, "key kJ8x2Qp0ZtR5vLw9YbN3mC7s end"), (901, "id 123e4567-e89b-12d3-a456-426614174000 ok"),
             (902, "aaaaaaaaaaaaaaaaaaaaaaaa1 and wordswithoutanydigits_inthem")]
    got = {(r.doc_id, i): r for i, r in enumerate(ss.scan(make(rows)).collect())}
    by_id = {r.doc_id: r for r in got.values()}
    for i, t in rows:
        line = ",".join(f"{ss.KINDS[k]}:{s}:{e}" for s, k, e in known(t or ""))
        assert by_id[i].base_sha256 == hashlib.sha256(line.encode()).hexdigest(), t
        assert set(filter(None, line.split(","))) <= set(by_id[i].spans.split(","))
    assert by_id[900].spans == "entropy:4:28" and by_id[901].spans == "" and by_id[902].spans == ""
    assert ss.scan(make([])).count() == 0


def test_harmless_words_suppress_only_themselves(make):
    secret = "kJ8x2Qp0ZtR5vLw9YbN3mC7s"
    shown = ["sample_key=" + secret, "files/samples/" + secret, secret + "/Example", "placeholder-" + secret + "-xxxxxxx"]
    hidden = ["sample_key_example_1_of_placeholders", "kJ8x2Qp0ZxxxxxxR5vLw9YbN3mC", "samples/123e4567-e89b-12d3-a456-426614174000",
              "example_20240102030405060708", "changeme1changeme2changeme3"]
    got = {r.doc_id: r.spans for r in ss.scan(make(list(enumerate(f"a {t} b" for t in shown + hidden)))).collect()}
    assert got == {i: f"entropy:2:{2 + len(t)}" if t in shown else "" for i, t in enumerate(shown + hidden)}


def test_window_entropy(spark):
    from pyspark.sql import functions as F

    texts = ["a" * 25, "kJ8x2Qp0ZtR5vLw9YbN3mC7s", "abcdefghij" * 3, "short", "aabbccddeeffgghhiijj11223344"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", ss.highest_entropy(F.col("s")).alias("h"))
    for r in df.collect():
        best = max([-sum(c / 20 * math.log2(c / 20) for c in Counter(r.s[i:i + 20]).values())
                    for i in range(len(r.s) - 19)] or [0.0])
        assert abs(r.h - best) < 1e-9


def test_gradients():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in lm.new_parameters(np.zeros(lm.CLASSES)).items()}
    x, y, _ = lm.layout([rng.integers(0, lm.CLASSES, 40).astype(np.int32), np.array([lm.BOS, 5, 0], np.int32)])
    _, g = lm.gradients(p, x, y)
    for k in p:
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in p[k].shape)
            if k == "E":
                at = (int(x[0, -1]) if x[0, -1] < lm.CLASSES else 5, at[1])
            losses = []
            for d in (1e-4, -1e-4):
                q = {n: v.copy() for n, v in p.items()}
                q[k][at] += d
                losses.append(lm.gradients(q, x, y)[0])
            assert abs((losses[0] - losses[1]) / 2e-4 - g[k][at]) < 1e-4


def test_each_target_once_and_causal():
    rng = np.random.default_rng(2)
    sequences = [rng.integers(2, lm.CLASSES, n).astype(np.int32) for n in (1, 2, 16, 17, 18, 100)]
    x, y, owner = lm.layout(sequences)
    for i, s in enumerate(sequences):
        got = y[owner == i]
        assert got[got >= 0].tolist() == s[1:].tolist()
    p = lm.new_parameters(np.zeros(lm.CLASSES))
    a, _ = lm.forward(p, x)
    assert np.allclose(np.exp(a).sum(axis=2), 1, atol=1e-4)
    z = x.copy()
    z[:, -4:] = 7  # inputs of the last targets don't reach the earlier ones
    b, _ = lm.forward(p, z)
    assert np.allclose(a[:, :-4], b[:, :-4], atol=1e-5)
    live = y >= 0
    assert np.allclose(lm.target_scores(p, x, y), np.take_along_axis(a, np.maximum(y, 0)[..., None], 2)[..., 0][live], atol=1e-4)


def test_scores(make, hard):
    rows = hard + [(100 + i, " ".join(words(80, i % 3, 40))) for i in range(200)]
    got = lm.lm_scores(make(rows)).collect()
    c = Counter()

    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)})) + [""]

    held = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2
    for i, t in rows:
        if not held(i):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((i is None, i or 0, held(i), len(w := tokens(t)), sum(x in c for x in w), n,
                   round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 4)) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm.lm_scores(make([])).count() == 0


def test_order_among_rare_ids_counts():
    rng = np.random.default_rng(5)
    size, rare = 900, np.array([700, 750, 800, 820, 860, 890])
    coder = lm.Coder({i: 10_000 - i for i in range(600)} | {int(i): 3 for i in rare}, size)
    p = lm.new_parameters(coder.log_class, coder.log_member)
    assert len(set(coder.of.tolist())) == size and (coder.of[rare] >= lm.FIRST).all()
    x, y, _ = lm.layout([coder.sequence(rng.integers(0, size, 40)) for _ in range(4)])
    p |= {k: rng.normal(0, 0.3, p[k].shape).astype(np.float64) for k in ("E", "V")}
    p = {k: v.astype(np.float64) for k, v in p.items()}
    one = np.full((size + 1, lm.CONTEXT + lm.STEP), lm.PAD, np.int32)  # the first target after BOS and two ids
    one[:, lm.CONTEXT:lm.CONTEXT + 3] = [lm.BOS, coder.of[700], coder.of[3]]
    goal = np.full((size + 1, lm.STEP), -1, np.int32)
    goal[:, 2] = [*coder.of, lm.END]
    assert abs(np.exp(lm.target_scores(p, one, goal)).sum() - 1) < 1e-3  # float32 shares of empty classes
    _, g = lm.gradients(p, x, y)
    for k in p:
        top = np.unravel_index(np.argsort(-np.abs(g[k]), axis=None)[:3], g[k].shape)
        for at in zip(*top):
            losses = []
            for d in (1e-4, -1e-4):
                q = {n: v.copy() for n, v in p.items()}
                q[k][at] += d
                losses.append(lm.gradients(q, x, y)[0])
            assert abs((losses[0] - losses[1]) / 2e-4 - g[k][at]) < 1e-4
    assert abs(lm.gradients(p, x, y)[0] + lm.target_scores(p, x, y).mean()) < 1e-4
    p = lm.new_parameters(coder.log_class, coder.log_member)
    x, y, _ = lm.layout([coder.sequence(np.tile(rare, 10)) for _ in range(300)])
    for r in range(4):
        p, _ = lm.train(p, ((x[i:i + 32], y[i:i + 32]) for i in range(0, len(x), 32)), r)
    right, wrong = coder.scores(p, [np.tile(rare, 5), np.tile(rare[[0, 2, 1, 4, 3, 5]], 5)])
    assert right > wrong + 5


def test_every_training_token_counts_and_trains(make, hard, monkeypatch):
    from gleaner.llm.token_files import default_tokenizer, encoder

    rows = hard + [(100 + i, " ".join(words(i % 60, i))) for i in range(80)]  # mostly short
    seen = {}
    fitted = lm.fitted
    monkeypatch.setattr(lm, "fitted", lambda t, coder: seen.update(coder=coder, rows=t.select("ids").collect()) or fitted(t, coder))
    made = lm.Coder.__init__
    monkeypatch.setattr(lm.Coder, "__init__", lambda self, counts, size: seen.update(counts=counts) or made(self, counts, size))
    assert lm.lm_scores(make(rows)).count() == len(rows)
    enc = encoder(default_tokenizer())
    want = [tuple(np.frombuffer(enc.text((t or "").encode()), "<u4").tolist()) for i, t in rows
            if zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2]
    got = [tuple(np.frombuffer(r.ids, seen["coder"].kind).tolist()) for r in seen["rows"]]
    assert Counter(got) == Counter(want)
    assert seen["counts"] == Counter(x for ids in want for x in ids)
    for n in (2, 3, lm.PART, lm.PART + 1, lm.PART + 2, 3 * lm.PART + 5):  # each target once
        assert [t for part in lm.parts(np.arange(n)) for t in part[1:].tolist()] == list(range(1, n))


def test_model_learns():
    rng = np.random.default_rng(3)
    text = [np.concatenate([[lm.BOS], np.tile(rng.permutation(np.arange(2, 8)), 20), [0]]).astype(np.int32) for _ in range(400)]
    x, y, _ = lm.layout(text[:350])
    p = lm.new_parameters(np.zeros(lm.CLASSES))
    for r in range(6):
        p, _ = lm.train(p, ((x[i:i + 32], y[i:i + 32]) for i in range(0, len(x), 32)), r)
    hx, hy, _ = lm.layout(text[350:])
    assert -lm.target_scores(p, hx, hy).mean() < 1.2  # uniform over the six classes in use is 1.79


def test_pipeline_stages(make, hard, spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(8)
    items = [(i, " ".join(words(30, 2000 + i))) for i in range(5)]
    texts = [" ".join(words(rng.randint(60, 120), 50 + k)) + "." for k in range(60)]
    texts += [texts[0], texts[1] + " more"] + [texts[2] + " " + items[0][1]]
    rows = list(hard) + [(100 + i, t, "ab"[i % 2]) for i, t in enumerate(texts)]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    quality = cp.quality_rules(spark, docs, str(tmp_path))
    ids = {r.doc_id for r in quality.collect()}
    near = cp.jaccard_join(spark, quality, str(tmp_path))
    left = [r.doc_id for r in near.collect()]
    groups = {i: c for _, i, _, c in brute_components([(r.doc_id, r.text) for r in quality.collect()])}
    assert sorted(left) == sorted({c for c in groups.values() if c is not None} | ({None} & ids))
    clean = cp.decontamination(spark, near, str(tmp_path))
    assert {r.doc_id for r in clean.collect()} == set(left) - {162}
    final = cp.run(spark, str(tmp_path)).collect()
    mixed = Counter({r.doc_id: r.copies for r in mx.mix(clean).collect()})
    assert Counter(r.doc_id for r in final) == +mixed
    order = sorted(final, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted(r.doc_id for r in final)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(order, order[1:]))
