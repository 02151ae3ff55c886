"""Token counts, token files, personal data: against brute force and round trips."""
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql.types import LongType, StructField

from gleaner.llm import pii, token_counts as tc, token_files as tf
from tests.llm.conftest import words


def test_counts_equal_the_tokenizer(make, hard):
    import sentencepiece
    from tokenizers import Tokenizer, models, pre_tokenizers

    sp = sentencepiece.SentencePieceProcessor(model_file=tc.default_vocabulary())
    exact = Tokenizer(models.Unigram([(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())], 0, True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace()
    rows = [r for r in hard if r[0] != 8] + [(20 + i, t) for i, t in enumerate(
        [" lead", "a  b", "▁x", "тест日本語", "a▁b c", " ".join(words(400, 1)), "\n\n a\tb", "x" * 300])]
    got = tc.token_counts(make(rows), carry=["doc_id"]).collect()
    assert len(got) == len(rows)
    want = sorted(((r[0] is None, r[0] or 0), len(exact.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert sorted(((g.doc_id is None, g.doc_id or 0), g.n_tokens) for g in got) == want


def test_ties_go_to_the_longest_last_piece():
    c = tc.PieceCounter([("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0)])
    assert c.unit("▁a") == (1, -2.0)  # "▁a" ties with "▁" + "a": the earlier start came first
    assert c.unit("▁aa")[1] == -3.0
    assert c.unit("▁é") == (3, -13.0)  # two bytes of the unknown character


def test_clashing_columns_are_replaced(make):
    out = tc.token_counts(make([(1, "a b")]))
    assert out.columns.count("n_tokens") == 1 and out.first().n_tokens > 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 50, n).astype(np.uint32)
    ids[rng.random(n) < 0.05] = 4_000_000_000
    ids[rng.random(n) < 0.03] += 70_000
    doc_ids, lengths, back = tf.read_shard(tf.shard_bytes([5, None], [n, 0], ids))
    assert doc_ids == [5, None] and lengths.tolist() == [n, 0] and (back == ids).all()
    starts, _, widths, exceptions, _ = tf.pack(ids)
    assert len(starts) == -(-n // tf.BLOCK)
    if n == 5000:
        assert exceptions.any() and (widths < 32).all()


def test_token_files(make, hard, spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tf.default_tokenizer())
    rows = hard + [(i, " ".join(words(50, i)).replace("the", "The, <|endoftext|>") + " don't stop.") for i in range(30, 60)]
    manifest = tf.write_token_files(make(rows), shard_ids=5000)
    assert manifest.count() > 1
    got = sorted(map(tuple, tf.read_token_files(manifest).collect()), key=lambda r: r[1])
    start = 0
    for r, (doc_id, text) in zip(got, sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0))):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert r == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def brute(text):
    kinds = {
        "email": lambda: [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": lambda: [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
                       if all(int(p) <= 255 for p in m.group().split("."))],
        "card": lambda: [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
                         if 12 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and pii.luhn(d)],
        "phone": lambda: [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                          if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]}
    return {k: f() for k, f in kinds.items()}


def test_plain_spans_against_patterns():
    import random

    rng = random.Random(3)
    parts = ["a@b.c", "@", ".", "1", "25", "255", "256", " ", "-", "+4", "(", ")", "4111 1111 1111 1111", "x", "@b", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert pii.plain(text) == brute(text), text


@pytest.mark.parametrize("text,kind,source", [
    ("mail j.doe (at) host [dot] org now", "email", "j.doe (at) host [dot] org"),
    ("mail jane at host dot org now", "email", "jane at host dot org"),
    ("mail jоe@hоst.org now", "email", "jоe@hоst.org"),
    ("call plus four nine one five two two five five five five now", "phone", "plus four nine one five two two five five five five"),
    ("ip １９２.168.0.1 x", "ip", "１９２.168.0.1"),
    ("card four one one one 1 1 1 1 one one one one 1 1 1 one", "card", "four one one one 1 1 1 1 one one one one 1 1 1 one"),
])
def test_disguises_map_back(text, kind, source):
    base, added = pii.find(text)
    assert [text[s:e] for s, e in added[kind]] == [source]


@pytest.mark.parametrize("text,kind,source", [
    ("host 192[.]168[.]0[.]1 up", "ip", "192[.]168[.]0[.]1"),
    ("host 10 (dot) 0 (dot) 0 (dot) 7 up", "ip", "10 (dot) 0 (dot) 0 (dot) 7"),
    ("host 10{punto}0{punto}0{punto}7 up", "ip", "10{punto}0{punto}0{punto}7"),
    ("mail jane at host [dot] org now", "email", "jane at host [dot] org"),
    ("mail jane at mail dot host (punkt) org now", "email", "jane at mail dot host (punkt) org"),
    ("mail jane [at] host dot org now", "email", "jane [at] host dot org"),
    ("call +1 555 eight six seven 5309 now", "phone", "+1 555 eight six seven 5309"),
    ("call +1 (555) eight six seven 5309 now", "phone", "+1 (555) eight six seven 5309"),
    ("card 4111 1111 one one one one 1111 now", "card", "4111 1111 one one one one 1111"),
    ("12, four one one one 1 1 1 1 one one one one 1 1 1 one", "card", "four one one one 1 1 1 1 one one one one 1 1 1 one"),
])
def test_disguises_without_a_sign(text, kind, source):
    assert "@" not in text
    base, added = pii.find(text)
    assert [text[s:e] for s, e in added[kind]] == [source] and not any(base.values())


def test_blanks_and_wraps_take_linear_time():
    import time

    start = time.time()
    for text in (" " * 300_000 + "(dot)", "(dot) " * 30_000, "a at b" + " [dot] c" * 30_000):
        pii.find(text)
    assert time.time() - start < 20


def test_pii_rows(make, hard):
    rows = hard + [(30, "a@b.cd x 10.0.0.1"), (31, "1" * 200_000), (32, "a@" * 50_000)]
    got = {r.doc_id: r for r in pii.find_pii(make(rows)).collect()}
    assert got[30].spans == "email:0:6,ip:9:17" and got[30].n_email == 1 and got[30].n_ip == 1
    assert got[30].base_sha256 == hashlib.sha256(b"email:0:6,ip:9:17").hexdigest()
    assert got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(make([])).count() == 0


def test_texts_reach_workers_in_small_batches(make, spark):
    from gleaner.llm.common import BATCH_BYTES, map_texts

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key)
    df = make([(i, "x" * 50_000) for i in range(400)]).coalesce(1)
    sizes = lambda: lambda texts: [[sum(map(len, texts))] * len(texts)]
    try:
        for limit in ("67108864b", "1m"):  # Spark's own, and one that the session was given
            spark.conf.set(key, limit)
            got = [r.held for r in map_texts(df, "text", sizes, [StructField("held", LongType())]).collect()]
            assert len(got) == 400 and max(got) <= (BATCH_BYTES if limit != "1m" else 1 << 20) + 100_000
    finally:
        spark.conf.set(key, was)
