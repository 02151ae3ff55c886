"""Columns named like the operators' own, and empty tables."""

import pytest
from pyspark.sql import functions as F

from gleaner.llm import (mixing as mx, pii, quality_rules as qr, secret_scan as ss, substring_dedup as sd, token_counts as tc,
                         token_files as tf)

from .conftest import words

OWN = ("__text", "__assign", "__base", "__added", "__s", "__id", "__copies", "__tie", "__n", "__row", "in0", "in1", "text_", "t",
       "row", "key", "pick", "bucket", "__spans", "tie", "n")


@pytest.fixture(scope="module")
def clashing(spark, make):
    rows = [(i, " ".join(words(60 + i, i)) + f" mail a{i}@host.org token={'k7Qp' * 3}{i}") for i in range(4)] + [(None, None), (9, "")]
    df = make(rows).select("doc_id", "text", "lang", "source", "n_chars")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in OWN])


OPERATORS = [(tc.token_counts, {}), (pii.find_pii, {}), (ss.scan, {}), (qr.judged, {}), (qr.kept_documents, {}), (mx.mixed, {}),
             (sd.without_repeats, {})]


@pytest.mark.parametrize("operator", [o for o, _ in OPERATORS], ids=lambda o: o.__name__)
def test_columns_named_like_internal_ones_pass(clashing, operator):
    plain = operator(clashing.select("doc_id", "text", "lang", "source", "n_chars"))
    got = operator(clashing)
    kept = [c for c in OWN if c in got.columns]
    assert kept == list(OWN)
    for r in got.select(*OWN).collect():
        assert tuple(r) == tuple(f"own {c}" for c in OWN)
    assert sorted(map(repr, got.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_empty_tables(make, spark, tmp_path):
    empty = make([])
    for operator, _ in OPERATORS:
        got = operator(empty)
        assert got.count() == 0 and "doc_id" in got.columns
    manifest = tf.write_token_files(empty)
    assert manifest.count() == 0 and tf.read_token_files(manifest).count() == 0
    import corpus_pipeline as cp

    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "some words of an item")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = cp.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
