import os
import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [
    os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")]))

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", LongType()),
                   # names that operators use themselves
                   StructField("n_words", StringType()), StructField("n_tokens", StringType()),
                   StructField("spans", StringType()), StructField("size", StringType())])


@pytest.fixture(scope="session")
def make(spark):
    from gleaner.llm.common import find_package

    find_package(spark)

    def of(rows):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y", "z", "w") for r in rows]
        return spark.createDataFrame(full, DOCS)
    return of


def words(n, seed, vocabulary=300):
    rng = random.Random(seed)
    syllables = ["an", "the", "tion", "er", "ou", "re", "sta", "ble", "ing", "wha", "éo", "ñi"]
    pool = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(vocabulary)]
    return [rng.choice(pool) for _ in range(n)]


HARD = [(None, "a null id with some words in it"), (1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, "word"), (5, "word"),
        (6, "é日本 😀 \x00 x\x1cy   ok"), (7, " ".join(words(30_000, 5))), (8, "no-blank" * 40_000), (9, "aa " * 20_000)]


@pytest.fixture(scope="session")
def hard():
    return HARD
