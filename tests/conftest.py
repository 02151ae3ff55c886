import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gleaner.session import get_session

    s = get_session("local[4]", **{"spark.sql.shuffle.partitions": "8"})
    yield s


@pytest.fixture()
def root(spark):
    from gleaner.session import new_scratch

    return new_scratch(spark, "test-warehouse")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)
