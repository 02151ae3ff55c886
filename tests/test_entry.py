import re

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["o_orderstatus", "n_orders", "avg_price", "n_updated"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_documented():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    # queries of the training-data subpackage have brute-force tests of their own
    own = {n for n in q if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own - set(o) == set()
