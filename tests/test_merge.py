from pyspark.sql import functions as F

from gleaner.operators import dedup_latest_non_null
from gleaner.sinks.table import VersionedTable
from gleaner.sinks.write import family_tables, staged_merge, staged_write
from gleaner.spec import LatestNonNull, Merge, Staging

from conftest import rows


def test_latest_non_null_rules(spark):
    df = spark.createDataFrame([
        (1, "a", "2024-01-01", "NaN"),        # one date
        (1, "b", "1/5/2024", "2024-01-03"),   # latest date wins
        (2, "c", None, "2024-02-01"),
        (2, "d", "2024-02-01", "2024-02-01"),  # same latest, more present dates
        (3, "e", "nan", None),                 # all missing: nulls last, tie-break by v
        (3, "f", "None", "NaT"),
    ], "k int, v string, d1 string, d2 string")
    out = dedup_latest_non_null(df, "k", ["d1", "d2"])
    assert rows(out, "k", "v") == [(1, "b"), (2, "d"), (3, "e")]
    one = dedup_latest_non_null(df, "k", ["d2"])  # a single column is used as is
    assert rows(one, "k", "v")[0] == (1, "b")


def test_staged_family_and_merge(spark, root):
    staging = Staging("kind", "items_{kind}_staging")
    merge = Merge("items", key="id", dedup=LatestNonNull(("seen",)))
    batch = spark.createDataFrame([
        (0, 0, 1, "2024-01-01", "a"), (0, 1, 2, "2024-01-05", "a"),
        (1, 0, 1, "2024-01-09", "b"), (1, 1, 3, None, "b"),
        (2, 0, 4, "2024-01-02", None),
    ], "req_idx bigint, pos int, id bigint, seen string, _member string")
    res = staged_write(spark, root, "ns", staging, batch, "id", ["a", "b", None])
    assert set(res) == {"items_a_staging", "items_b_staging", "items_default_staging"}
    fam = family_tables(spark, root, "ns", staging)
    assert [t.name for t in fam] == ["items_a_staging", "items_b_staging", "items_default_staging"]
    assert "_member" not in fam[0].read().columns
    staged_merge(spark, root, "ns", staging, merge)
    merged = VersionedTable(spark, root, "ns", "items").read()
    assert rows(merged, "id", "seen") == [(1, "2024-01-09"), (2, "2024-01-05"), (3, None), (4, "2024-01-02")]


def test_all_text_frame_feeds_latest_non_null(spark):
    from gleaner.operators import as_text

    df = spark.createDataFrame([(1, 2.5, None), (1, None, 3)], "k int, x double, d int")
    t = as_text(df)
    assert all(dt == "string" for _, dt in t.dtypes)
    assert rows(t, "x", "d") == [("2.5", None), (None, "3")]


def _latest_brute(data):
    """Per key: greatest date (missing last), then more present dates, then smallest v."""
    import datetime as dt

    def epoch(s):
        if s is None or s.strip().lower() in ("nan", "nat", "none", ""):
            return None
        return dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc).timestamp()

    best = {}
    for k, v, d1, d2 in data:
        es = [e for e in (epoch(d1), epoch(d2)) if e is not None]
        rank = (max(es) if es else float("-inf"), len(es), [-ord(c) for c in v])
        if k not in best or rank > best[k][0]:
            best[k] = (rank, v)
    return sorted((k, v) for k, (_, v) in best.items())


def test_latest_non_null_matches_brute_force(spark):
    import random

    rnd = random.Random(3)
    dates = [None, "NaN", "2024-01-01", "2024-01-02", "2024-01-02 12:00:00", "2023-12-31"]
    data = [(rnd.randint(0, 8), f"v{i:03d}", rnd.choice(dates), rnd.choice(dates)) for i in range(200)]
    df = spark.createDataFrame(data, "k int, v string, d1 string, d2 string")
    out = dedup_latest_non_null(df, "k", ["d1", "d2"])
    assert rows(out, "k", "v") == _latest_brute(data)


def test_members_sharing_a_table_upsert_in_order(spark, root):
    staging = Staging("kind", "items_{kind}_staging")
    batch = spark.createDataFrame([
        (0, 0, 7, "x", None), (0, 1, 8, "x", None),
        (1, 0, 7, "y", "default"), (1, 1, 9, "y", "default"),
        (2, 0, 7, "z", "other"),
    ], "req_idx bigint, pos int, id bigint, seen string, _member string")
    res = staged_write(spark, root, "ns", staging, batch, "id", [None, "default", "other"])
    assert set(res) == {"items_default_staging", "items_other_staging"}
    shared = VersionedTable(spark, root, "ns", "items_default_staging").read()
    assert rows(shared, "id", "seen") == [(7, "y"), (8, "x"), (9, "y")]
    other = VersionedTable(spark, root, "ns", "items_other_staging").read()
    assert rows(other, "id", "seen") == [(7, "z")]


def test_merged_table_is_no_member_of_its_family(spark, root):
    staging, merge = Staging("k", "p_{k}"), Merge("p_merged", key="id", dedup=LatestNonNull(("seen",)))

    def run(seen):
        batch = spark.createDataFrame([(0, 0, 1, seen, "a")], "req_idx bigint, pos int, id bigint, seen string, _member string")
        staged_write(spark, root, "ns", staging, batch, "id", ["a"])
        staged_merge(spark, root, "ns", staging, merge)
        return VersionedTable(spark, root, "ns", "p_merged").read().first()["seen"]

    assert run("2024-06-01") == "2024-06-01"
    assert run("2024-01-01") == "2024-01-01"  # what staging now says
