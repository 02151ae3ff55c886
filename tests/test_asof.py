import random

from gleaner.operators import asof_join


def _brute(left, right, strict):
    out = []
    for lid, k, t in left:
        best = None
        for rid, rk, rt, v in right:
            if rk == k and (rt < t if strict else rt <= t):
                if best is None or (rt, rid) > (best[0], best[1]):
                    best = (rt, rid, v)
        out.append((lid, k, t, None if best is None else best[2], None if best is None else best[0]))
    return sorted(out, key=repr)


def test_asof_matches_brute_force(spark):
    rnd = random.Random(7)
    left = [(i, rnd.choice([1, 2, 3, None]), rnd.randint(0, 100)) for i in range(80)]
    right = [(i, rnd.choice([1, 2, 3, 4]), rnd.randint(0, 100), f"v{i}") for i in range(120)]
    right += [(200, 1, 50, "tieA"), (201, 1, 50, "tieB")]
    L = spark.createDataFrame(left, "lid int, k int, t bigint")
    R = spark.createDataFrame(right, "rid int, k int, rt bigint, v string")
    for strict in (True, False):
        got = asof_join(L, R, "k", "t", "rt", ["v", "rt"], bucket_seconds=7, strict=strict, tie_break=["rid"],
                        numeric=True)
        rows = sorted((tuple(r) for r in got.select("lid", "k", "t", "v", "rt").collect()), key=repr)
        assert rows == _brute(left, right, strict)


def test_asof_null_keys_never_match(spark):
    L = spark.createDataFrame([(1, None, 10)], "lid int, k int, t bigint")
    R = spark.createDataFrame([(1, None, 5, "x")], "rid int, k int, rt bigint, v string")
    got = asof_join(L, R, "k", "t", "rt", ["v"], bucket_seconds=100, numeric=True).first()
    assert got["v"] is None


def test_asof_hot_key_across_many_buckets(spark):
    rnd = random.Random(11)
    # key 1 holds most rows; buckets of width 5 over 0..600, many of them empty on one side
    left = [(i, 1 if i % 4 else rnd.choice([2, 3]), rnd.randint(0, 600)) for i in range(300)]
    right = [(i, 1 if i % 3 else 2, rnd.randint(0, 600) * (i % 5 != 0), f"v{i}") for i in range(200)]
    L = spark.createDataFrame(left, "lid int, k int, t bigint")
    R = spark.createDataFrame(right, "rid int, k int, rt bigint, v string")
    got = asof_join(L, R, "k", "t", "rt", ["v", "rt"], bucket_seconds=5, strict=True, tie_break=["rid"],
                    numeric=True)
    rows = sorted((tuple(r) for r in got.select("lid", "k", "t", "v", "rt").collect()), key=repr)
    assert rows == _brute(left, right, True)
