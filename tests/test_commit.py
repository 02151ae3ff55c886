"""Two writers of one version of a table: one wins, and nothing of it is lost."""
import pytest

from gleaner.sinks.table import VersionedTable
from gleaner.sinks.write import upsert
from gleaner.session import new_scratch


def two(spark):
    root = new_scratch(spark, "commit")
    return [VersionedTable(spark, root, "n", "t") for _ in range(2)]


def pinned(table, version):
    """The table as a writer sees it that looked at its versions earlier."""
    table.current_version = lambda: version
    return table


def test_second_writer_of_a_version_loses(spark):
    a, b = two(spark)
    assert a.replace(spark.range(10)) == 1
    with pytest.raises(RuntimeError, match="another writer"):
        pinned(b, None).replace(spark.range(2))
    assert a.read().count() == 10
    assert len(a._fs.dirs(f"{a.path}/data")) == 1  # the loser took its files away
    assert a._fs.names(f"{a.path}/_versions") == ["0000000001"]


def test_empty_second_writer_removes_only_its_own(spark):
    a, b = two(spark)
    a.replace(spark.range(10))
    assert pinned(b, None).replace(spark.range(0), only_if_rows=True) is None
    assert a.read().count() == 10


def test_upsert_from_an_old_version_fails(spark):
    a, b = two(spark)
    key = spark.range(3).selectExpr("id", "0 AS req_idx", "id AS pos")
    upsert(a, key, "id")
    upsert(a, spark.range(5, 6).selectExpr("id", "0 AS req_idx", "id AS pos"), "id")
    with pytest.raises(RuntimeError, match="another writer"):
        upsert(pinned(b, 1), spark.range(8, 9).selectExpr("id", "0 AS req_idx", "id AS pos"), "id")
    assert sorted(r.id for r in a.read().collect()) == [0, 1, 2, 5]


def test_old_versions_go_with_their_folders(spark):
    a, _ = two(spark)
    for n in range(4):
        a.replace(spark.range(n + 1))
    assert a.versions() == [3, 4] and len(a._fs.dirs(f"{a.path}/data")) == 2
    assert a.read().count() == 4 and a.read(3).count() == 3


@pytest.mark.parametrize("bound", [0, 5_000_000])
def test_key_stored_twice_becomes_one_row(spark, bound):
    a, _ = two(spark)
    rows = lambda *ids: spark.createDataFrame([(i, 0, 0) for i in ids], "id long, req_idx int, pos int")
    upsert(a, rows(1, 2), "id", buckets=4)
    a.append(rows(1, None).drop("req_idx", "pos"))
    upsert(a, rows(1, None, 3), "id", broadcast_max_keys=bound)
    assert sorted((r.id or 0) for r in a.read().collect()) == [0, 1, 2, 3]
