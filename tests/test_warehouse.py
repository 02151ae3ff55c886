import pytest
from pyspark.sql import functions as F

from gleaner.catalog import Warehouse, classify_statements, is_write_statement
from gleaner.session import new_scratch
from gleaner.sinks.table import VersionedTable

from conftest import rows


def _put(spark, root, ns, name, data, schema):
    VersionedTable(spark, root, ns, name).replace(spark.createDataFrame(data, schema))


def test_listing_and_overlay(spark):
    local, remote = new_scratch(spark, "t-local"), new_scratch(spark, "t-remote")
    _put(spark, local, "myns", "mytable", [(1, "a"), (2, None)], "id bigint, name string")
    _put(spark, local, "ns", "tbl", [(99,)], "v bigint")
    _put(spark, remote, "ns", "tbl", [(7,)], "v bigint")
    _put(spark, remote, "gcs_ns", "gcs_tbl", [(1,), (2,)], "y bigint")
    wh = Warehouse(spark, root=local, remote_root=remote)
    listing = {r["full_name"]: r for r in wh.list_tables().collect()}
    assert listing["myns.mytable"]["row_count"] == 2 and listing["myns.mytable"]["layer"] == "local"
    assert listing["ns.tbl"]["layer"] == "remote" and listing["gcs_ns.gcs_tbl"]["row_count"] == 2
    assert [c["name"] for c in listing["myns.mytable"]["columns"]] == ["id", "name"]
    assert wh.query("SELECT v FROM ns.tbl").first()["v"] == 7  # upper layer hides the lower one
    assert wh.query("SELECT count(*) AS n FROM myns.mytable").first()["n"] == 2


def test_cap_limit_and_unknown_table(spark):
    root = new_scratch(spark, "t-cap")
    _put(spark, root, "ns", "big", [(i,) for i in range(1200)], "x bigint")
    wh = Warehouse(spark, root=root)
    assert wh.query("SELECT * FROM ns.big").count() == 500
    assert wh.query("SELECT * FROM ns.big LIMIT 700").count() == 700
    assert wh.query("WITH q AS (SELECT * FROM ns.big) SELECT * FROM q LIMIT 600").count() == 600
    assert wh.query("SELECT x AS credit_limit FROM ns.big").count() == 500  # a column named limit is capped
    assert wh.query("SELECT * FROM ns.big WHERE x < 10").count() == 10
    with pytest.raises(Exception):
        wh.query("SELECT * FROM ns.nope").collect()


def test_models_export_and_namespaces(spark):
    root = new_scratch(spark, "t-model")
    _put(spark, root, "src", "src_tbl", [(10,), (20,)], "v bigint")
    wh = Warehouse(spark, root=root)
    res = wh.materialize("SELECT v * 2 AS v2 FROM src.src_tbl", "models", "doubled")
    assert res["ok"] and res["row_count"] == 2
    assert rows(wh.query("SELECT v2 FROM models.doubled"), "v2") == [(20,), (40,)]
    wh.materialize("SELECT sum(v) AS n FROM src.src_tbl", "src", "src_tbl")  # a model may replace its input
    assert wh.query("SELECT n FROM src.src_tbl").first()["n"] == 30
    out = new_scratch(spark, "t-export")
    wh.query(f"COPY (SELECT id FROM range(1200)) TO '{out}' (FORMAT parquet)")
    assert spark.read.parquet(out).count() == 1200  # exports are not capped
    wh.query("CREATE TABLE models.summed AS SELECT n + 1 AS n1 FROM src.src_tbl")
    assert wh.query("SELECT n1 FROM models.summed").first()["n1"] == 31
    wh.drop_namespace("models")
    assert not any(e.namespace == "models" for e in wh.entries())


@pytest.mark.parametrize("sql,expected", [
    ("COPY (SELECT 1) TO 'x'", True), ("copy (select 1) to 'x'", True), ("CREATE TABLE a AS SELECT 1", True),
    ("CREATE OR REPLACE TABLE a AS SELECT 1", True), ("INSERT INTO a VALUES (1)", True), ("DROP TABLE a", True),
    ("DELETE FROM a", True), ("UPDATE a SET x = 1", True), ("ALTER TABLE a ADD COLUMN y INT", True),
    ("SELECT 1", False), ("select 1", False), ("WITH q AS (SELECT 1) SELECT * FROM q", False),
    ("DESCRIBE a", False), ("", False),
])
def test_write_detection(spark, sql, expected):
    assert is_write_statement(sql) is expected
    df = classify_statements(spark.createDataFrame([(sql,)], "sql string"))
    assert df.first()["is_write"] is expected


def test_flat_folder_scan_prunes(spark):
    wh = Warehouse(spark, flat={"tpch": "/root/testdata/sf0.001"})
    df = wh.table("tpch.lineitem").filter(F.col("l_returnflag") == "R").select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_describe_and_cli(spark, capsys):
    from gleaner.__main__ import main

    root = new_scratch(spark, "t-cli")
    _put(spark, root, "ns", "t", [(1, "a"), (2, "b")], "id bigint, name string")
    wh = Warehouse(spark, root=root)
    assert wh.describe("ns.t") == [("id", "bigint"), ("name", "string")]
    assert main(["query", "--root", root, "SELECT count(*) AS n FROM ns.t"]) == 0
    assert "2" in capsys.readouterr().out
    assert main(["tables", "--root", root]) == 0
    assert "ns.t" in capsys.readouterr().out


def test_listing_counts_in_one_job_and_marks_unreadable(spark):
    root = new_scratch(spark, "t-list")
    _put(spark, root, "ns", "good", [(i,) for i in range(30)], "x bigint")
    _put(spark, root, "ns", "other", [(1, "a"), (2, "b")], "id bigint, s string")
    bad = VersionedTable(spark, root, "ns", "bad")
    bad.replace(spark.createDataFrame([(1,)], "x bigint"))
    import glob
    import os
    loc = bad.location().replace("file:", "")
    for f in glob.glob(os.path.join(loc, "*.parquet")):
        with open(f, "wb") as fh:
            fh.write(b"not parquet at all")
    listing = {r["full_name"]: r for r in Warehouse(spark, root=root).list_tables().collect()}
    assert listing["ns.good"]["row_count"] == 30 and listing["ns.other"]["row_count"] == 2
    assert listing["ns.bad"]["row_count"] == -1 and listing["ns.bad"]["error"]
    assert [r for r in sorted(listing)] == ["ns.bad", "ns.good", "ns.other"]


def test_tables_of_others_are_neither_used_nor_dropped(spark):
    root = new_scratch(spark, "t-foreign")
    _put(spark, root, "shared_ns", "t", [(1,)], "x bigint")
    _put(spark, root, "shared_ns", "own", [(2,)], "x bigint")
    wh = Warehouse(spark, root=root)
    wh.ensure_namespace("shared_ns")
    spark.sql("CREATE TABLE shared_ns.t USING parquet AS SELECT 99 AS y")
    with pytest.raises(ValueError, match="made by others"):
        wh.register()
    wh.drop_namespace("shared_ns")
    assert spark.table("shared_ns.t").first()["y"] == 99
    spark.sql("DROP TABLE shared_ns.t")
    spark.sql("DROP DATABASE shared_ns CASCADE")


def test_a_table_that_cannot_be_read_stands_only_in_its_own_way(spark):
    root = new_scratch(spark, "wh-one-bad")
    VersionedTable(spark, root, "mix", "good").replace(spark.range(3))
    VersionedTable(spark, root, "mix", "empty").create_empty()
    w = Warehouse(spark, root)
    assert w.query("SELECT count(*) AS n FROM mix.good").first()["n"] == 3
    assert w.query("WITH e AS (SELECT id FROM mix.good WHERE id IN (SELECT max(id) FROM mix.good)) SELECT * FROM e").count() == 1
    with pytest.raises(Exception):
        w.query("SELECT * FROM mix.empty")


def test_a_foreign_name_stands_only_in_its_own_way(spark):
    root = new_scratch(spark, "wh-foreign2")
    for n in ("a", "b"):
        VersionedTable(spark, root, "fz", n).replace(spark.range(2))
    Warehouse(spark, root).ensure_namespace("fz")
    spark.sql("CREATE TABLE fz.a USING parquet AS SELECT 7 AS own")
    try:
        w = Warehouse(spark, root)
        assert w.query("SELECT * FROM fz.b").count() == 2
        with pytest.raises(ValueError, match="made by others"):
            w.query("SELECT * FROM fz.a")
    finally:
        spark.sql("DROP TABLE fz.a")


def test_statements_that_change_tables_raise(spark):
    root = new_scratch(spark, "wh-dml")
    t = VersionedTable(spark, root, "dml", "t")
    t.replace(spark.range(3))
    w = Warehouse(spark, root)
    w.query("SELECT * FROM dml.t")
    for sql in ("INSERT INTO dml.t VALUES (9)", "insert overwrite dml.t select 1", "DROP TABLE dml.t",
                "WITH x AS (SELECT 1 AS id) INSERT INTO dml.t SELECT * FROM x", "DELETE FROM dml.t", "TRUNCATE TABLE dml.t",
                "FROM dml.t INSERT INTO dml.t SELECT id", "ALTER TABLE dml.t ADD COLUMNS (x int)", "MERGE INTO dml.t USING dml.t s "
                "ON s.id = t.id WHEN MATCHED THEN DELETE", "CREATE TABLE x (a int) USING parquet"):
        with pytest.raises(ValueError, match="change"):
            w.query(sql)
    assert t.read().count() == 3
    spark.sql("DROP TABLE dml.t")  # behind the warehouse's back: the next query registers it again
    assert w.query("SELECT * FROM dml.t").count() == 3


def test_partitioned_tables_are_queried_by_name(spark):
    from gleaner.sinks.partitioned import PartitionedTable

    root = new_scratch(spark, "wh-parts")
    t = PartitionedTable(spark, root, "pt", "log")
    w = Warehouse(spark, root)
    t.append(spark.createDataFrame([(1, "a")], "id bigint, v string"), "x")
    assert w.query("SELECT * FROM pt.log").columns == ["id", "v"]
    t.append(spark.createDataFrame([(2, "b", 5)], "id bigint, v string, extra int"), "y")
    assert sorted(tuple(r) for r in w.query("SELECT * FROM pt.log").collect()) == [(1, "a", None), (2, "b", 5)]
    listed = {r["full_name"]: r for r in w.list_tables().collect()}
    assert listed["pt.log"]["row_count"] == 2 and [c["name"] for c in listed["pt.log"]["columns"]] == ["id", "v", "extra"]
    plan = w.query("SELECT v FROM pt.log WHERE id = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,2)]" in plan and "extra" not in plan
    with pytest.raises(ValueError, match="another name"):
        w.query("CREATE TABLE pt.log AS SELECT 1 AS x")
    w.drop_namespace("pt")
    assert not t.exists() and not spark.catalog.databaseExists("pt")


@pytest.mark.parametrize("text,expected", [
    (None, ("parquet", {})), ("FORMAT CSV, HEADER, DELIMITER '|'", ("csv", {"header": "true", "sep": "|"})),
    ("format 'json', compression gzip", ("json", {"compression": "gzip"})), ("csv, nullstr ''''", ("csv", {"nullValue": "'"})),
])
def test_copy_options(text, expected):
    from gleaner.catalog.warehouse import copy_options

    assert copy_options(text) == expected


@pytest.mark.parametrize("text", ["FORMAT orc", "FORMAT csv, ROW_GROUP_SIZE 5", "csv; drop", "FORMAT"])
def test_copy_options_that_are_not_known_raise(text):
    from gleaner.catalog.warehouse import copy_options

    with pytest.raises(ValueError):
        copy_options(text)


def test_listing_of_many_tables_is_a_few_jobs(spark, tmp_path):
    """Tables by the hundred, local and remote, an empty one and a broken one:
    no job or listing per table."""
    import os
    import shutil

    root, remote = str(tmp_path / "local"), str(tmp_path / "remote")
    VersionedTable(spark, root, "ns0", "t0").replace(spark.range(5).coalesce(1))
    VersionedTable(spark, remote, "ns0", "t0").replace(spark.range(7).withColumn("x", F.lit(1.5)).coalesce(1))
    for i in range(1, 300):
        shutil.copytree(f"{root}/ns0/t0", f"{root}/ns{i % 3}/t{i}")
    VersionedTable(spark, root, "ns1", "empty").create_empty()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing-jobs", "listing")
    try:
        listed = {r["full_name"]: r for r in Warehouse(spark, root, remote).list_tables().collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(listed) == 301 and len(tracker.getJobIdsForGroup("listing-jobs")) < 40
    assert (listed["ns0.t0"]["row_count"], listed["ns0.t0"]["layer"]) == (7, "remote")
    assert [tuple(c) for c in listed["ns0.t0"]["columns"]] == [("id", "bigint"), ("x", "double")]
    assert listed["ns1.t4"]["row_count"] == 5 and listed["ns1.empty"]["row_count"] == -1
    assert os.path.isdir(listed["ns2.t5"]["location"].replace("file:", ""))
    assert Warehouse(spark, str(tmp_path / "nothing")).list_tables().count() == 0
