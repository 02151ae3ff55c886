import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from gleaner.operators import run_summary
from gleaner.plans import build_plan, categorical_axis
from gleaner.runner import run_collector
from gleaner.sinks.partitioned import PartitionedTable
from gleaner.sinks.table import VersionedTable
from gleaner.sources.fetch import fetch_http
from gleaner.suite.fixtures import RecordedTransport
from gleaner.spec import (Auth, Cadence, Categorical, Collector, Column, FunctionSource, HttpSource, Param,
                          RateLimit, ResponseFormat, Staging)

from conftest import rows

# Functions of this module run on Python workers, which cannot import tests.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _outcomes(spark, errors):
    return spark.createDataFrame([(i, e, 0 if e else 3) for i, e in enumerate(errors)],
                                 "req_idx int, error string, n_rows bigint")


def test_run_outcomes(spark):
    s = run_summary(_outcomes(spark, ["boom", "boom"])).first()
    assert (s["status"], s["failed_of"]) == ("FAILED", "2/2")
    s = run_summary(_outcomes(spark, [None, "boom", None])).first()
    assert (s["status"], s["failed_of"]) == ("complete with errors", "1/3")
    assert run_summary(_outcomes(spark, [None, None])).first()["status"] == "complete"


def _echo(method, url, params, headers, timeout):
    return 200, json.dumps({"params": params, "headers": headers})


def test_auth_placement_and_hints(spark):
    plan = build_plan(spark, [categorical_axis(spark, Categorical("q", ("x",)))])
    for auth, where in [(Auth("query_param", "secret", "api_key"), "params"),
                        (Auth("header", "secret", "X-Key"), "headers"), (Auth("bearer", "secret"), "headers")]:
        body = fetch_http(plan, HttpSource("http://api", auth=auth), _echo).first()["body"]
        sent = json.loads(body)[where]
        assert "secret" in json.dumps(sent)
        if auth.type == "bearer":
            assert sent["Authorization"] == "Bearer secret"
    for status, hint in [(401, "token"), (403, "permissions"), (404, "URL"), (429, "rate_limit"), (500, "")]:
        err = fetch_http(plan, HttpSource("http://api"), RecordedTransport([], (status, ""))).first()["error"]
        assert err.startswith(f"http://api answered with status {status}") and hint in err
    assert "auth" not in " ".join(plan.columns)


def test_rate_limit_is_kept_by_many_tasks(spark, tmp_path):
    """Eight tasks, four at a time: calls are no closer on average than the limit."""
    import os
    import time

    folder, interval, n = str(tmp_path), 0.1, 32

    def noted(method, url, params, headers, timeout):
        open(os.path.join(folder, f"{time.time():.6f}-{params['q']}"), "w").close()
        return 200, "{}"

    plan = build_plan(spark, [categorical_axis(spark, Categorical("q", tuple(range(n))))])
    src = HttpSource("http://api", rate_limit=RateLimit(requests=60, per_minutes=interval))
    got = fetch_http(plan, src, noted, concurrency=8)
    assert got.rdd.getNumPartitions() == 8
    assert sorted(r["req_idx"] for r in got.collect()) == list(range(n))
    names = [f.rsplit("-", 1) for f in os.listdir(folder)]
    sent = sorted(float(t) for t, _ in names)
    assert sent[-1] - sent[0] >= (n - 1) * interval * 0.9
    of_task = {}
    for t, q in names:
        of_task.setdefault(int(q) % 8, []).append(float(t))
    for times in map(sorted, of_task.values()):  # no task catches up on slots it missed
        assert all(b - a >= 8 * interval * 0.95 for a, b in zip(times, times[1:]))


def test_large_responses_leave_one_by_one(spark):
    def big(method, url, params, headers, timeout):
        return 200, "[" + ",".join(['"' + "x" * 1000 + '"'] * 5000) + "]"

    plan = build_plan(spark, [categorical_axis(spark, Categorical("q", tuple(range(30))))])
    got = fetch_http(plan, HttpSource("http://api"), big, concurrency=1)  # 5 MB each, one batch of the plan
    assert got.selectExpr("count(*) AS n", "min(length(body)) AS m").first()[:] == (30, 5_015_001)


def test_charsets():
    from gleaner.sources.fetch import decode_body

    text = '{"a": "é日"}'
    assert all(decode_body(text.encode(c), c) == text for c in ("utf-8", "utf-16", "utf-16-le", "gb18030"))
    assert decode_body("é".encode("iso-8859-1"), "iso-8859-1") == decode_body("é".encode("latin-1"), None) == "é"
    assert decode_body(text.encode("utf-8-sig"), None) == decode_body(text.encode("utf-16"), None) == text
    assert decode_body("é".encode(), "no-such-charset") == decode_body("é".encode(), "ascii") == "é"


def test_function_params_keep_their_types(spark):
    from gleaner.sources.fetch import fetch_function
    from gleaner.sources.records import function_records, records_of

    def show(params):
        if params["n"] == 3:
            raise KeyError("three")
        return [] if params["n"] == 2 else [{"of": {k: type(v).__name__ for k, v in params.items()}, "x": float("nan")}]

    plan = spark.createDataFrame([(i, {"n": str(i), "b": "False", "f": "1.5", "s": "x", "bad": "y"}) for i in (1, 2, 3)],
                                 "req_idx bigint, params map<string,string>")
    src = FunctionSource(show, params=(Param("n", "integer"), Param("b", "boolean"), Param("f", "float"), Param("s"),
                                       Param("bad", "integer"), Param("absent", "integer")))
    got = fetch_function(plan, src)
    assert rows(got, "req_idx", "pos", "error")[1:] == [(2, None, None), (3, None, "KeyError: 'three'")]
    rec = records_of(function_records(got)).select(F.to_json("record").alias("r")).first()["r"]
    assert json.loads(rec) == {"of": {"n": "int", "b": "bool", "f": "float", "s": "str", "bad": "str"}, "x": None}


def test_run_collector_rest_upsert(spark, root):
    rules = [({"page": "1"}, 200, '{"data":[{"id":1,"n":"a"},{"id":2,"n":"b"},{"id":1,"n":"dup"}]}'),
             ({"page": "2"}, 200, '{"data":[{"id":2,"n":"B"},{"id":3,"n":"c"}]}'),
             ({"page": "3"}, 500, "")]
    coll = Collector("things", HttpSource(
        "http://api", params=(Param("page", "integer"), Param("fmt", value="json")),
        response=ResponseFormat("json", "data"),
        schema=(Column("id", "id", "integer"), Column("name", "n", "string"))),
        Cadence("incremental", iterate=(Categorical("page", (1, 2, 3)),), primary_key="id"), namespace="shop")
    res = run_collector(spark, coll, root, transport=RecordedTransport(rules))
    assert res.n_requests == 3
    assert (res.summary["status"], res.summary["failed_of"]) == ("complete with errors", "1/3")
    table = PartitionedTable(spark, root, "shop", "things").read()
    assert rows(table, "id", "name") == [(1, "a"), (2, "B"), (3, "c")]
    assert "_loaded_at" in table.columns
    again = run_collector(spark, coll, root, transport=RecordedTransport(rules), limit=1)
    assert again.n_requests == 1 and PartitionedTable(spark, root, "shop", "things").read().count() == 3


def test_run_collector_into_bucketed_table(spark, root):
    rules = [({"page": "1"}, 200, '{"data":[{"id":1,"n":"a"},{"id":2,"n":"b"}]}'),
             ({"page": "2"}, 200, '{"data":[{"id":2,"n":"B"},{"id":3,"n":"c"}]}')]
    coll = Collector("things", HttpSource(
        "http://api", params=(Param("page", "integer"),), response=ResponseFormat("json", "data"),
        schema=(Column("id", "id", "integer"), Column("name", "n", "string"))),
        Cadence("incremental", iterate=(Categorical("page", (1, 2)),), primary_key="id", buckets=4),
        namespace="shop")
    run_collector(spark, coll, root, transport=RecordedTransport(rules))
    run_collector(spark, coll, root, transport=RecordedTransport(rules), limit=1)  # page 1 again
    t = VersionedTable(spark, root, "shop", "things")
    assert t.bucketing() is not None and t.bucketing().buckets == 4
    assert rows(t.read(), "id", "name") == [(1, "a"), (2, "b"), (3, "c")]


def pages(params):
    n = int(params["page"])
    return [{"id": n * 10 + i, "kind": params["kind"]} for i in range(n)]


def test_function_source_staged(spark, root):
    coll = Collector("gen", FunctionSource(pages, params=(Param("page", "integer"), Param("kind", value="k"))),
                     Cadence("incremental", iterate=(Categorical("page", (1, 2)), Categorical("state", ("o", "c"))),
                             primary_key="id", staging=Staging("state", "gen_{state}_staging")))
    res = run_collector(spark, coll, root)
    assert res.summary["status"] == "complete"
    a = VersionedTable(spark, root, "gen", "gen_o_staging").read()
    assert rows(a, "id", "kind") == [(10, "k"), (20, "k"), (21, "k")]


def test_csv_source_inferred(spark, root):
    body = "id,score,ok\n1,2.5,true\n2,,false\n"
    coll = Collector("csvs", HttpSource("http://api", response=ResponseFormat("csv")), Cadence("append"))
    run_collector(spark, coll, root, transport=RecordedTransport([({}, 200, body)]))
    t = PartitionedTable(spark, root, "csvs", "csvs").read()
    assert dict(t.dtypes)["id"] == "bigint" and dict(t.dtypes)["score"] == "double"
    assert rows(t, "id", "score", "ok") == [(1, 2.5, True), (2, None, False)]


def daily(params):
    return [{"id": params["day"], "kind": "k"}]


def test_staging_takes_its_members_from_the_data(spark, root):
    """A partition param on a date axis has no values in the spec."""
    from gleaner.spec import DateRange

    coll = Collector("days", FunctionSource(daily, params=(Param("day"),)),
                     Cadence("incremental", iterate=(DateRange(("day",), "2024-01-01", "2024-01-03", "1 day"),),
                             primary_key="id", staging=Staging("day", "d_{day}")))
    res = run_collector(spark, coll, root)
    got = {name for name, version in res.versions.items() if version}
    assert len(got) == res.n_requests
    assert all(VersionedTable(spark, root, "days", name).read().count() == 1 for name in got)
