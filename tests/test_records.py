import pytest
from pyspark.sql import functions as F

from gleaner.sources.records import dead_letters, infer_text_types, parse_csv_records, parse_json_records, records_of


def _parse(spark, body, path):
    bodies = spark.createDataFrame([(0, body)], "req_idx bigint, body string")
    return parse_json_records(bodies, path).collect()


@pytest.mark.parametrize("body,path,n", [
    ('[{"id":1},{"id":2}]', None, 2),
    ('{"data":[{"id":1},{"id":2}]}', "data", 2),
    ('{"response":{"results":[{"id":3}]}}', "response.results", 1),
    ('{"data":[]}', "data", 0),
    ('{"records":[{"id":1}]}', "data", 0),
    ('{"id":7}', None, 1),
    ('{"data":null}', "data", 0),
])
def test_records_path_counts(spark, body, path, n):
    out = _parse(spark, body, path)
    assert all(r["error"] is None for r in out)
    assert sum(r["pos"] is not None for r in out) == n


def test_records_path_errors(spark):
    err = _parse(spark, '[{"id":1}]', "items")[0]["error"]
    assert "records_path 'items'" in err
    err = _parse(spark, '[{"id":1}]', "data")[0]["error"]
    assert "omit records_path" in err
    err = _parse(spark, '{"a":{"b":1}}', "x.y")[0]["error"]  # missing first key -> [] -> not an object
    assert "at key 'y'" in err
    assert "not valid JSON" in _parse(spark, "{oops", None)[0]["error"]


def test_record_order_is_position(spark):
    bodies = spark.createDataFrame([(0, '[{"id":5},{"id":3},{"id":9}]')], "req_idx bigint, body string")
    recs = records_of(parse_json_records(bodies)).select("pos", F.try_variant_get("record", "$.id", "int").alias("id"))
    assert [tuple(r) for r in recs.orderBy("pos").collect()] == [(0, 5), (1, 3), (2, 9)]


def test_csv_bodies(spark):
    bodies = spark.createDataFrame([
        (0, 'a,b,c\n1,"x, y",true\n2,,false\n'),
        (1, ""),
        (2, "a,b,c\n"),
        (3, 'a,b,c\r\n3.5,"say ""hi""",true'),
    ], "req_idx bigint, body string")
    parsed = parse_csv_records(bodies)
    recs = records_of(parsed)
    assert recs.count() == 3
    types = dict(infer_text_types(recs))
    assert types == {"a": "double", "b": "string", "c": "boolean"}
    got = sorted((r["a"], r["b"]) for r in recs.select(
        F.try_variant_get("record", "$.a", "string").alias("a"),
        F.try_variant_get("record", "$.b", "string").alias("b")).collect())
    assert got == [("1", "x, y"), ("2", None), ("3.5", 'say "hi"')]


def test_csv_inference_with_known_fields(spark):
    from gleaner.sources.records import csv_header_fields

    bodies = spark.createDataFrame([(0, "a,b\n1,x\n"), (1, "a,b,c\n2,,true\n")], "req_idx bigint, body string")
    fields = csv_header_fields(bodies)
    assert fields == ["a", "b", "c"]
    recs = records_of(parse_csv_records(bodies))
    assert dict(infer_text_types(recs, fields=fields)) == dict(infer_text_types(recs)) == \
        {"a": "bigint", "b": "string", "c": "boolean"}


def test_pages_cover_rows_once_and_repeat_after_a_shuffle(spark):
    from gleaner.suite.fixtures import pages_of

    df = spark.range(0, 2000, numPartitions=5).select(F.col("id"), (F.col("id") % 3).alias("hot")) \
        .repartition(4, "hot")  # one hot key per partition, input order after a shuffle
    pages = pages_of(df, 100, ["id"])

    def cut(p):
        return sorted(tuple(sorted(r["id"] for r in row["rows"])) for row in p.collect())

    first = cut(pages)
    assert all(len(p) <= 100 for p in first)
    assert sorted(i for p in first for i in p) == list(range(2000))
    assert cut(pages) == first


def _records(spark, body, path=None):
    """(good records as text by position, errors by position, request error)."""
    bodies = spark.createDataFrame([(0, body)], "req_idx bigint, body string")
    out = parse_json_records(bodies, path).select("pos", F.to_json("record").alias("r"), "error").collect()
    return ({r["pos"]: r["r"] for r in out if r["pos"] is not None and r["error"] is None},
            {r["pos"]: r["error"] for r in out if r["pos"] is not None and r["error"] is not None},
            next((r["error"] for r in out if r["pos"] is None), None))


def test_a_bad_record_costs_only_itself(spark):
    good, bad, err = _records(spark, '{"d": [{"a": 1}, {"a": oops}, {"a": "x, ]} \\" y"}, {"b": [1, {}], "c": , }, {"a": 3}]}', "d")
    assert good == {0: '{"a":1}', 2: '{"a":"x, ]} \\" y"}', 4: '{"a":3}'} and err is None
    assert set(bad) == {1, 3} and all("not valid JSON" in e for e in bad.values())


def test_nan_and_repeated_keys_are_records(spark):
    good, bad, err = _records(spark, '[{"a": NaN, "b": -Infinity, "c": 1}, {"k": 1, "k": 2}]')
    assert good == {0: '{"a":null,"b":null,"c":1}', 1: '{"k":2}'} and not bad and err is None
    assert _records(spark, '{"a": NaN}')[0] == {0: '{"a":null}'}
    assert _records(spark, '{"d": [1, NaN], "d": [{"z": NaN}]}', "d")[0] == {0: '{"z":null}'}  # the last one's value


@pytest.mark.parametrize("body,path,good,bad,error", [
    ('[{"a": 1}, {"a": 2', None, {0: '{"a":1}'}, {1}, None),
    ('[{"a": 1}', None, {0: '{"a":1}'}, {1}, None),
    ('[{"a": NaN}, }, {"a": 2}]', None, {0: '{"a":null}', 2: '{"a":2}'}, {1}, None),
    ('[{"a": 1}, {"a": "open}, {"a": 2, "t": "x"}, {"a": "open}, {"a": 3}]', None,
     {0: '{"a":1}', 2: '{"a":2,"t":"x"}', 4: '{"a":3}'}, {1, 3}, None),
    ('[{"a": "open}, {"a": "open}, {"a": 3}, {"a": "x", "b": [1, {"c": 2}], }]', None, {2: '{"a":3}'}, {0, 1, 3}, None),
    ('[{"a": 1}, {"a": "open}]', None, {0: '{"a":1}'}, {1}, None),
    ('{"x": NaN, "d": [{"a": 1}]}', "d", {0: '{"a":1}'}, set(), None),
    ('{"x": NaN}', "d", {}, set(), None),
    ('{"x": NaN, "d": 5}', "d.e", {}, set(), "at key 'e'"),
    ('[{"x": NaN}]', "d", {}, set(), "omit records_path"),
    ('{"x": NaN, "d": null}', "d", {}, set(), None),
    ("{oops", "d", {}, set(), "not valid JSON"),
    ("", None, {}, set(), "not valid JSON"),
    ("<html>", None, {}, set(), "not valid JSON"),
])
def test_split_bodies(spark, body, path, good, bad, error):
    got = _records(spark, body, path)
    assert got[0] == good and set(got[1]) == bad
    assert (got[2] is None) if error is None else error in got[2]


def test_outcomes_count_bad_records_apart(spark):
    from gleaner.sources.records import dead_letters, request_outcomes

    bodies = spark.createDataFrame([(0, '[{"a": 1}, {"a": x}]', None), (1, None, "HTTP 500"), (2, "[]", None)],
                                   "req_idx bigint, body string, error string")
    parsed = parse_json_records(bodies)
    assert sorted(tuple(r) for r in request_outcomes(parsed).collect()) == [
        (0, None, 1, 1), (1, "HTTP 500", 0, 0), (2, None, 0, 0)]
    assert [r["pos"] for r in dead_letters(parsed).collect()] == [1]


def test_body_above_a_variants_size():
    """Split without a parse of the whole."""
    from gleaner.sources.records import split_elements

    one = '{"t": "' + "x" * (1 << 20) + '"}'
    texts, errors, error = split_elements("[" + ",".join([one] * 140 + ["{bad"]) + "]", None)
    assert len(texts) == 141 and errors[:140] == [None] * 140 and errors[140] and error is None


BODIES = ['[{"a": 1}, {"a": 2', '[{"a": 1}', '[{"a": NaN}, }, {"a": 2}]', '[{"a": 1}, {"a": "open}]', "", " ", "<html>", "[", " [ ] x", "[]",
          '[{"a": 1}, {"a": "open}, {"a": 2, "t": "x"}, {"a": "open}, {"a": 3}]', '{"a": NaN}', 'null', '[1, "\\"],[", NaN, , [2, {"b": "}"}] ]]',
          '[{"a": "open}, {"a": "open}, {"a": 3}, {"a": "x", "b": [1, {"c": 2}], }]', '[{"a": 1},\n {"a": "\\\\"}\n, {"a": "\\', '[{"a": 1}}, {"b": 2}]']


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_a_body_in_pieces_gives_the_same_elements(size):
    from gleaner.sources.records import BodySplitter, split_elements

    for body in BODIES:
        split, texts, errors = BodySplitter(None), [], []
        pieces = [body[i:i + size] for i in range(0, len(body), size)] or [""]
        for i, piece in enumerate(pieces):
            more, bad, error = split.feed(piece, i + 1 == len(pieces))
            texts, errors = texts + more, errors + bad
        assert (texts, errors, error) == split_elements(body, None), body


def test_the_splitter_holds_little_of_a_long_array():
    from gleaner.sources.records import BodySplitter

    body = "[" + ",".join('{"t": "%s"}' % ("x" * 500) for _ in range(2000)) + ", NaN]"
    split, n = BodySplitter(None), 0
    for i in range(0, len(body), 4096):
        n += len(split.feed(body[i:i + 4096], i + 4096 >= len(body))[0])
        assert sum(map(len, split.held)) < 8192
    assert n == 2001


def test_records_of_bodies_in_many_pieces(spark):
    bodies = [(k, "[" + ",".join('{"i": %d, "t": "%s"}' % (i, "é" * 300) if i % 7 else '{"i": "%d}' % i for i in range(1, 100)) + "]", None)
              for k in range(3)] + [(3, "[{}, NaN", None), (4, "", None), (5, '[{"a": 1}]', None), (6, None, "HTTP 500"), (7, "[ ] x", None)]
    parsed = parse_json_records(spark.createDataFrame(bodies, "req_idx bigint, body string, error string").coalesce(1))
    got = parsed.select("req_idx", "pos", F.try_variant_get("record", "$.i", "int").alias("i"), "error").collect()
    for k in range(3):
        assert sorted((r["pos"], r["i"]) for r in got if r["req_idx"] == k) == [(i - 1, i if i % 7 else None) for i in range(1, 100)]
    rest = sorted((r["req_idx"], -1 if r["pos"] is None else r["pos"], r["error"]) for r in got if r["req_idx"] > 2)
    assert [r[:2] for r in rest] == [(3, 0), (3, 1), (3, 2), (4, -1), (5, 0), (6, -1), (7, -1)]
    assert rest[2][2] == "the response ends inside its records" and rest[3][2] == "response is not valid JSON"


def _csv(spark, body):
    out = parse_csv_records(spark.createDataFrame([(0, body)], "req_idx bigint, body string")) \
        .select("pos", F.to_json("record").alias("r"), "error").collect()
    import json
    return ({r["pos"]: json.loads(r["r"]) for r in out if r["r"] is not None},
            {r["pos"]: r["error"] for r in out if r["error"] is not None})


@pytest.mark.parametrize("body,good,bad", [
    ('a,b\n1,"x\ny"\n2,z\n', {0: {"a": "1", "b": "x\ny"}, 1: {"a": "2", "b": "z"}}, {}),
    ('a,b\r\n1,"x\r\n\r\ny ""q"", z"\r\n', {0: {"a": "1", "b": 'x\n\ny "q", z'}}, {}),
    ('\n  \na,b\n1,2\n', {0: {"a": "1", "b": "2"}}, {}),
    ('a,,b\n1,2,3\n', {0: {"a": "1", "Unnamed: 1": "2", "b": "3"}}, {}),
    ('a,b\n1,2,3\n4,5\n', {1: {"a": "4", "b": "5"}}, {0: "3 cells"}),
    ('a,a,a.1,a\n1,2,3,4\n', {0: {"a": "1", "a.2": "2", "a.1": "3", "a.3": "4"}}, {}),
    ('﻿a,b\n1\n,""\n', {0: {"a": "1"}, 1: {}}, {}),
    ('a,b\n1,"open\n2,3\n', {1: {"a": "2", "b": "3"}}, {0: "not closed"}),
    ('a,b\n5" pipe,x"y\n"q"r,s', {0: {"a": '5" pipe', "b": 'x"y'}, 1: {"a": "qr", "b": "s"}}, {}),
    ('"a\nb",c\n1,2', {0: {"a\nb": "1", "c": "2"}}, {}),
    ('', {}, {}), ('\n\n', {}, {}), ('a,b', {}, {}),
])
def test_csv_records(spark, body, good, bad):
    got = _csv(spark, body)
    assert {k: {n: v for n, v in r.items() if v is not None} for k, r in got[0].items()} == good
    assert set(got[1]) == set(bad) and all(bad[k] in got[1][k] for k in bad)


def test_long_quoted_cells_take_linear_time(spark):
    body = 'a,b\n' + '1,"' + 'x ""y""\n' * 60_000 + '"\n' + '2,3\n' * 20_000
    good, bad = _csv(spark, body)
    assert len(good) == 20_001 and not bad and good[0]["b"].count("\n") == 60_000


def test_csv_records_are_split_once_when_errors_are_filtered(spark):
    bodies = spark.createDataFrame([(0, "a,b\n1,2\n")], "req_idx bigint, body string")

    def splits(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")

    parsed = parse_csv_records(bodies)
    assert splits(records_of(parsed)) == splits(dead_letters(parsed)) == 3  # the body, its header, its records


@pytest.mark.parametrize("body,good,bad", [
    ('a,"b\n1,2\n', {0: {"a": "1", '"b': "2"}}, {}),
    ('a,b\n1,"x"\n"open,2\n', {0: {"a": "1", "b": "x"}}, {1: "not closed"}),
    ('a\n1\n"', {0: {"a": "1"}}, {1: "not closed"}),
    ('a,b\r1,"x""y"\r"",\r\n"u"v"w,"""" \n', {0: {"a": "1", "b": 'x"y'}, 1: {}, 2: {"a": 'uv"w', "b": '" '}}, {}),
    ('\ufeffa,b\n\ufeff1,2\n', {0: {"a": "\ufeff1", "b": "2"}}, {}),
])
def test_csv_quotes_and_line_breaks(spark, body, good, bad):
    test_csv_records(spark, body, good, bad)
