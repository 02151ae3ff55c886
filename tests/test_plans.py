import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner.plans import (build_plan, categorical_axis, date_range_axis, duration_days, parse_override,
                           plan_limit, request_params, uncovered_params)
from gleaner.spec import Categorical, DateRange, Param


def _plan(spark, axes):
    return [(r["req_idx"], dict(r["params"])) for r in build_plan(spark, axes).orderBy("req_idx").collect()]


def test_durations():
    assert [duration_days(s) for s in ("1 day", "7 days", "2 weeks", "1 month")] == [1, 7, 14, 30]
    with pytest.raises(ValueError):
        duration_days("3 fortnights")
    with pytest.raises(ValueError):
        duration_days("week")


def test_windows_cut_at_end_and_overlap(spark):
    a = date_range_axis(DateRange(("s", "e"), "2024-01-01", "2024-01-10", "4 days"))
    assert _plan(spark, [a]) == [
        (0, {"s": "2024-01-01", "e": "2024-01-04"}),
        (1, {"s": "2024-01-05", "e": "2024-01-08"}),
        (2, {"s": "2024-01-09", "e": "2024-01-10"}),
    ]
    o = date_range_axis(DateRange(("s", "e"), "2024-01-01", "2024-01-08", "1 week", "10 days"))
    assert _plan(spark, [o]) == [(0, {"s": "2024-01-01", "e": "2024-01-08"}), (1, {"s": "2024-01-08", "e": "2024-01-08"})]


def test_one_day_one_param_and_formats(spark):
    a = date_range_axis(DateRange(("since",), "2024-02-29", "2024-02-29", "1 day"),
                        {"since": Param("since", "date", format="%m/%d/%Y")})
    assert _plan(spark, [a]) == [(0, {"since": "02/29/2024"})]
    empty = date_range_axis(DateRange(("s",), "2024-02-02", "2024-02-01", "1 day"))
    assert empty.size == 0 and _plan(spark, [empty]) == []


def test_today_and_bad_step(spark):
    a = date_range_axis(DateRange(("s",), "today", "today", "1 day"), today=dt.date(2025, 5, 5))
    assert _plan(spark, [a]) == [(0, {"s": "2025-05-05"})]
    with pytest.raises(ValueError):
        date_range_axis(DateRange(("s",), "2024-01-01", "2024-01-02", "0 days"))


def test_cartesian_first_axis_slowest_later_wins(spark):
    weeks = date_range_axis(DateRange(("d",), "2024-01-01", "2024-01-14", "7 days"))
    states = categorical_axis(spark, Categorical("state", ("open", "closed")))
    clash = categorical_axis(spark, Categorical("d", ("X",)))
    got = _plan(spark, [weeks, states, clash])
    assert got == [
        (0, {"d": "X", "state": "open"}), (1, {"d": "X", "state": "closed"}),
        (2, {"d": "X", "state": "open"}), (3, {"d": "X", "state": "closed"}),
    ]
    assert [p for _, p in _plan(spark, [weeks, states])] == [
        {"d": "2024-01-01", "state": "open"}, {"d": "2024-01-01", "state": "closed"},
        {"d": "2024-01-08", "state": "open"}, {"d": "2024-01-08", "state": "closed"}]


def test_no_axes_one_request_and_limit(spark):
    assert _plan(spark, []) == [(0, {})]
    a = categorical_axis(spark, Categorical("c", tuple(range(10))))
    assert plan_limit(build_plan(spark, [a]), 3).count() == 3


def test_static_then_dynamic_then_overrides(spark):
    plan = build_plan(spark, [categorical_axis(spark, Categorical("page", (1, 2)))])
    out = request_params(plan, {"page": "0", "key": "k"}, {"key": parse_override("7")})
    got = [dict(r["params"]) for r in out.orderBy("req_idx").collect()]
    assert got == [{"page": "1", "key": "7"}, {"page": "2", "key": "7"}]
    assert parse_override("7") == 7 and parse_override("7.5") == 7.5 and parse_override("x") == "x"


def test_uncovered_params():
    params = [Param("a"), Param("b", value=1), Param("c"), Param("d")]
    axes = [DateRange(("a",), "2024-01-01", "2024-01-02", "1 day"), Categorical("c", (1,))]
    assert uncovered_params(params, axes) == ["d"]


def test_plan_has_no_cross_join(spark):
    weeks = date_range_axis(DateRange(("d",), "2024-01-01", "2024-03-01", "7 days"))
    states = categorical_axis(spark, Categorical("s", ("a", "b")))
    plan = build_plan(spark, [weeks, states])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_override_date_range():
    from gleaner.plans import override_date_range
    from gleaner.spec import Cadence, Collector, HttpSource

    c = Collector("c", HttpSource("http://x", params=(Param("s"),)),
                  Cadence("append", iterate=(DateRange(("s",), "2024-01-01", "2024-12-31", "1 day"),
                                             Categorical("k", (1,)))))
    o = override_date_range(c, "2024-03-01", "2024-03-02")
    assert (o.cadence.iterate[0].start, o.cadence.iterate[0].end) == ("2024-03-01", "2024-03-02")
    assert o.cadence.iterate[1] == c.cadence.iterate[1] and c.cadence.iterate[0].start == "2024-01-01"


def test_cartesian_equals_product(spark):
    import itertools

    a = categorical_axis(spark, Categorical("a", (1, 2, 3)))
    b = date_range_axis(DateRange(("d",), "2024-01-01", "2024-01-03", "1 day"))
    c = categorical_axis(spark, Categorical("c", ("x", "y")))
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    expected = [{"a": str(x), "d": d, "c": z} for x, d, z in itertools.product((1, 2, 3), days, ("x", "y"))]
    assert [p for _, p in _plan(spark, [a, b, c])] == expected
