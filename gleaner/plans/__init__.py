"""Request plans: the table of requests one collection run makes."""

from gleaner.plans.requests import (Axis, build_plan, categorical_axis, categorical_axis_from, date_range_axis,
                                    merge_params, override_date_range, duration_days, parse_override, plan_limit,
                                    request_params,
                                    axis_date, uncovered_params)

__all__ = [
    "Axis", "build_plan", "categorical_axis", "categorical_axis_from", "date_range_axis", "merge_params",
    "override_date_range",
    "duration_days", "parse_override", "plan_limit", "request_params", "axis_date", "uncovered_params",
]
