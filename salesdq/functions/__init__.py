"""Column helpers shared by the reports."""

from salesdq.functions.semantics import (
    amount,
    any_null,
    calendar_week,
    full_name,
    is_missing,
    month_label,
    month_start,
    null_count,
    percent,
    rounded_ratio,
    weekday_name,
    weighted_stddev_pop,
    whole_units,
)

__all__ = [
    "amount",
    "any_null",
    "calendar_week",
    "full_name",
    "is_missing",
    "month_label",
    "month_start",
    "null_count",
    "percent",
    "rounded_ratio",
    "weekday_name",
    "weighted_stddev_pop",
    "whole_units",
]
