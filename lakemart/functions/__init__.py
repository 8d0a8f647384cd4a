"""Scalar column functions (all built-in Spark expressions)."""

from lakemart.functions.columns import (
    CASUAL,
    MEMBER,
    date_key,
    duration_minutes,
    epoch_seconds,
    member_type,
    minutes_rounded,
    minutes_to_seconds,
    money_mean,
    money_ratio,
    money_rounded,
    ratio_rounded,
    typed,
    whole_years_between,
)
from lakemart.functions.exact import floor_div, floor_div_long, half_up_div, half_up_div_long

__all__ = [
    "CASUAL",
    "MEMBER",
    "date_key",
    "duration_minutes",
    "epoch_seconds",
    "floor_div",
    "floor_div_long",
    "half_up_div",
    "half_up_div_long",
    "member_type",
    "minutes_rounded",
    "minutes_to_seconds",
    "money_mean",
    "money_ratio",
    "money_rounded",
    "ratio_rounded",
    "typed",
    "whole_years_between",
]
