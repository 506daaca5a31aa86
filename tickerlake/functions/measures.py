"""Numeric expressions used by several operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_change(now: Column, base: Column) -> Column:
    """(now - base) / base * 100; NULL when the base is missing or zero."""
    return F.try_divide(now - base, base) * 100


def mean_of(*values: Column) -> Column:
    """Mean of the non-NULL values of one row, NULL when all are missing."""
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])
    count = reduce(lambda a, b: a + b, [v.isNotNull().cast("int") for v in values])
    return F.try_divide(total, count)


def min_max_scale(value: Column, low: Column, high: Column) -> Column:
    """0..100 position of ``value``; a flat range gives 50, a missing value stays NULL."""
    return F.when(value.isNotNull(), F.when(low == high, F.lit(50.0)).otherwise((value - low) / (high - low) * 100))


def clip_0_100(value: Column) -> Column:
    # least and greatest skip NULLs, so a missing value has to be kept out
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(100.0)))


def cagr(last: Column, first: Column, days: Column) -> Column:
    """(last / first) ^ (365 / days) - 1."""
    return F.pow(F.try_divide(last, first), F.try_divide(F.lit(365.0), days)) - 1


def daily_rate(percent: Column) -> Column:
    """Annual percent to a daily fraction over 252 sessions."""
    return percent / 100 / 252


def score_band(score: Column) -> Column:
    """Text for a 0..100 score in steps of 20."""
    return (
        F.when(score < 20, "Very weak")
        .when(score < 40, "Weak")
        .when(score < 60, "Average")
        .when(score < 80, "Strong")
        .when(score.isNotNull(), "Very strong")
    )
