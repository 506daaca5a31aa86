"""Month-end cut-offs and horizon dates. Cut-off lists have twelve entries and live in the plan as literals."""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _previous_month_ends(as_of: Column, first: int, last: int) -> Column:
    return F.transform(F.sequence(F.lit(first), F.lit(last)), lambda i: F.last_day(F.add_months(as_of, -i)))


def historical_month_ends(as_of: Column, n: int = 12) -> Column:
    """The date itself and the ``n - 1`` month ends before it, ascending."""
    return F.array_sort(F.concat(F.array(as_of), _previous_month_ends(as_of, 1, n - 1)))


def month_ends_clipped(as_of: Column, n: int = 12) -> Column:
    """Structs (label, cutoff): the last ``n`` month ends, data cut at the date itself."""
    return F.transform(
        F.array_sort(_previous_month_ends(as_of, 0, n - 1)),
        lambda d: F.struct(d.alias("month_end"), F.least(d, as_of).alias("cutoff")),
    )


def month_ends_up_to(as_of: Column, n: int = 12) -> Column:
    """The last ``n`` month ends not after the date."""
    start = F.when(F.last_day(as_of) == as_of, F.lit(0)).otherwise(F.lit(1))
    return F.array_sort(
        F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.last_day(F.add_months(as_of, -i - start)))
    )


def date_array(days: list[date]) -> Column:
    """The dates as one literal array, parsed in a single call."""
    return F.expr("array(" + ", ".join(f"DATE '{d}'" for d in days) + ")")


def latest_date(df: DataFrame, column: str = "date") -> date:
    """One scalar on the driver: the default "today" of every job."""
    return df.agg(F.max(column)).first()[0]


def dates_of(df: DataFrame, build, column: str = "date") -> list:
    """Cut-off list for the newest date in ``df`` (``build`` is one of the functions above)."""
    return df.agg(F.max(column).alias("_d")).select(build(F.col("_d"))).first()[0]


def months_back(day: date, months: int) -> date:
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def ytd_base(day: date, mode: str) -> date:
    """Last day a year-to-date base price may carry: Jan 1 (``le``) or Dec 31 (``lt``)."""
    return date(day.year, 1, 1) if mode == "le" else date(day.year - 1, 12, 31)


def day_horizons(day: date, ytd_mode: str = "le") -> dict[str, date]:
    """Horizon base dates by day counts."""
    return {
        "return_1m": day - timedelta(days=30),
        "return_ytd": ytd_base(day, ytd_mode),
        "return_1y": day - timedelta(days=365),
        "return_3y": day - timedelta(days=1095),
        "return_5y": day - timedelta(days=1825),
    }


def calendar_horizons(day: date) -> dict[str, date]:
    """Horizon base dates by calendar months; year-to-date from the last price before Jan 1."""
    return {
        "return_1m": months_back(day, 1),
        "return_ytd": ytd_base(day, "lt"),
        "return_1y": months_back(day, 12),
        "return_3y": months_back(day, 36),
        "return_5y": months_back(day, 60),
    }
