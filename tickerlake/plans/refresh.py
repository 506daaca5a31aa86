"""Incremental recompute of stored aggregates."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlake.sources.sinks import replace_partitions


def touched_ranges(changed: DataFrame, unit: str, day: str = "date") -> list[tuple[date, date]]:
    """First day and first day after of the calendar units that hold a changed date, adjoining ones as one; bounded by the calendar."""
    start = F.date_trunc(unit, day).cast("date")
    units = changed.filter(F.col(day).isNotNull()).select(start.alias("start")).distinct()
    after = F.date_trunc(unit, F.date_add("start", {"day": 1, "week": 7, "month": 31, "quarter": 93, "year": 366}[unit])).cast("date")
    ranges: list[tuple[date, date]] = []
    for r in units.select("start", after.alias("after")).orderBy("start").collect():
        if ranges and ranges[-1][1] == r["start"]:
            ranges[-1] = (ranges[-1][0], r["after"])
        else:
            ranges.append((r["start"], r["after"]))
    return ranges


def in_ranges(ranges: list[tuple[date, date]], day: str = "date") -> Column:
    """Literal bounds on the raw column, which reach the scan as partition or pushed filters."""
    found = F.lit(False)
    for start, after in ranges:
        found = found | ((F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(after)))
    return found


def refresh_aggregates(
    raw: DataFrame, changed: DataFrame, path: str, bucket: str, unit: str, aggregate: Callable[[DataFrame], DataFrame], day: str = "date"
) -> DataFrame:
    """Recompute only the calendar units (day, week, month, quarter or year) that hold a changed date, overwrite just their partitions, and return the rows read for that.

    ``aggregate`` yields rows with the column ``bucket``, the first day of the unit.
    """
    ranges = touched_ranges(changed, unit, day)
    rows = raw.filter(in_ranges(ranges, day))
    if ranges:
        replace_partitions(aggregate(rows), path, bucket)
    return rows
