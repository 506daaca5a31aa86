"""As-of lookups for a fixed list of target dates.

Every row falls into the interval that ends at the first target at or after its date. One
aggregate keeps the newest row per (key, interval) - combined map-side, so the shuffle carries
at most one row per key, interval and task - and the per-key list of levels answers every target.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.functions.measures import percent_change
from tickerlake.operators.calendar import date_array


def interval_index(day: str, targets: list[date]) -> Column:
    """Position of the first target at or after ``day``; NULL beyond the last one."""
    steps = " ".join(f"WHEN {day} <= DATE '{t}' THEN {i}" for i, t in enumerate(targets))
    return F.expr(f"CASE {steps} END")


def asof_levels(df: DataFrame, keys: list[str], day: str, targets: list[date], payload: list[str]) -> DataFrame:
    """Per key ``_levels``: newest row of each interval, at most one entry per target."""
    newest = (
        df.filter(F.col(day) <= F.lit(targets[-1]))
        .groupBy(*keys, interval_index(day, targets).alias("_i"))
        .agg(F.max(day).alias(day), *[F.max_by(c, day).alias(c) for c in payload])
    )
    return newest.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", day, *payload))).alias("_levels"))


def level_at(index) -> Column:
    """The level in force at the target with this position, NULL if none."""
    return F.try_element_at(F.filter("_levels", lambda level: level["_i"] <= index), F.lit(-1))


def asof_latest_record(df: DataFrame, keys: list[str], day: str, cutoffs: list[date], payload: list[str]) -> DataFrame:
    """The newest row per key at or before each cut-off. A NULL in that row stays NULL."""
    # transform hands the position along with the cut-off
    found = F.transform(date_array(cutoffs), lambda c, i: F.struct(c.alias("cutoff"), level_at(i).alias("_r")))
    return (
        asof_levels(df, keys, day, cutoffs, payload)
        .select(*keys, F.inline(found))
        .filter(F.col("_r").isNotNull())
        .select(*keys, "cutoff", F.col(f"_r.{day}").alias("record_date"), *[F.col(f"_r.{c}").alias(c) for c in payload])
    )


def asof_prices(df: DataFrame, price: str, cutoffs: dict[date, dict[str, date]], keys: list[str] | None = None) -> DataFrame:
    """Price in force at each cut-off and at each of its named base dates.

    ``cutoffs`` maps a cut-off to {name: base date}. One row per key and cut-off that has a current price.
    """
    keys = keys or ["symbol"]
    targets = sorted(set(cutoffs) | {t for bases in cutoffs.values() for t in bases.values()})
    position = {t: i for i, t in enumerate(targets)}
    names = list(next(iter(cutoffs.values())))
    # one small literal table (cut-off, position of each target), mapped in a single expression
    places = ", ".join(
        f"named_struct('cutoff', DATE '{c}', 'current_price', {position[c]}, "
        + ", ".join(f"'{n}', {position[bases[n]]}" for n in names)
        + ")"
        for c, bases in cutoffs.items()
    )
    wanted = F.expr(f"array({places})")
    rows = F.transform(
        wanted,
        lambda w: F.struct(
            w["cutoff"].alias("cutoff"), *[level_at(w[n])[price].alias(n) for n in ["current_price", *names]]
        ),
    )
    return (
        asof_levels(df, keys, "date", targets, [price])
        .select(*keys, F.inline(rows))
        .filter(F.col("current_price").isNotNull())
    )


def period_returns(df: DataFrame, price: str, cutoffs: dict[date, dict[str, date]]) -> DataFrame:
    """Percent returns per symbol and cut-off; NULL when either price is missing or zero."""
    names = list(next(iter(cutoffs.values())))
    current = F.nullif(F.col("current_price"), F.lit(0.0))
    return asof_prices(df, price, cutoffs).select(
        "symbol", "cutoff", "current_price", *[percent_change(current, F.col(n)).alias(n) for n in names]
    )


def asof_backward(days: DataFrame, series: DataFrame, value: str, out: str, keys: list[str] | None = None) -> DataFrame:
    """For each row of ``days`` the last non-NULL ``value`` of ``series`` at or before its date.

    Spine union and forward fill. A group is one series on calendar days, hence bounded by the
    number of days; without ``keys`` there is exactly one such series.
    """
    keys = keys or []
    spine = days.select(*keys, "date").distinct()
    # series rows sort before spine rows of the same date
    merged = series.select(*keys, "date", F.col(value).alias("_v"), F.lit(0).alias("_side")).unionByName(
        spine.select(*keys, "date", F.lit(None).cast(series.schema[value].dataType).alias("_v"), F.lit(1).alias("_side"))
    )
    carried = F.last("_v", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy("date", "_side").rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = merged.withColumn(out, carried).filter("_side = 1").select(*keys, "date", out)
    # a single series has one row per calendar day
    return days.join(filled if keys else F.broadcast(filled), [*keys, "date"], "left")
