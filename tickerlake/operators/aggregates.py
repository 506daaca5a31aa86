"""Grouped aggregates and group normalisation. Extremes are aggregated first and joined back,
so no task has to hold a whole group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.functions.measures import clip_0_100, min_max_scale
from tickerlake.operators.skew import join_unique
from tickerlake.session import materialise, reason_of


def peer_count_having(peers: DataFrame, at_most: int = 3) -> DataFrame:
    return peers.groupBy("symbol").agg(F.count("peer_symbol").alias("peer_count")).filter(F.col("peer_count") <= at_most)


def latest_rows_per_type(scores: DataFrame, kind: str = "score_type", day: str = "date") -> DataFrame:
    """Rows of each type's newest date (a handful of types)."""
    newest = scores.groupBy(kind).agg(F.max(day).alias(day))
    return scores.join(F.broadcast(newest), [kind, day], "left_semi")


def avg_score_by_group(scores: DataFrame, profile: DataFrame) -> DataFrame:
    """Mean score at the newest date per type, by sector and by industry: one pass over both groupings.

    Averaged as decimals, so the rounding does not depend on the order of the rows.
    """
    latest = latest_rows_per_type(scores).filter("score IS NOT NULL")
    named = latest.join(profile.select("symbol", "sector", "industry"), "symbol")
    return (
        named.groupingSets([["score_type", "sector"], ["score_type", "industry"]], "score_type", "sector", "industry")
        .agg(F.round(F.avg(F.col("score").cast("decimal(18,6)")), 2).alias("avg_score"), F.grouping("sector").alias("_by_industry"))
        .select(
            F.when(F.col("_by_industry") == 1, "industry").otherwise("sector").alias("group_type"),
            F.when(F.col("_by_industry") == 1, F.col("industry")).otherwise(F.col("sector")).alias("group_name"),
            "score_type",
            "avg_score",
        )
        .filter("group_name IS NOT NULL")
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, error) for every table, counted in one job. A table that cannot be read has no count but the reason.

    Only when that job fails are tables counted one by one.
    """
    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(None).cast("string").alias("error"))

    spark = next(iter(tables.values())).sparkSession
    try:
        merged = reduce(DataFrame.unionByName, [counted(n, df) for n, df in tables.items()])
        found = [tuple(r) for r in merged.collect()]
    except Exception:  # any failure to read is the table's state
        found = []
        for name, df in tables.items():
            try:
                found.append(tuple(counted(name, df).first()))
            except Exception as error:
                found.append((name, None, reason_of(error)))
    # a row per table
    return spark.createDataFrame(found, "table string, rows bigint, error string")


def minmax_normalise_universe(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Each column to 0..100 over all rows of one date; the extremes are one row per date."""
    extremes = df.groupBy(by).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns]
    )
    scaled = {c: clip_0_100(min_max_scale(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}"))) for c in columns}
    # the number of dates is fixed by the caller's cut-off list
    return df.join(F.broadcast(extremes), by).withColumns(scaled).select(*df.columns)


def minmax_normalise_group(df: DataFrame, by: list[str], columns: list[str], key: str = "symbol") -> DataFrame:
    """Each column to 0..100 inside its group; flat groups give 50. ``key`` tells the rows of a group apart."""
    df = materialise(df, "groups")
    extremes = df.groupBy(*by).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns]
    )
    scaled = {c: min_max_scale(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}")) for c in columns}
    return join_unique(df, extremes, by, key).withColumns(scaled).select(*df.columns)


def ohlcv_daily(ticks: DataFrame, key: str, ts: str, price: str, volume: str, tie: str) -> DataFrame:
    """First, highest, lowest and last price, volume and count per day and key."""
    at = F.struct(F.col(ts), F.col(tie))
    return ticks.groupBy(key, F.col(ts).cast("date").alias("day")).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, at).alias("close"), F.sum(volume).alias("volume"), F.count("*").alias("trades"),
    )


def nav_monthly(navs: DataFrame, key: str, nav: str, yield_column: str) -> DataFrame:
    """Month summary per fund over rows that have a NAV."""
    return navs.filter(F.col(nav).isNotNull()).groupBy(key, F.trunc("date", "month").alias("month")).agg(
        F.min_by(nav, "date").alias("opening_nav"), F.max_by(nav, "date").alias("closing_nav"),
        F.max(nav).alias("max_nav"), F.min(nav).alias("min_nav"), F.avg(yield_column).alias("avg_yield"),
        F.count("*").alias("trading_days"),
    )


def usage_by_minute(calls: DataFrame, remaining: str | None = None) -> DataFrame:
    """Calls, mean response and lowest remaining quota per minute and endpoint."""
    extra = [F.min(remaining).alias("min_rate_limit")] if remaining else []
    return (
        calls.groupBy(F.window("ts", "1 minute").alias("_w"), "endpoint")
        .agg(F.count("*").alias("call_count"), F.avg("response_time_ms").alias("avg_response_time"), *extra)
        .withColumn("minute", F.col("_w.start"))
        .drop("_w")
    )


def daily_market_summary(rows: DataFrame, value: str) -> DataFrame:
    return rows.groupBy("date").agg(F.count("*").alias("total_symbols"), F.avg(value).alias("avg_navps"))


def category_average(rows: DataFrame, category: str | list[str], value: str | list[str], key: str = "symbol") -> DataFrame:
    """Each row with its category's mean of one or several values. ``key`` tells the rows of a category apart."""
    by, values = ([x] if isinstance(x, str) else x for x in (category, value))
    rows = materialise(rows, "category")
    means = rows.groupBy(*by).agg(*[F.avg(v).alias(f"{v}_category") for v in values])
    return join_unique(rows, means, by, key)


def exposure_by_dimension(holdings: DataFrame, fund: str, dimension: str, value: str) -> DataFrame:
    """Percent of a fund's value per dimension member."""
    parts = holdings.groupBy(fund, dimension).agg(F.sum(value).alias("value"))
    totals = parts.groupBy(fund).agg(F.sum("value").alias("_total"))
    return parts.join(totals, fund).select(
        fund, dimension, "value", (F.try_divide(F.col("value"), F.col("_total")) * 100).alias("weight_percentage")
    )
