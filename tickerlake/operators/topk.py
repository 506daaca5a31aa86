"""Top-k reports. ``row_number <= k`` is pushed below the shuffle, so a task sends k rows per group at most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.functions.measures import percent_change
from tickerlake.operators.ranking import rank_across


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    best = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(rank, best).filter(F.col(rank) <= k)


def topk_per_sector(profile: DataFrame, k: int = 10) -> DataFrame:
    """The largest caps of each sector."""
    sized = profile.filter("mkt_cap > 0 AND sector IS NOT NULL")
    return top_k(sized, ["sector"], [F.col("mkt_cap").desc(), F.col("symbol")], k)


def rank_in_sector(profile: DataFrame) -> DataFrame:
    """Every company's rank by size in its sector, however large the sector."""
    sized = profile.filter("mkt_cap > 0 AND sector IS NOT NULL")
    return rank_across(sized, ["sector"], [F.col("mkt_cap").desc(), F.col("symbol")], "rank")


def gainers_losers(df: DataFrame, by: list[str], change: str = "day_change", k: int = 10) -> DataFrame:
    """Best and worst ``k`` per group; the two lists overlap in small groups, as in the source reports."""
    known = df.filter(F.col(change).isNotNull())
    up = top_k(known, by, [F.col(change).desc(), F.col("symbol")], k).withColumn("category", F.lit("Gainer"))
    down = top_k(known, by, [F.col(change).asc(), F.col("symbol").desc()], k).withColumn("category", F.lit("Loser"))
    return up.unionByName(down)


def top10_market(changes: DataFrame, universe: DataFrame, change: str = "changes_percentage", k: int = 10) -> DataFrame:
    """Ten best and ten worst of the universe; a missing change counts as 0."""
    known = changes.join(universe.select("symbol"), "symbol", "left_semi").select(
        "symbol", F.coalesce(F.col(change), F.lit(0.0)).alias(change)
    )
    up = known.orderBy(F.col(change).desc(), "symbol").limit(k).withColumn("type", F.lit("gainer"))
    down = known.orderBy(F.col(change).asc(), "symbol").limit(k).withColumn("type", F.lit("loser"))
    sign = F.when(F.col("type") == "gainer", -F.col(change)).otherwise(F.col(change))
    place = F.row_number().over(Window.partitionBy("type").orderBy(sign, "symbol"))
    return up.unionByName(down).withColumn("rank", place)


def last_day_change(quotes: DataFrame, price: str = "adj_close") -> DataFrame:
    """Percent change between each symbol's two newest rows."""
    newest = top_k(quotes.select("symbol", "date", price), ["symbol"], [F.col("date").desc()], 2, "_n")
    now, before = (F.max(F.when(F.col("_n") == n, F.col(price))) for n in (1, 2))
    return newest.groupBy("symbol").agg(percent_change(now, before).alias("changes_percentage"))
