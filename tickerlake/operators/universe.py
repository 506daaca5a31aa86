"""Choosing symbols from the profile table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The screens for stocks and funds.
US_STOCKS = {"exchanges": ["NYSE", "NASDAQ", "AMEX"], "country": "US", "min_price": 1, "min_volume": 50_000}
CANADA_STOCKS = {"exchanges": ["TSX", "TSXV"], "country": "CA", "min_price": 1, "min_volume": 10_000}


def screener_filter(
    profile: DataFrame,
    exchanges: list[str],
    country: str,
    min_price: float,
    min_volume: float,
    is_etf: bool = False,
    limit: int | None = None,
    exchange: str = "exchange_short_name",
    volume: str = "vol_avg",
) -> DataFrame:
    """Symbols of active listings above the price and volume floors, once each, in order; ``limit`` is for pages of a report."""
    listed = profile.filter(
        F.upper(exchange).isin(exchanges)
        & (F.col("country") == country)
        & (F.col("price") > min_price)
        & (F.col(volume) > min_volume)
        & (F.col("is_etf") == is_etf)
        & F.col("is_actively_trading")
    )
    symbols = listed.select("symbol").distinct().orderBy("symbol")
    return symbols if limit is None else symbols.limit(limit)


def etf_profile_filter(profile: DataFrame, size: str = "mkt_cap", min_price: float = 1, min_size: float = 1_000_000) -> DataFrame:
    return profile.filter((F.col("price") > min_price) & (F.col(size) > min_size))


def file_family(name: Column) -> Column:
    """Source family of a dump by its file name; NULL when it is none of ours."""
    seed = name.endswith("Seed.csv") & (name.startswith("Fund") | name.startswith("Benchmark") | name.startswith("Instrument"))
    return (
        F.when(name.startswith("equity_quote_"), "equity_quotes")
        .when(name.startswith("etfs_quote_"), "etfs_quotes")
        .when(seed, "fund_seed")
        .when(name.startswith("Pricing") & name.endswith(".csv"), "fund_quotes")
    )
