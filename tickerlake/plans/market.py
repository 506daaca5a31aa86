"""Market reports over daily prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.operators.timeseries import latest_trend, price_performance
from tickerlake.operators.topk import gainers_losers, topk_per_sector
from tickerlake.session import materialise

# The sixteen market and sector symbols, and the sector each sector fund stands for.
SECTOR_FUNDS = {
    "XLK": "Technology", "XLV": "Healthcare", "XLF": "Financial Services", "XLY": "Consumer Cyclical",
    "XLI": "Industrials", "XLB": "Basic Materials", "XLE": "Energy", "XLU": "Utilities", "XLRE": "Real Estate",
    "XLC": "Communication Services", "XLP": "Consumer Defensive",
}
INDEX_SYMBOLS = ["XIU.TO", "^GSPC", "QQQ", "DIA", "SPY"]
# Members of the Toronto index fund, without the exchange suffix.
TORONTO_MEMBERS = [
    "AEM", "AQN", "ATD", "BMO", "BNS", "ABX", "BCE", "BAM", "BN", "BIP-UN", "CAE", "CCO", "CAR-UN", "CM", "CNR", "CNQ", "CP", "CTC-A",
    "CCL-B", "CVE", "GIB-A", "CSU", "DOL", "EMA", "ENB", "FM", "FSV", "FTS", "FNV", "WPM", "GIL", "H", "IMO", "IFC", "K", "L", "MG", "MFC",
    "MRU", "NA", "NTR", "OTEX", "PPL", "POW", "QSR", "RCI-B", "RY", "SAP", "SHOP", "SLF", "SU", "TRP", "TECK-B", "T", "TRI", "TD", "TOU",
    "WCN", "WSP",
]

CHANGES = ["price", "day_change", "week_change", "quarter_change", "ytd_change"]
PAGE = ["parent_symbol", "symbol", "type", "category", "rank", "sector", "industry", "name", *CHANGES, "trend"]


def toronto_members(spark: SparkSession) -> DataFrame:
    """(parent_symbol, symbol) of the Toronto index fund."""
    return spark.createDataFrame([("XIU.TO", f"{s}.TO") for s in TORONTO_MEMBERS], "parent_symbol string, symbol string")


def performance_with_trend(quotes: DataFrame, basis: str) -> DataFrame:
    trend = latest_trend(quotes, basis=basis).select("symbol", "trend")
    return price_performance(quotes).join(trend, "symbol").select("symbol", *CHANGES, "trend")


def index_performance(quotes: DataFrame, symbols: DataFrame) -> DataFrame:
    """Price, changes and weekly trend of the listed symbols."""
    wanted = quotes.join(symbols.select("symbol"), "symbol", "left_semi")
    return performance_with_trend(wanted, "weekly")


def sector_top_holdings(profile: DataFrame, quotes: DataFrame, k: int = 10) -> DataFrame:
    """The largest caps per sector with changes and daily-basis trend; quotes are cut to those symbols first."""
    top = topk_per_sector(profile, k).select("sector", "rank", "symbol", "company_name", "mkt_cap")
    wanted = quotes.join(top.select("symbol"), "symbol", "left_semi")
    return top.join(performance_with_trend(wanted, "daily"), "symbol", "left")


def market_pages(
    quotes: DataFrame, parent_quotes: DataFrame, profile: DataFrame, constituents: DataFrame, sectors: dict[str, str]
) -> DataFrame:
    """Per parent its own row and its ten best and worst members of the day.

    A parent's prices come from the equity quotes, else from the market and sector quotes. Quotes are cut to members and parents before anything is computed, and
    the result is stored, because both uses read it.
    """
    named = profile.select("symbol", "sector", "industry", F.col("company_name").alias("name"))
    constituents = materialise(constituents, "constituents")
    parents = constituents.select(F.col("parent_symbol").alias("symbol")).distinct()
    wanted = materialise(constituents.select("symbol").unionByName(parents).distinct(), "page-symbols")
    member_rows = materialise(performance_with_trend(quotes.join(wanted, "symbol", "left_semi"), "weekly"), "page-rows")
    ranked = gainers_losers(constituents.join(member_rows, "symbol"), ["parent_symbol"])
    movers = ranked.withColumn("type", F.lit("Stock"))

    own = member_rows.join(parents, "symbol", "left_semi")
    # only parents without equity quotes fall back
    other = parent_quotes.join(parents, "symbol", "left_semi").join(own.select("symbol"), "symbol", "left_anti")
    is_sector = F.col("symbol").isin(list(sectors))
    main = own.unionByName(performance_with_trend(other, "weekly")).select(
        F.col("symbol").alias("parent_symbol"), "*",
        F.when(is_sector, "Sector").otherwise("Index").alias("type"),
        F.lit("Main").alias("category"), F.lit(None).cast("int").alias("rank"),
    )
    rows = movers.select("parent_symbol", "symbol", "type", "category", "rank", *CHANGES, "trend").unionByName(
        main.select("parent_symbol", "symbol", "type", "category", "rank", *CHANGES, "trend")
    )
    return rows.join(named, "symbol", "left").select(*PAGE)
