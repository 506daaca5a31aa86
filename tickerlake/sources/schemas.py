"""Declared schemas, keys and file routes of the vendor feeds (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

QUOTE_SCHEMA = (
    "date date, open double, high double, low double, close double, adj_close double, volume bigint, "
    "unadjusted_volume bigint, change double, change_percent double, vwap double, label string, "
    "change_over_time double, symbol string"
)
BULK_EOD_SCHEMA = "symbol string, date date, open double, low double, high double, close double, adjClose double, volume double"
FUND_QUOTE_COLUMNS = [
    "instrument_key", "date", "navps", "daily_total_distribution", "daily_dividend_income_distribution",
    "daily_foreign_dividend_income_distribution", "daily_capital_gains_distribution",
    "daily_interest_income_distribution", "daily_return_of_principle_distribution", "distribution_pay_date",
    "split_factor", "navps_percent_change", "penny_change_day", "current_yield", "current_yield_percent_change",
]
# API column -> fund quote column; the distribution columns are not in the API response.
FUND_QUOTE_SOURCES = {
    "instrument_key": "InstrumentKey", "date": "Date", "navps": "NAVPS", "split_factor": "Split",
    "navps_percent_change": "NAVPSPercentChange", "penny_change_day": "NAVPSPennyChange",
    "current_yield": "CurrentYield", "current_yield_percent_change": "CurrentYieldPercentChange",
}

# Profile: column -> type; text columns are listed once.
PROFILE_TEXT = (
    "symbol range company_name currency cik isin cusip exchange exchange_short_name industry website description "
    "ceo sector country phone address city state zip image"
).split()
PROFILE_TYPES = {
    **{c: "string" for c in PROFILE_TEXT},
    **{c: "double" for c in "price beta last_div changes dcf_diff dcf".split()},
    **{c: "bigint" for c in "vol_avg mkt_cap full_time_employees".split()},
    **{c: "boolean" for c in "default_image is_etf is_actively_trading is_adr is_fund".split()},
    "ipo_date": "date",
}
PROFILE_RENAMES = {"range": "range_str", "zip": "zip_code"}

STATEMENT_HEADER = {
    "date": "date", "symbol": "string", "reported_currency": "string", "cik": "string", "filling_date": "date",
    "accepted_date": "timestamp", "calendar_year": "smallint", "period": "string", "link": "string", "final_link": "string",
}


def statement_type(column: str) -> str:
    """Type of a statement column: header fields as listed, ratios and per-share values double, amounts decimal."""
    if column in STATEMENT_HEADER:
        return STATEMENT_HEADER[column]
    return "double" if column.endswith(("ratio", "eps", "epsdiluted", "_per_share")) else "decimal(38,6)"


# Declared keys, used as dedupe contracts and by the duplicate report.
SYMBOL_DATE = ["symbol", "date"]
KEYS = {
    **{t: ["symbol"] for t in "equity_profile equity_financial_scores equity_std_dev etfs_profile index_performance".split()},
    **{
        t: SYMBOL_DATE
        for t in (
            "equity_income equity_balance equity_cashflow equity_earnings equity_financial_ratio equity_key_metrics "
            "equity_balance_growth equity_cashflow_growth equity_financial_growth equity_income_growth equity_quotes "
            "etfs_quotes market_sector_quotes etfs_scores"
        ).split()
    },
    "equity_peers": ["symbol", "peer_symbol"],
    "etfs_peers": ["symbol", "peer_symbol"],
    "fund_quotes": ["instrument_key", "date"],
    "market_sector_pages_performance": ["parent_symbol", "symbol", "category"],
    "sector_top_holdings": ["sector", "rank"],
    "top_10": ["type", "rank"],
}

# Seed file stem -> table is camel case to snake case; the names that do not follow the rule are listed.
FUND_SEED_SUFFIX = "Seed.csv"
# The seed files.
FUND_SEEDS = [
    "BenchmarkGeneralSeed.csv", "BenchmarkYearlyPerformanceSeed.csv", "FundAdvancedPerformanceSeed.csv", "FundAllocationSeed.csv", "FundAssetsSeed.csv",
    "FundAssociateBenchmarkSeed.csv", "FundDailyNAVPSSeed.csv", "FundDistributionSeed.csv", "FundEquityStyleSeed.csv", "FundExpensesSeed.csv",
    "FundFixedIncomeStyleSeed.csv", "FundGeneralSeed.csv", "FundLoadsSeed.csv", "FundOtherFeeSeed.csv", "FundPerformanceSummarySeed.csv",
    "FundRiskYearlyPerformanceSeed.csv", "FundTopHoldingSeed.csv", "FundTrailerScheduleSeed.csv", "FundYearlyPerformanceRankingByClassSeed.csv",
    "FundYearlyPerformanceSeed.csv", "InstrumentIdentifierSeed.csv",
]
FUND_SEED_EXCEPTIONS = {
    "FundDailyNAVPSSeed.csv": "fund_daily_nav",
    "FundOtherFeeSeed.csv": "fund_other_fees",
    "FundTopHoldingSeed.csv": "fund_top_holdings",
    "FundYearlyPerformanceRankingByClassSeed.csv": "fund_yearly_performance_ranking",
}


def struct_of(names: list[str], to: str = "string") -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType() if to == "string" else T.DoubleType()) for n in names])

# Smallest row count of a table that counts as loaded.
SEED_MINIMUMS = {
    "equity_profile": 4_000, "equity_income": 270_000, "equity_balance": 260_000, "equity_cashflow": 260_000,
    "equity_earnings": 250_000, "equity_peers": 25_000, "equity_financial_ratio": 275_000, "equity_key_metrics": 275_000,
    "equity_financial_scores": 4_000, "etfs_profile": 1_500, "etfs_peers": 5_000, "etfs_data": 700_000,
    "equity_balance_growth": 200_000, "equity_cashflow_growth": 200_000, "equity_financial_growth": 200_000,
    "equity_income_growth": 200_000, "equity_quotes": 10_000_000, "etfs_quotes": 500_000, "fund_general": 2_000,
    "benchmark_general": 100, "fund_daily_nav": 100_000, "instrument_identifier": 5_000, "fund_performance_summary": 10_000,
    "fund_allocation": 10_000, "fund_expenses": 10_000, "fund_yearly_performance": 10_000, "fund_quotes": 100_000,
    "benchmark_yearly_performance": 100, "fund_advanced_performance": 100, "fund_assets": 100, "fund_associate_benchmark": 100,
    "fund_distribution": 100, "fund_equity_style": 100, "fund_fixed_income_style": 100, "fund_loads": 100, "fund_other_fees": 100,
    "fund_risk_yearly_performance": 100, "fund_top_holdings": 100, "fund_trailer_schedule": 100, "fund_yearly_performance_ranking": 100,
}
# The tables without which a load counts as failed.
CRITICAL_TABLES = [
    "equity_profile", "equity_quotes", "equity_balance_growth", "equity_cashflow_growth", "equity_financial_growth", "equity_income_growth", "etfs_quotes",
]
CRITICAL_MINIMUMS = {t: SEED_MINIMUMS[t] for t in CRITICAL_TABLES}
