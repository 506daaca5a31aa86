"""The recurring jobs end to end on a small catalogue."""

import math
from datetime import date, timedelta

import pytest

from tickerlake import jobs
from tickerlake.functions.measures import score_band
from tickerlake.operators.universe import CANADA_STOCKS, US_STOCKS, file_family, screener_filter
from tickerlake.plans.market import SECTOR_FUNDS
from tickerlake.sources import schemas
from tickerlake.sources.sinks import sink_replace
from pyspark.sql import functions as F

START = date(2019, 1, 1)
SYMBOLS = ["AAA", "BBB", "CCC", "DDD"]


def wave(k, i):
    return 100 + 10 * k + 5 * math.sin(i / (7 + k)) + i * 0.01 * (k + 1)


@pytest.fixture(scope="module")
def catalogue(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    spark.sql(f"CREATE DATABASE jobs_test LOCATION '{tmp_path_factory.mktemp('db')}'")
    spark.sql("USE jobs_test")
    days = [START + timedelta(days=i) for i in range(1900)]
    header = [c.split()[0] for c in schemas.QUOTE_SCHEMA.split(", ")]
    by_year = {}
    for k, s in enumerate(SYMBOLS):
        for i, d in enumerate(days):
            p = wave(k, i)
            values = [d, p, p, p, p, p, "1000.0", 1000, 0, 0, p, f'"January 1, 19"', 0, s]
            by_year.setdefault(d.year, []).append(",".join(map(str, values)))
    for year, lines in by_year.items():
        (folder / f"equity_quote_{year}.csv").write_text("\n".join([",".join(header), *lines]) + "\n")
    jobs.load_quotes(spark, str(folder))

    objects = folder / "profiles.json"
    objects.write_text("\n".join(
        f'{{"symbol":"{s}","companyName":"{s} Inc","sector":"Technology","industry":"Chips","currency":"USD","mktCap":"{1000 + k}"}}'
        for k, s in enumerate(SYMBOLS)))
    jobs.load_profiles(spark, str(objects))
    (folder / "peers.csv").write_text('symbol,peers\nAAA,"BBB, CCC,,"\nBBB,"AAA"\nZZZ,"AAA"\n')
    jobs.load_peers(spark, str(folder / "peers.csv"))

    quarters = [d for d in days if d.day == 1 and d.month in (1, 4, 7, 10)]
    ratio_columns = "return_on_equity net_profit_margin operating_profit_margin debt_equity_ratio current_ratio interest_coverage price_earnings_ratio price_to_book_ratio price_earnings_to_growth_ratio".split()
    ratios = [(s, d, *[float((k + 2) * (j + 1) % 7 + 1) for j in range(9)]) for k, s in enumerate(SYMBOLS) for d in quarters]
    sink_replace(spark.createDataFrame(ratios, "symbol string, date date, " + ", ".join(f"{c} double" for c in ratio_columns)), "equity_financial_ratio")
    growth = [(s, d, 0.1 * k, 0.2 * k, 0.3 * k) for k, s in enumerate(SYMBOLS) for d in quarters]
    sink_replace(spark.createDataFrame(growth, "symbol string, date date, revenue_growth double, three_y_revenue_growth_per_share double, three_y_net_income_growth_per_share double"), "equity_financial_growth")
    sink_replace(spark.createDataFrame([(s, d, 0.1 * k) for k, s in enumerate(SYMBOLS) for d in quarters], "symbol string, date date, roe double"), "equity_key_metrics")

    quotes = spark.table("equity_quotes")
    sink_replace(quotes.withColumn("symbol", F.when(F.col("symbol") == "AAA", "SPY").when(F.col("symbol") == "BBB", "XLK").otherwise(F.col("symbol"))), "market_sector_quotes")
    sink_replace(quotes.withColumn("symbol", F.concat(F.lit("F"), "symbol")), "etfs_quotes")
    sink_replace(spark.createDataFrame([(f"F{s}", 0.1 + k) for k, s in enumerate(SYMBOLS)], "symbol string, expense_ratio double"), "etfs_profile")
    sink_replace(spark.createDataFrame([("FAAA", "FBBB"), ("FAAA", "FCCC")], "symbol string, peer_symbol string"), "etfs_peers")
    (folder / "treasury.csv").write_text("Date,Month3\n2019-01-01,2.5\n2022-01-03,n/a\n2023-01-03,4.5\n")
    jobs.load_treasury(spark, str(folder / "treasury.csv"))
    yield spark
    spark.sql("USE default")


def test_loaded_tables(catalogue):
    quotes = catalogue.table("equity_quotes")
    assert quotes.count() == 4 * 1900
    first = quotes.filter("symbol = 'AAA'").orderBy("date").first()
    assert (first.date, first.volume, first.label) == (START, 1000, "January 1 19")
    assert sorted(map(tuple, catalogue.table("equity_peers").collect())) == [("AAA", "BBB"), ("AAA", "CCC"), ("BBB", "AAA")]
    assert {r.table for r in jobs.seed_report(catalogue, {"equity_quotes": 5, "equity_income": 1, "treasury": 99}).collect()} == {
        "equity_income", "treasury"}


def test_daily_reports(catalogue):
    jobs.daily_reports(catalogue)
    assert {r.symbol for r in catalogue.table("index_performance").collect()} == {"SPY", "XLK"}
    pages = catalogue.table("market_sector_pages_performance")
    xlk = pages.filter("parent_symbol = 'XLK'")
    assert xlk.filter("category = 'Main'").select("type", "symbol").collect() == [("Sector", "XLK")]
    assert xlk.filter("category = 'Gainer'").count() == 4 and xlk.filter("category = 'Loser'").count() == 4
    top = catalogue.table("sector_top_holdings").orderBy("rank").collect()
    assert [r.symbol for r in top] == ["DDD", "CCC", "BBB", "AAA"]
    assert catalogue.table("top_10").count() == 8


def test_weekly_scores(catalogue):
    jobs.weekly_scores(catalogue)
    scores = catalogue.table("peer_scores")
    # groups of AAA (three members) and BBB (two), six categories, twelve dates
    assert scores.count() == 5 * 6 * 12
    assert scores.filter("score < 0 OR score > 100").count() == 0
    universe = catalogue.table("universe_scores")
    assert universe.count() == 4 * 6 * 12
    ranks = universe.groupBy("date", "score_type").agg(F.sort_array(F.collect_list("rank")).alias("r")).select("r").distinct().collect()
    assert [r.r for r in ranks] == [[1, 2, 3, 4]]
    assert catalogue.table("equity_scores_average").count() == 2 * 6
    funds = catalogue.table("etfs_scores")
    assert funds.select("symbol").distinct().count() == 4
    before = scores.count()
    jobs.weekly_scores(catalogue)
    assert catalogue.table("peer_scores").count() == before
    assert catalogue.table("equity_scores_average").count() == 2 * 2 * 6


def test_boost(catalogue):
    edges = catalogue.table("equity_peers")
    from tickerlake.plans.peers import peers_boost_equity

    new = {tuple(r)[:2] for r in peers_boost_equity(catalogue.table("equity_profile"), edges).collect()}
    assert new == {("AAA", "DDD"), ("BBB", "CCC"), ("BBB", "DDD")}


def test_screens(frame):
    columns = "symbol string, exchange_short_name string, country string, price double, vol_avg bigint, is_etf boolean, is_actively_trading boolean"
    profile = frame(columns, ("B", "nyse", "US", 2.0, 60000, False, True), ("A", "NASDAQ", "US", 2.0, 60000, False, True),
                    ("C", "NYSE", "US", 1.0, 60000, False, True), ("D", "NYSE", "US", 2.0, 60000, True, True),
                    ("E", "TSX", "CA", 2.0, 10001, False, True), ("A", "AMEX", "US", 9.0, 50001, False, True))
    assert [r.symbol for r in screener_filter(profile, **US_STOCKS).collect()] == ["A", "B"]
    assert [r.symbol for r in screener_filter(profile, **CANADA_STOCKS).collect()] == ["E"]


def test_file_families_and_bands(frame):
    names = frame("n string", ("equity_quote_2020.csv",), ("etfs_quote_1.csv",), ("FundLoadsSeed.csv",), ("Pricing2015to2017.csv",), ("x.csv",))
    assert [r[0] for r in names.select(file_family(F.col("n"))).collect()] == ["equity_quotes", "etfs_quotes", "fund_seed", "fund_quotes", None]
    scores = frame("s double", (0.0,), (20.0,), (59.9,), (60.0,), (100.0,), (None,))
    assert [r[0] for r in scores.select(score_band(F.col("s"))).collect()] == ["Very weak", "Weak", "Average", "Strong", "Very strong", None]


def test_sixteen_parents():
    from tickerlake.plans.market import INDEX_SYMBOLS

    assert len(INDEX_SYMBOLS) + len(SECTOR_FUNDS) == 16
    assert len(schemas.SEED_MINIMUMS) == 40 and len(schemas.CRITICAL_MINIMUMS) == 7
