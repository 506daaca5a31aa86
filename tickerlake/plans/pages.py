"""Wide page views: one row per entity, joined from one-row-per-symbol frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.functions.measures import percent_change, score_band
from tickerlake.operators.aggregates import category_average, exposure_by_dimension
from tickerlake.operators.asof import asof_backward
from tickerlake.operators.ranking import quartile_percentile
from tickerlake.operators.skew import join_unique
from tickerlake.operators.timeseries import last_per_key, max_drawdown, newest_dates, price_summary
from tickerlake.operators.topk import top_k
from tickerlake.session import materialise

SLOTS = [f"{c}{r}" for c in ("gainer", "loser") for r in range(1, 11)]
ATTRIBUTES = ["symbol", "sector", "industry", "name", "price", "day_change", "week_change", "quarter_change", "ytd_change", "trend"]


# Columns of the statement tables that pages show.
INCOME = ["revenue", "gross_profit", "operating_income", "net_income", "eps", "ebitda"]
BALANCE = ["total_assets", "current_assets", "total_liabilities", "current_liabilities", "total_equity", "total_debt"]
CASH_FLOW = ["operating_cash_flow", "free_cash_flow"]
GROWTH = ["revenue_growth"]
SCORE_TYPES = ["growth", "valuation", "financial_strength", "profitability", "performance"]
#: Trailing years of the fund page.
YEARS = (1, 3, 5, 10)
HORIZONS = [*[f"{y}y" for y in YEARS], "inception"]


def statement_latest(income: DataFrame, balance: DataFrame, cash_flow: DataFrame, growth: DataFrame) -> DataFrame:
    """Newest row of each statement per symbol, with margins, returns and ratios in percent or as multiples.

    Every symbol with an income statement has a row; ``statement_date`` is that statement's.
    """
    page = last_per_key(income, ["symbol"], "date", INCOME).withColumnRenamed("date", "statement_date")
    for rows, columns in ((balance, BALANCE), (cash_flow, CASH_FLOW), (growth, GROWTH)):
        page = page.join(last_per_key(rows, ["symbol"], "date", columns).drop("date"), "symbol", "left")

    def share(part: str, whole: str):
        return F.try_divide(F.col(part), F.col(whole)) * 100

    return page.withColumns(
        {
            "gross_margin": share("gross_profit", "revenue"), "operating_margin": share("operating_income", "revenue"),
            "net_margin": share("net_income", "revenue"), "roa": share("net_income", "total_assets"), "roe": share("net_income", "total_equity"),
            "current_ratio": F.try_divide(F.col("current_assets"), F.col("current_liabilities")),
            "debt_to_equity": F.try_divide(F.col("total_debt"), F.col("total_equity")),
        }
    )


def scores_wide(scores: DataFrame, types: list[str]) -> DataFrame:
    """Newest score of each type per symbol as ``<type>_score`` from (symbol, date, score_type, score)."""
    newest = scores.groupBy("symbol", "score_type").agg(F.max_by("score", "date").cast("double").alias("score"))
    wide = newest.groupBy("symbol").pivot("score_type", types).agg(F.first("score"))
    return wide.select("symbol", *[F.col(t).alias(f"{t}_score") for t in types])


def with_bands(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_txt": score_band(F.col(c)) for c in columns})


def charts(quotes: DataFrame, statements: DataFrame, values: dict[str, str]) -> DataFrame:
    """Date-ordered (date, value) arrays per symbol: prices (a point per calendar day) and statement values."""

    def chart(value: str):
        return F.sort_array(F.collect_list(F.struct(F.col("date"), F.col(value).alias("value"))))

    prices = quotes.groupBy("symbol").agg(chart("adj_close").alias("price_chart"))
    others = statements.groupBy("symbol").agg(*[chart(c).alias(name) for c, name in values.items()])
    return prices.join(others, "symbol", "left")


def equity_page(
    profile: DataFrame, quotes: DataFrame, statements: dict[str, DataFrame], ratios: DataFrame, scores: DataFrame, composite: str = "composite"
) -> DataFrame:
    """Profile, price changes and range, valuation, newest statements, newest scores with their text bands, and charts.

    ``statements`` has the income, balance, cash_flow and growth tables, ``scores`` is the universe score table (symbol, date, score_type, score),
    ``last_div`` of the profile the yearly dividend.
    """
    types = [*SCORE_TYPES, composite]
    summary = price_summary(quotes, volume="volume").select(
        "symbol", "price", "volume", "day_change", "week_change", "quarter_change", "ytd_change", "perf_1m", "perf_1y", "low_52_week", "high_52_week")
    valued = last_per_key(ratios, ["symbol"], "date", ["price_earnings_ratio"]).select("symbol", F.col("price_earnings_ratio").alias("pe"))
    shown = {"revenue": "sales_chart", "eps": "eps_chart", "net_income": "earnings_chart"}
    page = (
        profile.drop("price")
        .join(summary, "symbol", "left")
        .join(valued, "symbol", "left")
        .join(statement_latest(**statements), "symbol", "left")
        .join(with_bands(scores_wide(scores, types), [f"{t}_score" for t in types]), "symbol", "left")
        .join(charts(quotes, statements["income"], shown), "symbol", "left")
    )
    return page.withColumn("div_yield", F.try_divide(F.col("last_div"), F.col("price")) * 100)


#: What a page shows of each peer, beside its symbol.
PEER_ATTRIBUTES = [
    "name", "perf_1m", "ytd_change", "perf_1y", "perf_3y", "perf_5y", "beta", "sharpe", "altman", "piotroski", "std_dev",
    *[f"{t}_score" for t in SCORE_TYPES], "overall_score",
]


def peer_details(
    profile: DataFrame, quotes: DataFrame, scores: DataFrame, risk: DataFrame, financial_scores: DataFrame, composite: str = "composite"
) -> DataFrame:
    """(symbol, PEER_ATTRIBUTES): returns, risk and scores of every company of the profile.

    ``risk`` has beta, sharpe and std_dev per symbol, ``financial_scores`` altman and piotroski.
    """
    returns = price_summary(quotes).select("symbol", "perf_1m", "ytd_change", "perf_1y", "perf_3y", "perf_5y")
    wide = scores_wide(scores, [*SCORE_TYPES, composite]).withColumnRenamed(f"{composite}_score", "overall_score")
    details = profile.select("symbol", F.col("company_name").alias("name"))
    for frame in (returns, risk.select("symbol", "beta", "sharpe", "std_dev"), financial_scores.select("symbol", "altman", "piotroski"), wide):
        details = details.join(frame, "symbol", "left")
    return details.select("symbol", *PEER_ATTRIBUTES)


def peer_pivot(peers: DataFrame, ranking: DataFrame, details: DataFrame, attributes: list[str], n: int = 6) -> DataFrame:
    """The ``n`` best peers of each symbol as columns ``p1_* .. pn_*``.

    ``ranking`` gives (symbol, score); ``details`` one row per symbol with the attributes.
    """
    # described before the choice, so the edges are joined once
    described = ranking.select("symbol", "score").join(details.select("symbol", *attributes), "symbol", "left")
    scored = join_unique(materialise(peers, "edges"), described.withColumnRenamed("symbol", "peer_symbol"), ["peer_symbol"], "symbol")
    best = top_k(scored, ["symbol"], [F.col("score").desc(), F.col("peer_symbol")], n)
    shown = F.struct(F.col("peer_symbol").alias("symbol"), *attributes)
    wide = best.groupBy("symbol").pivot("rank", list(range(1, n + 1))).agg(F.first(shown))
    return wide.select(
        "symbol", *[F.col(f"`{i}`.{a}").alias(f"p{i}_{a}") for i in range(1, n + 1) for a in ("symbol", *attributes)]
    )


def market_page_pivot(pages: DataFrame) -> DataFrame:
    """Per parent its ten gainers and ten losers as columns ``gainer1_* .. loser10_*``."""
    movers = pages.filter("category <> 'Main'").withColumn("_slot", F.concat(F.lower("category"), F.col("rank").cast("string")))
    wide = movers.groupBy("parent_symbol").pivot("_slot", SLOTS).agg(F.first(F.struct(*ATTRIBUTES)))
    return wide.select("parent_symbol", *[F.col(f"{s}.{a}").alias(f"{s}_{a}") for s in SLOTS for a in ATTRIBUTES])


def horizon_comparison(summary: DataFrame, profile: DataFrame, category: str, bench: DataFrame) -> DataFrame:
    """Per symbol and horizon (columns ``*_1y`` .. ``*_inception``) the fund's return, its category's mean, the index's return over the same dates, quartile and percentile.

    Horizons are rows until the end, so one pass ranks all of them, by (horizon, category).
    """
    entries = [F.struct(F.lit(h).alias("horizon"), F.col(f"start_{h}").alias("start"), F.col(f"perf_{h}").alias("perf")) for h in HORIZONS]
    long = summary.select("symbol", F.col("date").alias("end"), F.inline(F.array(*entries))).filter("perf IS NOT NULL")
    series = bench.select("date", "close")
    for day in ("start", "end"):
        long = asof_backward(long.withColumnRenamed(day, "date"), series, "close", f"_{day}").withColumnRenamed("date", day)
    long = long.withColumn("index", percent_change(F.col("_end"), F.col("_start"))).select("symbol", "horizon", "perf", "index")
    group = ["horizon", category]
    averaged = category_average(long.join(profile.select("symbol", category), "symbol"), group, "perf")
    ranked = quartile_percentile(averaged, group, "perf", "symbol")
    shown = ["perf", "perf_category", "index", "quartile", "percentile"]
    return ranked.groupBy("symbol").agg(*[F.max(F.when(F.col("horizon") == h, F.col(c))).alias(f"{c}_{h}") for h in HORIZONS for c in shown])


def fund_page(
    profile: DataFrame, category: str, quotes: DataFrame, bench: DataFrame, captures: DataFrame, risk: DataFrame, scores: DataFrame, holdings: DataFrame,
    fund: str = "etf_symbol", volume: str | None = "volume",
) -> DataFrame:
    """Profile, price, horizons against category and index, drawdowns, captures against the category, risk, scores with texts, top holdings and exposures.

    ``captures`` has batting average and captures per horizon, ``risk`` beta, alpha and std_dev, ``scores`` the fund scores (symbol, date, performance, risk,
    management, total_score).
    """
    newest = newest_dates(quotes)
    summary = materialise(price_summary(quotes, newest=newest, years=YEARS, volume=volume), "fund-prices")
    priced = summary.drop(*[c for c in summary.columns if c.startswith(("perf_", "start_"))], "date")
    inception = summary.select("symbol", F.col("start_inception").alias("inception_date"))
    sides = [f"{side}_{y}y" for side in ("upside", "downside") for y in YEARS]
    captured = category_average(captures.join(profile.select("symbol", category), "symbol"), category, sides).drop(category)
    areas = ["performance", "risk", "management", "total_score"]
    scored = last_per_key(scores, ["symbol"], "date", areas).select(
        "symbol", *[F.col(a).cast("double").alias(a if a == "total_score" else f"{a}_score") for a in areas])
    order = [F.col("market_value").desc(), F.col("asset"), F.col("country")]
    top = (
        top_k(holdings, [fund], order, 10)
        .groupBy(F.col(fund).alias("symbol"))
        .agg(F.sort_array(F.collect_list(F.struct("rank", "asset", "market_value"))).alias("top_holdings"))
    )
    # holdings are summed per (fund, country, sector) once; both exposures come from that
    held = materialise(holdings.groupBy(fund, "country", "sector").agg(F.sum("market_value").alias("market_value"), F.count("*").alias("n")), "fund-exposure")
    counted = held.groupBy(F.col(fund).alias("symbol")).agg(F.sum("n").alias("total_holdings"))

    def exposure(dimension: str) -> DataFrame:
        # one entry per country or sector
        entries = F.sort_array(F.collect_list(F.struct(dimension, "weight_percentage")))
        parts = exposure_by_dimension(held, fund, dimension, "market_value")
        return parts.groupBy(F.col(fund).alias("symbol")).agg(entries.alias(f"{dimension}_exposure"))

    frames = [
        priced, inception, horizon_comparison(summary, profile, category, bench), max_drawdown(quotes, years=YEARS, newest=newest), captured,
        risk.select("symbol", "beta", "alpha", "std_dev"), with_bands(scored, [c for c in scored.columns if c != "symbol"]), top, counted,
        exposure("country"), exposure("sector"),
    ]
    page = profile.drop("price", "inception_date", "total_holdings")
    for frame in frames:
        page = page.join(frame, "symbol", "left")
    return page
