"""Market reports, fund risk and page views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerlake.operators import calendar as cal
from tickerlake.plans import market, pages, risk
from tickerlake.registry.core import query
from tickerlake.registry.relational import CONSTITUENTS, PARENTS_SQL, SECTOR_PARENTS, constituents
from tickerlake.registry.timeseries import LATEST, PERFORMANCE, WEEKLY, month_end_list, trend
from tickerlake.session import materialise
from tickerlake.sources import views as v

CHANGES_OUT = "price:6 day_change:6 week_change:6 quarter_change:6 ytd_change:6 trend"
WITH_TREND = f"SELECT p.*, t.trend FROM ({PERFORMANCE}) p JOIN ({trend('weekly')}) t ON p.symbol = t.symbol"


@query("index_performance", f"symbol {CHANGES_OUT}", "quotes profile",
       f"SELECT * FROM ({WITH_TREND}) WHERE symbol IN (SELECT symbol FROM profile)", f"{LATEST}, {WEEKLY}")
def _(spark, sf):
    return market.index_performance(v.quotes(spark, sf), v.profile(spark, sf))


@query("sector_top_holdings", f"sector rank:i symbol company_name {CHANGES_OUT}", "quotes profile",
       f"""SELECT sector, rank, t.symbol, company_name, p.price, day_change, week_change, quarter_change, ytd_change, d.trend FROM
       (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY mkt_cap DESC, symbol) AS rank FROM profile WHERE mkt_cap > 0
       QUALIFY rank <= 10) t LEFT JOIN ({PERFORMANCE}) p ON t.symbol = p.symbol
       LEFT JOIN ({trend('quotes')}) d ON t.symbol = d.symbol""", LATEST)
def _(spark, sf):
    return market.sector_top_holdings(v.profile(spark, sf), v.quotes(spark, sf))


def _text(df, *columns):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _pages(spark, sf):
    """Pages over text symbols; a parent's own prices are the highest close among its members."""
    members = constituents(spark, sf)
    # in use a stored table
    quotes = materialise(v.quotes(spark, sf), "quotes")
    parents = members.join(quotes, "symbol").groupBy(F.col("parent_symbol").alias("symbol"), "date").agg(
        F.max("adj_close").alias("adj_close"))
    return market.market_pages(
        _text(quotes, "symbol"), parents, _text(v.profile(spark, sf), "symbol"), _text(members, "symbol"), SECTOR_PARENTS)


# the parents' own series goes through the same SQL under the name quotes
PARENT_QUOTES = """parent_quotes AS (SELECT parent_symbol AS symbol, date, max(adj_close) AS adj_close FROM constituents
    JOIN quotes USING (symbol) GROUP BY 1, 2)"""
P_LATEST = LATEST.replace("latest AS", "p_latest AS").replace("quotes", "parent_quotes")
P_WEEKLY = WEEKLY.replace("weekly AS", "p_weekly AS").replace("FROM quotes", "FROM parent_quotes")
P_TREND = WITH_TREND.replace("FROM quotes JOIN latest", "FROM parent_quotes JOIN p_latest").replace("FROM weekly", "FROM p_weekly")
PAGE_ROWS = f"""page_rows AS (
    WITH m AS (SELECT * FROM constituents JOIN ({WITH_TREND}) USING (symbol)),
    movers AS (SELECT *, 'Gainer' AS category, row_number() OVER (PARTITION BY parent_symbol ORDER BY day_change DESC, symbol_text) AS rank
        FROM (SELECT *, CAST(symbol AS VARCHAR) AS symbol_text FROM m) QUALIFY rank <= 10
        UNION ALL SELECT *, 'Loser', row_number() OVER (PARTITION BY parent_symbol ORDER BY day_change, symbol_text DESC) AS rank
        FROM (SELECT *, CAST(symbol AS VARCHAR) AS symbol_text FROM m) QUALIFY rank <= 10)
    SELECT parent_symbol, symbol_text AS symbol, 'Stock' AS type, category, rank, sector, industry, company_name AS name, price,
        day_change, week_change, quarter_change, ytd_change, trend FROM movers JOIN profile USING (symbol)
    UNION ALL SELECT symbol, symbol, CASE WHEN symbol IN (SELECT parent_symbol FROM parents) THEN 'Sector' ELSE 'Index' END, 'Main',
        NULL, NULL, NULL, NULL, price, day_change, week_change, quarter_change, ytd_change, trend FROM ({P_TREND}))"""
PAGE_CTES = f"{LATEST}, {WEEKLY}, {PARENTS_SQL}, {CONSTITUENTS}, {PARENT_QUOTES}, {P_LATEST}, {P_WEEKLY}, {PAGE_ROWS}"


@query("market_pages", f"parent_symbol symbol type category rank:i sector industry name {CHANGES_OUT}", "quotes profile",
       "SELECT * FROM page_rows", PAGE_CTES)
def _(spark, sf):
    return _pages(spark, sf)


SLOTS = [(c, r) for c in ("gainer", "loser") for r in range(1, 11)]


@query("market_page_pivot", "parent_symbol " + " ".join(f"{c}{r}_symbol {c}{r}_price:6 {c}{r}_trend" for c, r in SLOTS),
       "quotes profile", "SELECT parent_symbol, " + ", ".join(
           f"max({a}) FILTER (category = '{c.capitalize()}' AND rank = {r}) AS {c}{r}_{a}"
           for c, r in SLOTS for a in ("symbol", "price", "trend"))
       + " FROM page_rows GROUP BY 1", PAGE_CTES)
def _(spark, sf):
    return pages.market_page_pivot(_pages(spark, sf))


# ---- fund risk

MIN_5Y, MIN_3Y, MIN_MONTHS = 100, 50, 12
RISK_DATES = """month_ends AS (SELECT last_day(CAST(m AS DATE)) AS cutoff FROM (SELECT max(date) AS d FROM quotes),
    generate_series(date_trunc('month', d - INTERVAL 14 MONTH), CAST(d AS TIMESTAMP), INTERVAL 1 MONTH) AS s(m)
    WHERE last_day(CAST(m AS DATE)) <= d ORDER BY m DESC LIMIT 12)"""
MONTHLY = """bench_m AS (SELECT month, close / lag(close) OVER (ORDER BY month) - 1 AS market FROM
        (SELECT s.month, b.close FROM (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(date)),
        date_trunc('month', max(date)), INTERVAL 1 MONTH)) AS DATE)) AS month FROM bench) s ASOF JOIN bench b ON s.month >= b.date)),
    fund_spine AS (SELECT symbol, cutoff, last_day(CAST(unnest(generate_series(date_trunc('month', min(date)),
        date_trunc('month', max(date)), INTERVAL 1 MONTH)) AS DATE)) AS month FROM quotes, {dates} WHERE date <= cutoff GROUP BY 1, 2),
    fund_m AS (SELECT symbol, cutoff, month, adj_close / lag(adj_close) OVER (PARTITION BY symbol, cutoff ORDER BY month) - 1 AS fund
        FROM (SELECT s.*, adj_close FROM fund_spine s ASOF JOIN quotes q ON s.symbol = q.symbol AND s.month >= q.date)),
    pairs AS (SELECT symbol, cutoff, month, fund, market, row_number() OVER (PARTITION BY symbol, cutoff ORDER BY month DESC) AS n
        FROM fund_m JOIN bench_m USING (month) WHERE fund IS NOT NULL AND market IS NOT NULL)"""


def captures(inside: str = "true", suffix: str = "") -> str:
    def ratio(side: str) -> str:
        f = f"FILTER ({inside} AND market {side} 0)"
        return f"coalesce(avg(fund) {f} / avg(market) {f} * 100, 50)"

    return f"""count(*) FILTER ({inside}) AS months{suffix}, avg((fund > market)::INT) FILTER ({inside}) * 100 AS batting_avg{suffix},
    {ratio('>')} AS upside{suffix}, {ratio('<')} AS downside{suffix}"""


METRICS_AT = f"""{RISK_DATES},
    five AS (SELECT symbol, cutoff, count(*) AS n, power(arg_max(adj_close, date) / arg_min(adj_close, date),
        365.0 / (max(date) - min(date))) - 1 AS return_5y FROM quotes, month_ends
        WHERE date BETWEEN cutoff - 1826 AND cutoff GROUP BY 1, 2 HAVING count(*) >= {MIN_5Y}),
    slice AS (SELECT symbol, cutoff, date, adj_close, adj_close / lag(adj_close) OVER (PARTITION BY symbol, cutoff ORDER BY date) - 1 AS ret
        FROM quotes, month_ends WHERE date BETWEEN cutoff - 1096 AND cutoff),
    three AS (SELECT symbol, cutoff, power(arg_max(adj_close, date) / arg_min(adj_close, date), 365.0 / (max(date) - min(date))) - 1
        AS return_3y FROM slice GROUP BY 1, 2 HAVING count(*) >= {MIN_3Y}),
    bench_d AS (SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS bench_ret FROM bench),
    bench_rf AS (SELECT b.date, bench_ret, month3 / 100 / 252 AS rf FROM bench_d b ASOF LEFT JOIN treasury t ON b.date >= t.date
        WHERE bench_ret IS NOT NULL),
    daily AS (SELECT symbol, cutoff, avg(ret) AS my, avg(bench_ret) AS mx, avg(rf) AS mrf, stddev_samp(ret) AS sd,
        regr_slope(ret, bench_ret) AS beta FROM slice JOIN bench_rf USING (date) WHERE ret IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2),
    {MONTHLY.format(dates='month_ends')},
    monthly AS (SELECT symbol, cutoff, {captures()} FROM pairs WHERE n <= 36 GROUP BY 1, 2 HAVING count(*) >= {MIN_MONTHS}),
    metrics AS (SELECT five.symbol, five.cutoff, return_5y, return_3y, batting_avg, sd * sqrt(252) AS std_dev, beta,
        CASE WHEN sd > 0 THEN (my - mrf) / sd * sqrt(252) ELSE 0 END AS sharpe, ((my - mrf) - beta * (mx - mrf)) * 252 AS alpha,
        expense_ratio AS mer, upside, downside, expense_ratio AS ter
        FROM five JOIN three USING (symbol, cutoff) JOIN daily USING (symbol, cutoff) JOIN monthly USING (symbol, cutoff)
        LEFT JOIN etf_profile e ON five.symbol = e.symbol)"""
RISK_VIEWS = "quotes bench treasury etf_profile"
METRICS_OUT = "symbol cutoff:d " + " ".join(f"{m}:6" for m in risk.METRICS)


def _risk_inputs(spark, sf):
    # the quotes are read for the daily and for the monthly figures; in use they are a stored table
    return (
        materialise(v.quotes(spark, sf), "quotes"), v.benchmark_close(spark, sf), v.treasury(spark, sf), v.etf_profile(spark, sf))


def _metrics(spark, sf):
    dates = month_end_list(spark, sf, cal.month_ends_up_to)
    return risk.etf_metrics(*_risk_inputs(spark, sf), dates, MIN_5Y, MIN_3Y, MIN_MONTHS)


@query("etf_metrics", METRICS_OUT, RISK_VIEWS, "SELECT * FROM metrics", METRICS_AT)
def _(spark, sf):
    return _metrics(spark, sf)


# the benchmark's changes between the fund's own return days
FUND_DAYS = METRICS_AT.replace(
    "FROM slice JOIN bench_rf USING (date) WHERE ret IS NOT NULL GROUP BY 1, 2",
    """FROM (SELECT s.symbol, s.cutoff, s.date, ret, rf, b.close / lag(b.close) OVER (PARTITION BY s.symbol, s.cutoff ORDER BY s.date) - 1
        AS bench_ret FROM slice s JOIN bench b USING (date) ASOF LEFT JOIN (SELECT date AS rate_date, month3 / 100 / 252 AS rf FROM treasury)
        t ON s.date >= t.rate_date WHERE ret IS NOT NULL) WHERE bench_ret IS NOT NULL GROUP BY 1, 2""")


@query("etf_metrics_fund_days", METRICS_OUT, RISK_VIEWS, "SELECT * FROM metrics", FUND_DAYS)
def _(spark, sf):
    dates = month_end_list(spark, sf, cal.month_ends_up_to)
    return risk.etf_metrics(*_risk_inputs(spark, sf), dates, MIN_5Y, MIN_3Y, MIN_MONTHS, fund_days=True)


def _points(c: str) -> str:
    position = f"({c} - min({c}) OVER g) / (max({c}) OVER g - min({c}) OVER g)"
    directed = f"1 - {position}" if c in risk.LOWER_BETTER else position
    return f"""CASE WHEN count({c}) OVER g < 2 OR min({c}) OVER g = max({c}) OVER g THEN 0.5 ELSE coalesce({directed}, 0.5) END
    * {float(risk.WEIGHTS[c])}::DOUBLE AS {c}"""


def _area(c: str) -> str:
    return f"""CASE WHEN max({c}) OVER g > min({c}) OVER g THEN ({c} - min({c}) OVER g) / (max({c}) OVER g - min({c}) OVER g) * 100
    ELSE 50 END AS {c}"""


AREA_SUMS = ", ".join(f"({' + '.join(cs)}) / {top} * 100 AS {a}" for a, (cs, top) in risk.AREAS.items())
AREA_NAMES = [*risk.AREAS, "total_score"]
GROUP_SCORES = f"""{METRICS_AT}, fund_groups AS (SELECT DISTINCT symbol AS ref, peer_symbol AS symbol FROM peers UNION SELECT symbol, symbol FROM profile),
    points AS (SELECT ref, g.symbol, cutoff, {', '.join(_points(c) for c in risk.METRICS)} FROM fund_groups g JOIN metrics USING (symbol)
        WINDOW g AS (PARTITION BY ref, cutoff)),
    areas AS (SELECT ref, symbol, cutoff, {AREA_SUMS}, {' + '.join(risk.METRICS)} AS total_score FROM points),
    scaled AS (SELECT ref, symbol, cutoff AS date, {', '.join(_area(c) for c in AREA_NAMES)} FROM areas WINDOW g AS (PARTITION BY ref, cutoff)),
    group_scores AS (SELECT symbol, date, performance, risk, management, total_score FROM scaled WHERE ref = symbol)"""
SCORES_OUT = "symbol date:d performance:6 risk:6 management:6 total_score:6"


@query("etf_group_scores", SCORES_OUT, f"{RISK_VIEWS} profile peers", "SELECT * FROM group_scores", GROUP_SCORES)
def _(spark, sf):
    return risk.etf_group_scores(_metrics(spark, sf), v.peers(spark, sf), v.profile(spark, sf))


STORED = """stored AS (SELECT symbol, last_day(date) AS date, 1.0 AS performance, 1.0 AS risk, 1.0 AS management, 1.0 AS total_score
    FROM quotes GROUP BY 1, 2)"""


@query("etf_scores_history", SCORES_OUT, f"{RISK_VIEWS} profile peers",
       """SELECT * FROM group_scores UNION ALL SELECT * FROM stored WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM group_scores)""",
       f"{GROUP_SCORES}, {STORED}")
def _(spark, sf):
    one = F.lit(1.0)
    stored = v.quotes(spark, sf).select("symbol", F.last_day("date").alias("date")).distinct().select(
        "symbol", "date", *[one.alias(c) for c in AREA_NAMES])
    return risk.etf_scores_history(
        stored, *_risk_inputs(spark, sf), v.peers(spark, sf), v.profile(spark, sf),
        month_end_list(spark, sf, cal.month_ends_up_to), min_rows_5y=MIN_5Y, min_rows_3y=MIN_3Y, min_months=MIN_MONTHS)


HORIZONS = (1, 3, 5, 10)


@query("capture_by_horizon", "symbol " + " ".join(
           f"months_{y}y:i batting_avg_{y}y:6 upside_{y}y:6 downside_{y}y:6" for y in HORIZONS), "quotes bench",
       "SELECT symbol, " + ", ".join(captures(f"n <= {12 * y}", f"_{y}y") for y in HORIZONS) + " FROM pairs WHERE n <= 120 GROUP BY 1",
       "newest AS (SELECT max(date) AS cutoff FROM quotes), " + MONTHLY.format(dates="newest"))
def _(spark, sf):
    return risk.capture_by_horizon(risk.monthly_pairs(v.quotes(spark, sf), v.benchmark_close(spark, sf)))
