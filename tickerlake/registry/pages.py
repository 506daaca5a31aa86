"""Page views: one wide row per company or fund."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerlake.functions.measures import score_band
from tickerlake.operators import calendar as cal
from tickerlake.operators.timeseries import price_summary
from tickerlake.plans import pages, risk
from tickerlake.registry.core import query
from tickerlake.registry.reports import MONTHLY, RISK_DATES, captures
from tickerlake.registry.scoring import UNIVERSE, UNIVERSE_VIEWS, _universe
from tickerlake.registry.timeseries import LATEST, change, month_end_list
from tickerlake.session import materialise
from tickerlake.sources import views as v

YEARS = pages.YEARS
BAND = "CASE WHEN {c} < 20 THEN 'Very weak' WHEN {c} < 40 THEN 'Weak' WHEN {c} < 60 THEN 'Average' WHEN {c} < 80 THEN 'Strong' WHEN {c} IS NOT NULL THEN 'Very strong' END"
STARTS = {"1m": "latest - INTERVAL 1 MONTH", **{f"{y}y": f"latest - INTERVAL {y} YEAR" for y in YEARS}}


def _base(target: str, name: str) -> str:
    return f"arg_max(adj_close, date) FILTER (date <= {target}) AS {name}"


_RETURNS = {**{f"perf_{h}": f"b_{h}" for h in STARTS}, "perf_inception": "b_inception"}
SUMMARY = f"""summary AS (SELECT symbol, latest, price, volume, low_52_week, high_52_week, start_inception,
    {', '.join(change(n, b) for n, b in (('day_change', 'd'), ('week_change', 'w'), ('quarter_change', 'q'), ('ytd_change', 'y')))},
    {', '.join(f'(price - {b}) / nullif({b}, 0) * 100 AS {n}' for n, b in _RETURNS.items())},
    {', '.join(f'CAST({start} AS DATE) AS start_{h}' for h, start in STARTS.items())}
    FROM (SELECT symbol, max(latest) AS latest, arg_max(adj_close, date) AS price, arg_max(volume, date) AS volume,
        {_base('latest - 1', 'd')}, {_base('latest - 7', 'w')}, {_base('latest - 90', 'q')},
        arg_min(adj_close, date) FILTER (year(date) = year(latest)) AS y, {', '.join(_base(s, f'b_{h}') for h, s in STARTS.items())},
        arg_min(adj_close, date) AS b_inception, min(date) AS start_inception, min(adj_close) FILTER (date > latest - 365) AS low_52_week,
        max(adj_close) FILTER (date > latest - 365) AS high_52_week FROM quotes JOIN latest USING (symbol) GROUP BY symbol))"""
SUMMARY_OUT = [c for c in ("price", "volume", "day_change", "week_change", "quarter_change", "ytd_change", "low_52_week", "high_52_week")]


@query("price_summary", "symbol date:d volume:i start_inception:d " + " ".join(f"{c}:6" for c in SUMMARY_OUT if c != "volume") + " "
       + " ".join(f"{c}:6" for c in _RETURNS), "quotes", "SELECT *, latest AS date FROM summary", f"{LATEST}, {SUMMARY}")
def _(spark, sf):
    return price_summary(v.quotes(spark, sf), volume="volume")


# ---- companies


def _newest(view: str, columns: list[str]) -> str:
    picked = ", ".join(f"{c} AS {c}" for c in columns)
    return f"(SELECT symbol, date AS {view}_date, {picked} FROM {view} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)"


STATEMENT_VIEWS = "income balance cash_flow growth"
MEASURES = {
    "gross_margin": "gross_profit / nullif(revenue, 0) * 100", "operating_margin": "operating_income / nullif(revenue, 0) * 100",
    "net_margin": "net_income / nullif(revenue, 0) * 100", "roa": "net_income / nullif(total_assets, 0) * 100",
    "roe": "net_income / nullif(total_equity, 0) * 100", "current_ratio": "current_assets / nullif(current_liabilities, 0)",
    "debt_to_equity": "total_debt / nullif(total_equity, 0)",
}
STATEMENTS = f"""statements AS (SELECT i.*, income_date AS statement_date, {', '.join(pages.BALANCE + pages.CASH_FLOW + pages.GROWTH)},
    {', '.join(f'{m} AS {n}' for n, m in MEASURES.items())} FROM {_newest('income', pages.INCOME)} i
    LEFT JOIN {_newest('balance', pages.BALANCE)} b ON i.symbol = b.symbol LEFT JOIN {_newest('cash_flow', pages.CASH_FLOW)} c ON i.symbol = c.symbol
    LEFT JOIN {_newest('growth', pages.GROWTH)} g ON i.symbol = g.symbol)"""
STATEMENT_OUT = "statement_date:d " + " ".join(
    f"{c}:4" for c in [*pages.INCOME, *pages.BALANCE, *pages.CASH_FLOW, *pages.GROWTH, *MEASURES])


def _statements(spark, sf):
    return {"income": v.income(spark, sf), "balance": v.balance(spark, sf), "cash_flow": v.cash_flow(spark, sf), "growth": v.growth(spark, sf)}


@query("peer_statement_latest", f"symbol {STATEMENT_OUT}", STATEMENT_VIEWS, "SELECT * FROM statements", STATEMENTS)
def _(spark, sf):
    return pages.statement_latest(**_statements(spark, sf))


@query("charts", "symbol dates prices equity_dates equity_values", "quotes ratios",
       """SELECT q.*, equity_dates, equity_values FROM (SELECT symbol, string_agg(CAST(date AS VARCHAR), '|' ORDER BY date) AS dates,
       string_agg(CAST(CAST(round(adj_close * 100) AS BIGINT) AS VARCHAR), '|' ORDER BY date) AS prices FROM quotes GROUP BY 1) q
       LEFT JOIN (SELECT symbol, string_agg(CAST(date AS VARCHAR), '|' ORDER BY date) AS equity_dates,
       string_agg(CAST(CAST(round(return_on_equity * 100) AS BIGINT) AS VARCHAR), '|' ORDER BY date) AS equity_values
       FROM ratios GROUP BY 1) r ON q.symbol = r.symbol""")
def _(spark, sf):
    wide = pages.charts(v.quotes(spark, sf), v.ratios(spark, sf), {"return_on_equity": "equity_chart"})

    def joined(chart, part):
        return F.array_join(F.transform(chart, part), "|")

    def cents(x):
        return F.round(x["value"] * 100).cast("bigint").cast("string")

    def day(x):
        return x["date"].cast("string")

    return wide.select(
        "symbol", joined("price_chart", day).alias("dates"), joined("price_chart", cents).alias("prices"),
        joined("equity_chart", day).alias("equity_dates"), joined("equity_chart", cents).alias("equity_values"))


SCORES = [f"{t}_score" for t in (*pages.SCORE_TYPES, "composite")]
SCORES_WIDE = "score_page AS (SELECT symbol, " + ", ".join(
    f"arg_max(score, date) FILTER (score_type = '{c.removesuffix('_score')}') AS {c}" for c in SCORES) + " FROM scores GROUP BY 1)"


@query("equity_page", "symbol company_name sector industry mkt_cap:2 div_yield:6 pe:6 " + " ".join(f"{c}:6" for c in SUMMARY_OUT) + " perf_1m:6 perf_1y:6 "
       + STATEMENT_OUT + " " + " ".join(f"{c}:2 {c}_txt" for c in SCORES) + " price_points:i sales_points:i eps_points:i earnings_points:i",
       f"{UNIVERSE_VIEWS} {STATEMENT_VIEWS}",
       f"""SELECT p.symbol, company_name, sector, industry, mkt_cap, mkt_cap / 500 / nullif(price, 0) * 100 AS div_yield, pe,
       {', '.join(SUMMARY_OUT)}, perf_1m, perf_1y, s.* EXCLUDE (symbol), {', '.join(f'{c}, {BAND.format(c=c)} AS {c}_txt' for c in SCORES)},
       price_points, n AS sales_points, n AS eps_points, n AS earnings_points
       FROM profile p LEFT JOIN summary f ON p.symbol = f.symbol LEFT JOIN statements s ON p.symbol = s.symbol
       LEFT JOIN (SELECT symbol, arg_max(price_earnings_ratio, date) AS pe FROM ratios GROUP BY 1) r ON p.symbol = r.symbol
       LEFT JOIN score_page c ON p.symbol = c.symbol LEFT JOIN (SELECT symbol, count(*) AS price_points FROM quotes GROUP BY 1) q ON p.symbol = q.symbol
       LEFT JOIN (SELECT symbol, count(*) AS n FROM income GROUP BY 1) i ON p.symbol = i.symbol""",
       f"{UNIVERSE}, {LATEST}, {SUMMARY}, {STATEMENTS}, {SCORES_WIDE}")
def _(spark, sf):
    profile = v.profile(spark, sf).withColumn("last_div", F.col("mkt_cap") / 500)
    page = pages.equity_page(profile, _stored_quotes(spark, sf), _statements(spark, sf), v.ratios(spark, sf), _universe(spark, sf))
    points = {"price_points": "price_chart", "sales_points": "sales_chart", "eps_points": "eps_chart", "earnings_points": "earnings_chart"}
    return page.withColumns({n: F.when(F.col(c).isNotNull(), F.size(c)) for n, c in points.items()})


# risk at the newest month end
RISK_NOW = f"""{RISK_DATES}, risk_at AS (SELECT max(cutoff) AS cutoff FROM month_ends),
    slice AS (SELECT symbol, date, adj_close / lag(adj_close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS ret
        FROM quotes, risk_at WHERE date BETWEEN cutoff - 1096 AND cutoff),
    bench_rf AS (SELECT b.date, bench_ret, month3 / 100 / 252 AS rf FROM (SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS bench_ret FROM bench) b
        ASOF LEFT JOIN treasury t ON b.date >= t.date WHERE bench_ret IS NOT NULL),
    daily AS (SELECT symbol, avg(ret) AS my, avg(bench_ret) AS mx, avg(rf) AS mrf, stddev_samp(ret) AS sd, regr_slope(ret, bench_ret) AS beta
        FROM slice JOIN bench_rf USING (date) WHERE ret IS NOT NULL GROUP BY 1 HAVING count(*) >= 2),
    risk AS (SELECT symbol, sd * sqrt(252) AS std_dev, beta, CASE WHEN sd > 0 THEN (my - mrf) / sd * sqrt(252) ELSE 0 END AS sharpe,
        ((my - mrf) - beta * (mx - mrf)) * 252 AS alpha FROM daily)"""


def _stored_quotes(spark, sf):
    """The quote table, which pages read several times, is a view over the test tables; in use it is stored."""
    return materialise(v.quotes(spark, sf), "quotes")


def _risk(spark, sf, quotes, bench):
    newest = month_end_list(spark, sf, cal.month_ends_up_to)[-1]
    return risk.daily_metrics(quotes, bench, v.treasury(spark, sf), [newest]).filter("m >= 2")


PEERS = range(1, 7)
_DETAILS = {**{a: a for a in pages.PEER_ATTRIBUTES}, "name": "company_name", "overall_score": "composite_score"}


@query("peer_pivot", "symbol " + " ".join(f"p{i}_symbol " + " ".join(f"p{i}_{a}" + ("" if a == "name" else ":5") for a in pages.PEER_ATTRIBUTES) for i in PEERS),
       f"{UNIVERSE_VIEWS} bench treasury financial_scores",
       "SELECT symbol, " + ", ".join(
           f"max(peer_symbol) FILTER (n = {i}) AS p{i}_symbol, " + ", ".join(f"max({a}) FILTER (n = {i}) AS p{i}_{a}" for a in pages.PEER_ATTRIBUTES) for i in PEERS)
       + """ FROM (SELECT p.symbol, peer_symbol, d.* EXCLUDE (symbol), row_number() OVER (PARTITION BY p.symbol ORDER BY overall_score DESC NULLS LAST, peer_symbol) AS n
       FROM peers p JOIN details d ON p.peer_symbol = d.symbol) WHERE n <= 6 GROUP BY 1""",
       f"{UNIVERSE}, {LATEST}, {SUMMARY}, {SCORES_WIDE}, {RISK_NOW}, details AS (SELECT p.symbol, "
       + ", ".join(f"{source} AS {a}" for a, source in _DETAILS.items()) + """ FROM profile p LEFT JOIN summary f ON p.symbol = f.symbol
       LEFT JOIN risk r ON p.symbol = r.symbol LEFT JOIN financial_scores z ON p.symbol = z.symbol LEFT JOIN score_page c ON p.symbol = c.symbol)""")
def _(spark, sf):
    quotes = _stored_quotes(spark, sf)
    details = pages.peer_details(
        v.profile(spark, sf), quotes, _universe(spark, sf), _risk(spark, sf, quotes, v.benchmark_close(spark, sf)), v.financial_scores(spark, sf))
    ranking = details.select("symbol", F.col("overall_score").alias("score"))
    return pages.peer_pivot(v.peers(spark, sf), ranking, details, pages.PEER_ATTRIBUTES)


@query("score_text_band", "symbol date:d score_type score:2 score_txt", UNIVERSE_VIEWS,
       f"SELECT symbol, date, score_type, score, {BAND.format(c='score')} AS score_txt FROM scores", UNIVERSE)
def _(spark, sf):
    return _universe(spark, sf).withColumn("score_txt", score_band(F.col("score").cast("double")))


# ---- funds

_SHOWN = ["perf", "perf_category", "index", "quartile", "percentile"]
_SIDES = [f"{side}_{y}y" for side in ("upside", "downside") for y in YEARS]
COMPARED = "long AS (" + " UNION ALL ".join(
    f"SELECT symbol, latest, '{h}' AS horizon, start_{h} AS start, perf_{h} AS perf FROM summary WHERE perf_{h} IS NOT NULL" for h in pages.HORIZONS) + f"""),
    indexed AS (SELECT l.symbol, horizon, perf, (e.close - s.close) / nullif(s.close, 0) * 100 AS index
        FROM long l ASOF LEFT JOIN bench s ON l.start >= s.date ASOF LEFT JOIN bench e ON l.latest >= e.date),
    ranked AS (SELECT symbol, horizon, perf, index, avg(perf) OVER g AS perf_category,
        ntile(4) OVER (PARTITION BY horizon, sector ORDER BY perf DESC, symbol) AS quartile,
        percent_rank() OVER (PARTITION BY horizon, sector ORDER BY perf DESC) AS percentile FROM indexed JOIN profile USING (symbol)
        WINDOW g AS (PARTITION BY horizon, sector)),
    compared AS (SELECT symbol, {', '.join(f"max({c}) FILTER (horizon = '{h}') AS {c}_{h}" for h in pages.HORIZONS for c in _SHOWN)} FROM ranked GROUP BY 1)"""
FALLS = ", ".join(f"""fall_{y} AS (SELECT symbol, min(adj_close / peak - 1) AS max_drawdown_{y}y FROM (SELECT q.symbol, adj_close,
    max(adj_close) OVER (PARTITION BY q.symbol ORDER BY date) AS peak FROM quotes q JOIN latest l ON q.symbol = l.symbol
    WHERE date > latest - INTERVAL {y} YEAR) GROUP BY 1)""" for y in YEARS)
CAPTURED = f"""captured AS (SELECT *, {', '.join(f'avg({c}) OVER (PARTITION BY sector) AS {c}_category' for c in _SIDES)} FROM
    (SELECT symbol, {', '.join(captures(f'n <= {12 * y}', f'_{y}y') for y in YEARS)} FROM pairs WHERE n <= 120 GROUP BY 1) JOIN profile USING (symbol))"""
AREAS = {"performance_score": "performance", "risk_score": "risk", "management_score": "management", "total_score": "total_score"}
FUND_OUT = " ".join([
    "symbol company_name sector volume:i price:6 day_change:6 ytd_change:6 low_52_week:6 high_52_week:6 inception_date:d",
    *[f"{c}_{h}" + (":i" if c == "quartile" else ":6") for h in pages.HORIZONS for c in _SHOWN],
    *[f"batting_avg_{y}y:6 max_drawdown_{y}y:6" for y in YEARS], *[f"{c}:6 {c}_category:6" for c in _SIDES], "beta:6 alpha:6 std_dev:6",
    *[f"{c}:6 {c}_txt" for c in AREAS], "top_asset:i n_top:i total_holdings:i n_countries:i n_sectors:i",
])


@query("fund_page", FUND_OUT, "quotes profile bench treasury holdings fund_scores",
       f"""SELECT p.symbol, p.company_name, p.sector, f.volume, price, day_change, ytd_change, low_52_week, high_52_week, start_inception AS inception_date,
       c.* EXCLUDE (symbol), {', '.join(f'batting_avg_{y}y, max_drawdown_{y}y' for y in YEARS)}, {', '.join(f'{c}, {c}_category' for c in _SIDES)},
       beta, alpha, std_dev, {', '.join(f's.{a} AS {c}, ' + BAND.format(c=f's.{a}') + f' AS {c}_txt' for c, a in AREAS.items())},
       top_asset, least(total_holdings, 10) AS n_top, total_holdings, n_countries, n_sectors
       FROM profile p LEFT JOIN summary f ON p.symbol = f.symbol LEFT JOIN compared c ON p.symbol = c.symbol
       {' '.join(f'LEFT JOIN fall_{y} ON p.symbol = fall_{y}.symbol' for y in YEARS)} LEFT JOIN captured m ON p.symbol = m.symbol
       LEFT JOIN risk r ON p.symbol = r.symbol
       LEFT JOIN (SELECT * FROM fund_scores QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1) s ON p.symbol = s.symbol
       LEFT JOIN (SELECT etf_symbol, arg_max(asset, (market_value, -asset, country)) AS top_asset, count(*) AS total_holdings,
       count(DISTINCT country) AS n_countries, count(DISTINCT asset % 9) AS n_sectors FROM holdings GROUP BY 1) h ON p.symbol = h.etf_symbol""",
       f"{LATEST}, {SUMMARY}, {COMPARED}, {FALLS}, {RISK_NOW}, newest AS (SELECT max(date) AS cutoff FROM quotes), " + MONTHLY.format(dates="newest") + f", {CAPTURED}")
def _(spark, sf):
    quotes, bench = _stored_quotes(spark, sf), materialise(v.benchmark_close(spark, sf), "bench")
    captured = risk.capture_by_horizon(risk.monthly_pairs(quotes, bench), YEARS)
    holdings = v.holdings(spark, sf).withColumn("sector", F.col("asset") % 9)
    scores = v.fund_scores(spark, sf)
    page = pages.fund_page(v.profile(spark, sf), "sector", quotes, bench, captured, _risk(spark, sf, quotes, bench), scores, holdings)
    sizes = {"n_top": "top_holdings", "n_countries": "country_exposure", "n_sectors": "sector_exposure"}
    return page.withColumns({n: F.when(F.col(c).isNotNull(), F.size(c)) for n, c in sizes.items()}).withColumn("top_asset", F.col("top_holdings")[0]["asset"])
