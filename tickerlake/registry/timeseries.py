"""Time-series queries: horizons, weekly closes, averages, calendars, as-of lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerlake.operators import asof, calendar as cal, ranking, timeseries as ts
from tickerlake.registry.core import query
from tickerlake.sources import views as v

LATEST = "latest AS (SELECT symbol, max(date) AS latest FROM quotes GROUP BY 1)"


def _horizon(days: int, name: str) -> str:
    return f"arg_max(adj_close, date) FILTER (date <= latest - INTERVAL {days} DAY) AS {name}"


HORIZONS = f"""SELECT symbol, max(date) AS date, arg_max(adj_close, date) AS price, {_horizon(1, 'd')}, {_horizon(7, 'w')},
    {_horizon(90, 'q')}, arg_min(adj_close, date) FILTER (year(date) = year(latest)) AS y
    FROM quotes JOIN latest USING (symbol) GROUP BY symbol"""


def change(name: str, base: str) -> str:
    return f"coalesce((price - {base}) / nullif({base}, 0) * 100, 0) AS {name}"


PERFORMANCE = f"""SELECT symbol, date, price, {change('day_change', 'd')}, {change('week_change', 'w')},
    {change('quarter_change', 'q')}, {change('ytd_change', 'y')} FROM ({HORIZONS})"""

WEEKLY = """weekly AS (SELECT symbol, date, adj_close FROM (SELECT *, row_number() OVER
    (PARTITION BY symbol, date_trunc('week', date) ORDER BY date DESC) AS rn FROM quotes) WHERE rn = 1)"""


def averages(source: str) -> str:
    return f"""SELECT symbol, date, adj_close,
    avg(adj_close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS sma10,
    avg(adj_close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS sma30
    FROM {source}"""


LABEL = """CASE WHEN sma10 IS NULL OR sma30 IS NULL THEN 'Insufficient data'
    WHEN adj_close > sma30 AND sma10 > sma30 THEN 'Uptrend'
    WHEN (adj_close > sma30 AND sma10 < sma30) OR (adj_close < sma30 AND sma10 > sma30) THEN 'HOLD'
    ELSE 'Downtrend' END AS trend"""


def trend(source: str) -> str:
    return f"""SELECT symbol, adj_close AS price, sma10, sma30, {LABEL}
    FROM ({averages(source)}) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1"""


@query("price_performance", "symbol date:d price:6 day_change:6 week_change:6 quarter_change:6 ytd_change:6",
       "quotes", PERFORMANCE, LATEST)
def _(spark, sf):
    return ts.price_performance(v.quotes(spark, sf))


@query("left_join_horizons", "symbol price:6 day_change:6 week_change:6 quarter_change:6 ytd_change:6",
       "quotes", """SELECT l.symbol, l.adj_close AS price,
       (SELECT arg_max(adj_close, date) FROM quotes q WHERE q.symbol = l.symbol AND q.date <= l.date - 1) AS day_change,
       (SELECT arg_max(adj_close, date) FROM quotes q WHERE q.symbol = l.symbol AND q.date <= l.date - 7) AS week_change,
       (SELECT arg_max(adj_close, date) FROM quotes q WHERE q.symbol = l.symbol AND q.date <= l.date - 90) AS quarter_change,
       (SELECT arg_min(adj_close, date) FROM quotes q WHERE q.symbol = l.symbol AND year(q.date) = year(l.date)) AS ytd_change
       FROM quotes l JOIN latest ON l.symbol = latest.symbol AND l.date = latest.latest""", LATEST)
def _(spark, sf):
    return ts.horizon_prices(v.quotes(spark, sf), "adj_close")


@query("last_per_key", "symbol date:d adj_close:6 volume:i", "quotes",
       "SELECT * FROM quotes QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1")
def _(spark, sf):
    return ts.last_per_key(v.quotes(spark, sf), ["symbol"], "date", ["adj_close", "volume"])


@query("last_before_offset", "symbol date:d adj_close:6", "quotes",
       """SELECT q.symbol, q.date, adj_close FROM quotes q JOIN latest l ON q.symbol = l.symbol
       WHERE date <= latest - INTERVAL 90 DAY QUALIFY row_number() OVER (PARTITION BY q.symbol ORDER BY date DESC) = 1""", LATEST)
def _(spark, sf):
    return ts.last_before_offset(v.quotes(spark, sf), "adj_close", 90)


@query("first_in_year", "symbol date:d adj_close:6", "quotes",
       """SELECT q.symbol, q.date, adj_close FROM quotes q JOIN latest l ON q.symbol = l.symbol
       WHERE year(date) = year(latest) QUALIFY row_number() OVER (PARTITION BY q.symbol ORDER BY date) = 1""", LATEST)
def _(spark, sf):
    return ts.first_in_year(v.quotes(spark, sf), "adj_close")


@query("weekly_close", "symbol date:d adj_close:6", "quotes", "SELECT * FROM weekly", WEEKLY)
def _(spark, sf):
    return ts.weekly_close(v.quotes(spark, sf))


@query("rolling_sma", "symbol date:d sma10:6 sma30:6", "quotes", averages("quotes"))
def _(spark, sf):
    return ts.rolling_sma(v.quotes(spark, sf))


@query("trend_label", "symbol price:6 sma10:6 sma30:6 trend", "quotes", trend("weekly"), WEEKLY)
def _(spark, sf):
    return ts.latest_trend(v.quotes(spark, sf), basis="weekly")


@query("trend_label_daily", "symbol price:6 sma10:6 sma30:6 trend", "quotes", trend("quotes"))
def _(spark, sf):
    return ts.latest_trend(v.quotes(spark, sf), basis="daily")


AS_OF = "as_of AS (SELECT max(date) AS d FROM quotes)"
ENDS = "generate_series(0, 11) AS g(i)"


def _spine(spark, sf, build):
    newest = v.quotes(spark, sf).agg(F.max("date").alias("_d"))
    return newest.select(F.explode(build(F.col("_d"))).alias("c"))


@query("historical_month_ends", "cutoff:d", "quotes",
       f"SELECT CASE WHEN i = 0 THEN d ELSE last_day(d - to_months(CAST(i AS INTEGER))) END AS cutoff FROM as_of, {ENDS}", AS_OF)
def _(spark, sf):
    return _spine(spark, sf, cal.historical_month_ends).withColumnRenamed("c", "cutoff")


@query("month_ends_clipped", "month_end:d cutoff:d", "quotes",
       f"""SELECT last_day(d - to_months(CAST(i AS INTEGER))) AS month_end,
       least(last_day(d - to_months(CAST(i AS INTEGER))), d) AS cutoff FROM as_of, {ENDS}""", AS_OF)
def _(spark, sf):
    return _spine(spark, sf, cal.month_ends_clipped).select("c.month_end", "c.cutoff")


@query("cutoff_then_month_ends", "cutoff:d", "quotes",
       f"""SELECT CASE WHEN i = 0 THEN d ELSE CAST(date_trunc('month', d) AS DATE) - to_months(CAST(i - 1 AS INTEGER))
       - INTERVAL 1 DAY END::DATE AS cutoff FROM as_of, {ENDS}""", AS_OF)
def _(spark, sf):
    return _spine(spark, sf, cal.historical_month_ends).withColumnRenamed("c", "cutoff")


@query("date_range_month_end", "cutoff:d", "quotes",
       """SELECT last_day(CAST(m AS DATE)) AS cutoff FROM as_of,
       generate_series(date_trunc('month', d - INTERVAL 14 MONTH), CAST(d AS TIMESTAMP), INTERVAL 1 MONTH) AS s(m)
       WHERE last_day(CAST(m AS DATE)) <= d ORDER BY m DESC LIMIT 12""", AS_OF)
def _(spark, sf):
    return _spine(spark, sf, cal.month_ends_up_to).withColumnRenamed("c", "cutoff")


CUTOFFS = """cutoffs AS (SELECT CAST(CASE WHEN i = 0 THEN d ELSE last_day(d - to_months(CAST(i AS INTEGER))) END AS DATE) AS cutoff
    FROM as_of, generate_series(0, 11) AS g(i))"""


def _base(target: str, name: str, op: str = "<=") -> str:
    return f"arg_max(adj_close, date) FILTER (date {op} {target}) AS {name}"


DAY_BASES = ", ".join([
    _base("cutoff", "cur"), _base("cutoff - 30", "b1m"), _base("date_trunc('year', cutoff)", "bytd"),
    _base("cutoff - 365", "b1y"), _base("cutoff - 1095", "b3y"), _base("cutoff - 1825", "b5y")])
MONTH_BASES = ", ".join([
    _base("cutoff", "cur"), _base("cutoff - INTERVAL 1 MONTH", "b1m"), _base("date_trunc('year', cutoff)", "bytd", "<"),
    _base("cutoff - INTERVAL 1 YEAR", "b1y"), _base("cutoff - INTERVAL 3 YEAR", "b3y"), _base("cutoff - INTERVAL 5 YEAR", "b5y")])


def returns_sql(bases: str) -> str:
    def ret(b: str) -> str:
        return f"(nullif(cur, 0) - {b}) / nullif({b}, 0) * 100"

    return f"""SELECT symbol, cutoff, cur AS current_price, {ret('b1m')} AS return_1m, {ret('bytd')} AS return_ytd,
    {ret('b1y')} AS return_1y, {ret('b3y')} AS return_3y, {ret('b5y')} AS return_5y
    FROM (SELECT symbol, cutoff, {bases} FROM quotes, cutoffs WHERE date <= cutoff GROUP BY 1, 2)"""


RETURNS_OUT = "symbol cutoff:d current_price:6 return_1m:6 return_ytd:6 return_1y:6 return_3y:6 return_5y:6"


def month_end_list(spark, sf, build=cal.historical_month_ends):
    """Cut-offs for the newest ship date, read from one column of the base table."""
    day = v.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return cal.dates_of(day, build)


@query("period_returns_days", RETURNS_OUT, "quotes", returns_sql(DAY_BASES), f"{AS_OF}, {CUTOFFS}")
def _(spark, sf):
    return asof.period_returns(v.quotes(spark, sf), "adj_close", {c: cal.day_horizons(c) for c in month_end_list(spark, sf)})


@query("period_returns_days_strict", RETURNS_OUT, "quotes",
       returns_sql(DAY_BASES.replace("date <= date_trunc", "date < date_trunc")), f"{AS_OF}, {CUTOFFS}")
def _(spark, sf):
    bases = {c: cal.day_horizons(c, ytd_mode="lt") for c in month_end_list(spark, sf)}
    return asof.period_returns(v.quotes(spark, sf), "adj_close", bases)


@query("period_returns_calendar", RETURNS_OUT, "quotes", returns_sql(MONTH_BASES), f"{AS_OF}, {CUTOFFS}")
def _(spark, sf):
    return asof.period_returns(
        v.quotes(spark, sf), "adj_close", {c: cal.calendar_horizons(c) for c in month_end_list(spark, sf)}
    )


@query("asof_price_lookup", "symbol cutoff:d current_price:6 return_1m:6 return_ytd:6 return_1y:6 return_3y:6 return_5y:6",
       "quotes", f"""SELECT symbol, cutoff, cur AS current_price, b1m AS return_1m, bytd AS return_ytd, b1y AS return_1y,
       b3y AS return_3y, b5y AS return_5y FROM (SELECT symbol, cutoff, {DAY_BASES} FROM quotes, cutoffs
       WHERE date <= cutoff GROUP BY 1, 2)""", f"{AS_OF}, {CUTOFFS}")
def _(spark, sf):
    return asof.asof_prices(v.quotes(spark, sf), "adj_close", {c: cal.day_horizons(c) for c in month_end_list(spark, sf)})


@query("asof_latest_record", "symbol cutoff:d record_date:d interest_coverage:6 price_earnings_to_growth_ratio:6",
       "quotes ratios", """SELECT symbol, cutoff, date AS record_date, interest_coverage, price_earnings_to_growth_ratio
       FROM ratios, cutoffs WHERE date <= cutoff
       QUALIFY row_number() OVER (PARTITION BY symbol, cutoff ORDER BY date DESC) = 1""", f"{AS_OF}, {CUTOFFS}")
def _(spark, sf):
    payload = ["interest_coverage", "price_earnings_to_growth_ratio"]
    return asof.asof_latest_record(v.ratios(spark, sf), ["symbol"], "date", month_end_list(spark, sf), payload)


@query("asof_join_backward", "symbol date:d adj_close:6 rate:6", "quotes treasury",
       """SELECT symbol, q.date, adj_close, month3 AS rate FROM quotes q ASOF LEFT JOIN treasury t ON q.date >= t.date""")
def _(spark, sf):
    quotes = v.quotes(spark, sf).select("symbol", "date", "adj_close")
    return asof.asof_backward(quotes, v.treasury(spark, sf), "month3", "rate")


PCT = """SELECT symbol, date, adj_close / nullif(lag(adj_close) OVER w, 0) - 1 AS ret, lag(date) OVER w AS previous_date
    FROM quotes WINDOW w AS (PARTITION BY symbol ORDER BY date)"""


@query("pct_change", "symbol date:d previous_date:d ret:6", "quotes", f"SELECT * FROM ({PCT}) WHERE ret IS NOT NULL")
def _(spark, sf):
    return ts.pct_change(v.quotes(spark, sf), "adj_close")


@query("inner_align_series", "symbol date:d ret:6 bench_ret:6", "quotes bench",
       f"""SELECT symbol, p.date, ret, bench_ret FROM ({PCT}) p JOIN (SELECT date, close / lag(close) OVER (ORDER BY date) - 1
       AS bench_ret FROM bench) b ON p.date = b.date WHERE ret IS NOT NULL AND bench_ret IS NOT NULL""")
def _(spark, sf):
    from tickerlake.plans.risk import benchmark_returns

    fund = ts.pct_change(v.quotes(spark, sf), "adj_close")
    # the benchmark has one row per calendar day
    return fund.join(F.broadcast(benchmark_returns(v.benchmark_close(spark, sf))), "date")


@query("resample_month_last", "symbol month:d adj_close:6", "quotes",
       """SELECT s.symbol, s.month, q.adj_close FROM
       (SELECT symbol, last_day(CAST(unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)),
       INTERVAL 1 MONTH)) AS DATE)) AS month FROM quotes GROUP BY symbol) s
       ASOF JOIN quotes q ON s.symbol = q.symbol AND s.month >= q.date""")
def _(spark, sf):
    return ts.month_last(v.quotes(spark, sf), "adj_close")


@query("trailing_slice", "symbol date:d adj_close:6", "quotes",
       "SELECT * FROM quotes, as_of WHERE date >= d - (3 * 365 + 1) AND date <= d", AS_OF)
def _(spark, sf):
    return ts.trailing_slice(v.quotes(spark, sf), month_end_list(spark, sf)[-1], 3)


@query("tail_n", "symbol month:d adj_close:6", "quotes",
       """SELECT symbol, month, adj_close FROM (SELECT symbol, last_day(date) AS month, arg_max(adj_close, date) AS adj_close
       FROM quotes GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY month DESC) <= 36""")
def _(spark, sf):
    months = v.quotes(spark, sf).groupBy("symbol", F.last_day("date").alias("month")).agg(
        F.max_by("adj_close", "date").alias("adj_close"))
    return ts.tail_n(months, ["symbol"], "month", 36)


@query("rolling_stddev", "symbol date:d n:i std_dev:4", "quotes",
       """SELECT symbol, max(date) AS date, count(*) AS n, stddev_samp(adj_close) AS std_dev FROM (SELECT * FROM quotes
       QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 252) GROUP BY symbol""")
def _(spark, sf):
    return ts.rolling_stddev(v.quotes(spark, sf), "adj_close", rows=252)


@query("range_52_week", "symbol low_52_week:6 high_52_week:6", "quotes",
       """SELECT q.symbol, min(adj_close) AS low_52_week, max(adj_close) AS high_52_week FROM quotes q
       JOIN latest l ON q.symbol = l.symbol WHERE date > latest - INTERVAL 365 DAY GROUP BY 1""", LATEST)
def _(spark, sf):
    return ts.range_52_week(v.quotes(spark, sf))


def _drawdown(y: int) -> str:
    return f"""(SELECT symbol, min(adj_close / peak - 1) AS max_drawdown_{y}y FROM (SELECT q.symbol, adj_close,
    max(adj_close) OVER (PARTITION BY q.symbol ORDER BY date) AS peak FROM quotes q JOIN latest l ON q.symbol = l.symbol
    WHERE date > latest - INTERVAL {y} YEAR) GROUP BY 1)"""


@query("max_drawdown", "symbol max_drawdown_1y:6 max_drawdown_3y:6 max_drawdown_5y:6 max_drawdown_10y:6", "quotes",
       f"SELECT * FROM {_drawdown(1)} JOIN {_drawdown(3)} USING (symbol) JOIN {_drawdown(5)} USING (symbol) "
       f"JOIN {_drawdown(10)} USING (symbol)", LATEST)
def _(spark, sf):
    return ts.max_drawdown(v.quotes(spark, sf))


@query("quartile_percentile_rank", "symbol sector ytd_change:6 quartile:i percentile:6", "quotes profile",
       f"""SELECT symbol, sector, ytd_change, ntile(4) OVER (PARTITION BY sector ORDER BY ytd_change DESC, symbol) AS quartile,
       percent_rank() OVER (PARTITION BY sector ORDER BY ytd_change DESC) AS percentile
       FROM ({PERFORMANCE}) JOIN profile USING (symbol)""", LATEST)
def _(spark, sf):
    perf = ts.price_performance(v.quotes(spark, sf)).select("symbol", "ytd_change")
    rows = perf.join(v.profile(spark, sf).select("symbol", "sector"), "symbol")
    return ranking.quartile_percentile(rows, ["sector"], "ytd_change", "symbol")


@query("trailing_window_count", "endpoint second:i calls:i trailing_calls:i over_limit", "api_calls",
       """SELECT endpoint, second, calls, trailing_calls, trailing_calls >= 5 AS over_limit FROM (SELECT endpoint, second, calls,
       CAST(sum(calls) OVER (PARTITION BY endpoint ORDER BY second RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS BIGINT)
       AS trailing_calls FROM (SELECT endpoint, CAST(floor(epoch(ts)) AS BIGINT) AS second, count(*) AS calls
       FROM api_calls GROUP BY 1, 2))""")
def _(spark, sf):
    # the test events are minutes apart, so the window is an hour instead of 60 seconds
    return ts.trailing_window_count(v.api_calls(spark, sf), "endpoint", "ts", 3600, 5)


@query("carry_columns_history", "symbol first_month:6 last_month:6", "quotes",
       f"""SELECT symbol, max(CASE WHEN cutoff = (SELECT min(cutoff) FROM cutoffs) THEN current_price END) AS first_month,
       max(CASE WHEN cutoff = (SELECT max(cutoff) FROM cutoffs) THEN current_price END) AS last_month
       FROM ({returns_sql(DAY_BASES)}) GROUP BY 1""", f"{AS_OF}, {CUTOFFS}")
def _(spark, sf):
    months = month_end_list(spark, sf)
    prices = asof.asof_prices(v.quotes(spark, sf), "adj_close", {c: cal.day_horizons(c) for c in months})
    wide = ts.carry_columns_history(prices, months, "current_price")
    first, last = (m.strftime("%Y-%m") for m in (months[0], months[-1]))
    return wide.select("symbol", F.col(first).alias("first_month"), F.col(last).alias("last_month"))
