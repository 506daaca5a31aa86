"""Horizons, drawdowns and risk moments: bounded folds instead of whole histories."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerlake.operators import timeseries as ts
from tickerlake.plans import market, pages, risk
from tickerlake.session import materialise

QUOTES = "symbol string, date date, adj_close double"
START = date(2014, 2, 27)


def by_window(df, years):
    """The drawdown by a running maximum over the whole history."""
    out = []
    for y in years:
        inside = df.join(df.groupBy("symbol").agg(F.max("date").alias("latest")), "symbol").filter(F.col("date") > F.add_months("latest", -12 * y))
        peak = F.max("adj_close").over(Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
        out.append({r[0]: r[1] for r in inside.withColumn("f", F.try_divide(F.col("adj_close"), peak) - 1).groupBy("symbol").agg(F.min("f")).collect()})
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), gap=st.integers(1, 40))
def test_drawdown_equals_the_window_version(spark, seed, gap):
    rng, rows = random.Random(seed), []
    for symbol in "ABC":
        day, price = START, 100.0
        for _ in range(rng.randrange(1, 160)):
            price = rng.choice([price * rng.uniform(0.7, 1.3), price, 0.0 if rng.random() < 0.02 else price, 1.0])
            rows.append((symbol, day, None if rng.random() < 0.03 else price))
            day += timedelta(days=rng.randrange(1, gap + 1))
    df = spark.createDataFrame(rows, QUOTES).repartition(4)
    found = {r["symbol"]: r for r in ts.max_drawdown(df).collect()}
    for y, expected in zip(ts.YEARS, by_window(df, ts.YEARS)):
        for symbol, fall in expected.items():
            assert found[symbol][f"max_drawdown_{y}y"] == fall, (symbol, y)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_is_not_shuffled(spark):
    rows = [("S%d" % (i % 7), START + timedelta(days=i // 7), float(i)) for i in range(2100)]
    quotes = materialise(spark.createDataFrame(rows, QUOTES).repartition(4), "quotes")
    for frame in (ts.price_performance(quotes), ts.price_summary(quotes), ts.range_52_week(quotes), ts.first_in_year(quotes, "adj_close")):
        plan = plan_of(frame)
        # one read of the quotes, one of the newest dates, which are broadcast; a single shuffle, of the combined rows per symbol and task
        assert plan.count("FileScan parquet") == 2 and "BroadcastHashJoin" in plan and plan.count("hashpartitioning") == 1
        assert "Window" not in plan
    assert "Window" not in plan_of(ts.max_drawdown(quotes))


def test_summary_of_one_symbol(spark):
    days = [START + timedelta(days=i) for i in range(0, 1200, 3)]
    rows = [("A", d, 100.0 + i) for i, d in enumerate(days)] + [("B", days[0], 0.0), ("C", days[0], None)]
    found = {r["symbol"]: r for r in ts.price_summary(spark.createDataFrame(rows, QUOTES)).collect()}
    a = found["A"]
    base = max(i for i, d in enumerate(days) if d <= a["start_1y"])
    assert a["perf_1y"] == pytest.approx((499 - 100 - base) / (100 + base) * 100) and a["start_inception"] == START
    assert a["perf_5y"] is None and a["perf_inception"] == pytest.approx(399.0)
    assert (found["B"]["perf_inception"], found["B"]["day_change"], found["C"]["price"], found["C"]["start_inception"]) == (None, 0.0, None, None)


def risk_of(spark, prices, bench, cutoff_days=1000):
    days = [START + timedelta(days=i) for i in range(len(bench))]
    rows = [(s, d, p) for s, series in prices.items() for d, p in zip(days, series)]
    market_rows = spark.createDataFrame(list(zip(days, bench)), "date date, close double")
    rates = spark.createDataFrame([(START, 2.0)], "date date, month3 double")
    df = spark.createDataFrame(rows, QUOTES).repartition(3)
    return {r["symbol"]: r for r in risk.daily_metrics(df, market_rows, rates, [days[200], days[cutoff_days], days[-1]]).filter("k = 2").collect()}


def test_moments_of_flat_and_large_series(spark):
    rng = np.random.default_rng(4)
    n = 1100
    bench = (1e6 * np.cumprod(1 + rng.normal(0.0002, 0.01, n))).tolist()
    steady = (100 * 1.0003 ** np.arange(n)).tolist()
    noisy = (1e6 * np.cumprod(1 + rng.normal(0.0003, 1e-7, n))).tolist()
    found = risk_of(spark, {"flat": [1e6] * n, "steady": steady, "noisy": noisy, "same": bench}, bench)
    for symbol in ("flat", "steady"):
        assert (found[symbol]["std_dev"], found[symbol]["sharpe"]) == (0.0, 0.0)
    returns = np.diff(noisy)[-1096:] / np.array(noisy)[-1097:-1]
    assert found["noisy"]["std_dev"] == pytest.approx(returns.std(ddof=1) * math.sqrt(252), rel=1e-6)
    assert found["same"]["beta"] == pytest.approx(1.0, abs=1e-12) and found["same"]["alpha"] == pytest.approx(0.0, abs=1e-12)
    flat_market = risk_of(spark, {"noisy": noisy}, [5.0] * n)
    assert flat_market["noisy"]["beta"] is None


def test_merged_moments(spark):
    rng = np.random.default_rng(1)
    x, y = 1e9 + rng.normal(size=500), rng.normal(size=500)
    parts, at = [], 0
    for size in (1, 7, 200, 292):
        a, b = x[at : at + size], y[at : at + size]
        parts.append((float(size), a.mean(), b.mean(), ((a - a.mean()) ** 2).sum(), ((a - a.mean()) * (b - b.mean())).sum(), ((b - b.mean()) ** 2).sum()))
        at += size
    schema = "p array<struct<n: double, mx: double, my: double, cxx: double, cxy: double, cyy: double>>"
    [row] = spark.createDataFrame([([tuple(map(float, p)) for p in parts],)], schema).select(risk.merged_moments(F.col("p")).alias("m")).collect()
    m = row["m"]
    assert m["n"] == 500 and m["mx"] == pytest.approx(x.mean(), rel=1e-14)
    assert m["cxx"] == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-8) and m["cyy"] == pytest.approx(((y - y.mean()) ** 2).sum())
    assert m["cxy"] == pytest.approx(((x - x.mean()) * (y - y.mean())).sum(), abs=1e-5)


def test_risk_windows_reach_the_scan(spark):
    rows = [("A", START + timedelta(days=i), 100.0 + i % 9) for i in range(2500)]
    quotes = materialise(spark.createDataFrame(rows, QUOTES), "quotes")
    bench = spark.createDataFrame([(d, p) for _, d, p in rows], "date date, close double")
    rates = spark.createDataFrame([(START, 2.0)], "date date, month3 double")
    plan = plan_of(risk.daily_metrics(quotes, bench, rates, [date(2020, 12, 31)]))
    start = risk._window_starts([date(2020, 12, 31)], 5)[0]
    scan = plan[plan.index("FileScan parquet") :].split("\n")[0]
    assert f">= {start}" in scan and "<= 2020-12-31" in scan


def test_pages_read_members_only(spark):
    quotes = spark.createDataFrame([(s, START + timedelta(days=i), 10.0 + i) for s in ("P", "A", "B", "X") for i in range(40)], QUOTES)
    profile = spark.createDataFrame([("A", "t", "i", "a"), ("B", "t", "i", "b")], "symbol string, sector string, industry string, company_name string")
    members = spark.createDataFrame([("P", "A"), ("P", "B")], "parent_symbol string, symbol string")
    rows = market.market_pages(quotes, quotes.filter("false"), profile, members, {"P": "t"}).collect()
    assert {(r["symbol"], r["category"]) for r in rows} == {("P", "Main"), ("A", "Gainer"), ("A", "Loser"), ("B", "Gainer"), ("B", "Loser")}


def test_statements_with_gaps(spark):
    columns = {n: ", ".join(f"{c} double" for c in cs) for n, cs in (("i", pages.INCOME), ("b", pages.BALANCE), ("c", pages.CASH_FLOW), ("g", pages.GROWTH))}
    day = [date(2024, 3, 31), date(2024, 6, 30)]
    income = spark.createDataFrame([("A", day[0], *[1.0] * 6), ("A", day[1], 200.0, 80.0, 20.0, 10.0, 1.5, 30.0), ("B", day[0], 0.0, *[5.0] * 5)], f"symbol string, date date, {columns['i']}")
    balance = spark.createDataFrame([("A", day[0], 1000.0, 50.0, 400.0, 25.0, 500.0, 250.0)], f"symbol string, date date, {columns['b']}")
    cash, growth = (spark.createDataFrame([], f"symbol string, date date, {columns[n]}") for n in "cg")
    found = {r["symbol"]: r for r in pages.statement_latest(income, balance, cash, growth).collect()}
    a, b = found["A"], found["B"]
    assert (a.statement_date, a.gross_margin, a.net_margin, a.roa, a.roe, a.current_ratio, a.debt_to_equity, a.free_cash_flow) == (day[1], 40.0, 5.0, 1.0, 2.0, 2.0, 0.5, None)
    assert (b.gross_margin, b.roa, b.total_assets) == (None, None, None)
