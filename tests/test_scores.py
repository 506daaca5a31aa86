from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerlake.functions.measures import clip_0_100, mean_of
from tickerlake.operators import aggregates as agg, joins
from tickerlake.plans import peer_scores as ps, risk
from tickerlake.session import materialise


def test_minmax_subscores(frame):
    rows = materialise(frame(
        "ref string, symbol string, up double, flat double, lone double, low double",
        ("r", "a", 1.0, 5.0, 7.0, 1.0), ("r", "b", 3.0, 5.0, None, 2.0), ("r", "c", None, None, None, 5.0)), "t")
    better = {"up": True, "flat": True, "lone": True, "low": False}
    got = {r.symbol: (r.up, r.flat, r.lone, r.low) for r in ps.subscores_minmax(rows, ["ref"], better).collect()}
    assert got == {"a": (0.0, 50.0, 50.0, 100.0), "b": (100.0, 50.0, 50.0, 75.0), "c": (0.0, 0.0, 50.0, 0.0)}


def test_percentile_subscores(frame):
    rows = materialise(frame(
        "ref string, symbol string, up double, lone double, none double, low double",
        ("r", "a", 1.0, 7.0, None, 1.0), ("r", "b", 3.0, None, None, 1.0), ("r", "c", 3.0, None, None, 5.0), ("r", "d", None, None, None, None)), "t")
    better = {"up": True, "lone": True, "none": True, "low": False}
    got = {r.symbol: (r.up, r.lone, r.none, r.low) for r in ps.subscores_percentile(rows, ["ref"], "symbol", better).collect()}
    third = 100 / 3
    assert got["a"] == pytest.approx((third, 100.0, 0.0, 100.0))
    assert got["b"] == pytest.approx((100.0, 0.0, 0.0, 100.0))
    assert got["c"] == pytest.approx((100.0, 0.0, 0.0, third))
    assert got["d"] == (0.0, 0.0, 0.0, 0.0)


def test_small_and_large_groups_score_and_rank_alike(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(f"g{g}", f"s{i % (n - 1)}" if i else None, *[None if rng.random() < 0.2 else float(rng.integers(-4, 5)) for _ in range(2)]) for g, n in enumerate((3, 9, 70, 5)) for i in range(n)]
    rows = materialise(spark.createDataFrame([*rows, (None, "s1", 1.0, 2.0)], "ref string, symbol string, up double, low double"), "t")
    better = {"up": True, "low": False}

    def scored():
        return sorted(map(tuple, ps.subscores_percentile(rows, ["ref"], "symbol", better).collect()), key=str)

    # the group of 70 is spread, the others are compared in one row
    mixed = scored()
    monkeypatch.setattr(ps, "COMPARED", 0)
    assert mixed == scored() and len(mixed) == 88
    monkeypatch.setattr(ps, "COMPARED", 100)
    assert mixed == scored()
    scores = spark.createDataFrame([(f"g{i % 3}", i, 1, float(i % 7), float(i % 5)) for i in range(60)], "ref string, symbol int, cutoff int, a double, b double")
    whole = {tuple(r) for r in ps._ranked(scores, ["a", "b"]).select("ref", "symbol", "category", "rank").collect()}
    monkeypatch.setattr(ps, "RANKED_WHOLE", 0)
    assert whole == {tuple(r) for r in ps._ranked(scores, ["a", "b"]).select("ref", "symbol", "category", "rank").collect()} and len(whole) == 120


def test_universe_normalisation(frame):
    df = frame("cutoff int, symbol string, v double", (1, "a", 1.0), (1, "b", 3.0), (1, "c", None), (2, "a", 4.0), (2, "b", 4.0))
    got = {(r.cutoff, r.symbol): r.v for r in agg.minmax_normalise_universe(df, "cutoff", ["v"]).collect()}
    assert got == {(1, "a"): 0.0, (1, "b"): 100.0, (1, "c"): None, (2, "a"): 50.0, (2, "b"): 50.0}


def test_null_survives_clip_and_mean(spark):
    row = spark.range(1).select(
        clip_0_100(F.lit(None).cast("double")), clip_0_100(F.lit(120.0)), mean_of(F.lit(None).cast("double"), F.lit(4.0)),
        mean_of(F.lit(None).cast("double"))).first()
    assert tuple(row) == (None, 100.0, 4.0, None)


def test_peer_groups(frame, values):
    peers = frame("symbol string, peer_symbol string", ("A", " b "), ("A", "B"), ("a", "C"), ("D", "D"), ("X", "A"), ("A", None))
    refs = frame("symbol string", ("A",), ("D",), ("E",))
    assert values(joins.peer_group_expand(peers, refs)) == [("A", "A"), ("A", "B"), ("A", "C")]


def test_group_averages_round_half_up(frame):
    d = date(2024, 1, 31)
    scores = frame("symbol string, date date, score_type string, score double",
                   ("a", d, "growth", 10.0), ("b", d, "growth", 10.01), ("c", d, "growth", None), ("a", date(2023, 1, 31), "growth", 90.0))
    profile = frame("symbol string, sector string, industry string", ("a", "s", "i"), ("b", "s", None), ("c", "s", "i"))
    got = {(r.group_type, r.group_name): float(r.avg_score) for r in agg.avg_score_by_group(scores, profile).collect()}
    assert got == {("sector", "s"): 10.01, ("industry", "i"): 10.0}


def _series(seed, n, start=date(2019, 1, 1), gap=()):
    rng = np.random.default_rng(seed)
    days = [start + timedelta(days=int(i)) for i in range(n) if i not in gap]
    return pd.Series(np.exp(np.cumsum(rng.normal(0.0003, 0.01, len(days)))) * 100, index=pd.DatetimeIndex(days))


def expected_metrics(fund, bench, rf, cutoff):
    """The definition, with pandas on one fund."""
    cutoff = pd.Timestamp(cutoff)
    up_to = fund[:cutoff]
    five, three = (up_to[cutoff - pd.Timedelta(days=365 * y + 1):] for y in (5, 3))
    grow = lambda s: (s.iloc[-1] / s.iloc[0]) ** (365 / (s.index[-1] - s.index[0]).days) - 1
    ret, mkt = three.pct_change().dropna().align(bench[:cutoff].pct_change().dropna(), join="inner")
    rate = rf.asof(ret.index).mean()
    beta = np.polyfit(mkt, ret, 1)[0]
    pad = lambda s: s.resample("ME").last().ffill().pct_change().dropna()
    fm, bm = pad(up_to).align(pad(bench[:cutoff]), join="inner")
    fm, bm = fm.tail(36), bm.tail(36)
    return {
        "return_5y": grow(five), "return_3y": grow(three), "std_dev": ret.std() * 252**0.5, "beta": beta,
        "sharpe": (ret - rate).mean() / ret.std() * 252**0.5,
        "alpha": ((ret.mean() - rate) - beta * (mkt - rate).mean()) * 252,
        "batting_avg": (fm > bm).mean() * 100,
        "upside": fm[bm > 0].mean() / bm[bm > 0].mean() * 100, "downside": fm[bm < 0].mean() / bm[bm < 0].mean() * 100,
    }


def test_fund_metrics_match_the_definition(spark):
    # a fund with a hole of two months, a benchmark that misses days, a rate that starts late
    funds = {"F": _series(1, 2000), "G": _series(2, 2000, gap=set(range(900, 965)))}
    bench = _series(3, 2000, gap=set(range(0, 2000, 17)))
    rf = pd.Series([0.01, 0.03, 0.02], index=pd.DatetimeIndex(["2021-06-01", "2022-01-10", "2023-03-05"])) / 1
    cutoffs = [date(2023, 4, 30), date(2024, 1, 31), date(2024, 5, 31)]
    quotes = spark.createDataFrame(
        [(s, d.date(), float(p)) for s, series in funds.items() for d, p in series.items()], "symbol string, date date, adj_close double")
    b = spark.createDataFrame([(d.date(), float(p)) for d, p in bench.items()], "date date, close double")
    rates = spark.createDataFrame([(d.date(), float(p) * 100 * 252) for d, p in rf.items()], "date date, month3 double")
    expenses = spark.createDataFrame([("F", 0.1)], "symbol string, expense_ratio double")
    got = {(r.symbol, r.cutoff): r.asDict() for r in risk.etf_metrics(quotes, b, rates, expenses, cutoffs, 900, 252, 12).collect()}
    assert len(got) == 6
    for (symbol, cutoff), row in got.items():
        want = expected_metrics(funds[symbol], bench, rf, cutoff)
        assert {k: row[k] for k in want} == pytest.approx(want, rel=1e-6, abs=1e-9)
    assert got["F", cutoffs[0]]["mer"] == 0.1 and got["G", cutoffs[0]]["ter"] is None


def test_benchmark_on_fund_days(spark):
    fund = _series(6, 1900, gap=set(range(0, 1900, 5)))
    bench = _series(7, 1900)
    cutoff = date(2024, 1, 31)
    quotes = spark.createDataFrame([("F", d.date(), float(p)) for d, p in fund.items()], "symbol string, date date, adj_close double")
    b = spark.createDataFrame([(d.date(), float(p)) for d, p in bench.items()], "date date, close double")
    rates = spark.createDataFrame([(date(2019, 1, 1), 2.52)], "date date, month3 double")
    expenses = spark.createDataFrame([("F", 0.1)], "symbol string, expense_ratio double")
    [row] = risk.etf_metrics(quotes, b, rates, expenses, [cutoff], fund_days=True).collect()
    stamp = pd.Timestamp(cutoff)
    ret = fund[stamp - pd.Timedelta(days=1096):stamp].pct_change().dropna()
    ret, mkt = ret.align(bench.loc[ret.index].pct_change().dropna(), join="inner")
    beta = np.polyfit(mkt, ret, 1)[0]
    assert row.beta == pytest.approx(beta, rel=1e-6)
    assert row.std_dev == pytest.approx(ret.std() * 252**0.5, rel=1e-6)
    assert row.alpha == pytest.approx(((ret.mean() - 1e-4) - beta * (mkt.mean() - 1e-4)) * 252, rel=1e-6)


def test_too_little_history_gives_no_row(spark):
    fund = _series(4, 300, start=date(2023, 1, 1))
    quotes = spark.createDataFrame([("F", d.date(), float(p)) for d, p in fund.items()], "symbol string, date date, adj_close double")
    b = quotes.select("date", F.col("adj_close").alias("close"))
    rates = spark.createDataFrame([(date(2023, 1, 1), 3.0)], "date date, month3 double")
    expenses = spark.createDataFrame([("F", 0.1)], "symbol string, expense_ratio double")
    assert risk.etf_metrics(quotes, b, rates, expenses, [date(2023, 9, 30)]).count() == 0


def test_capture_without_down_months_is_fifty(spark):
    rows = [("F", date(2023, m, 28), date(2023, m, 28), 0.02, 0.01) for m in range(1, 13)]
    pairs = spark.createDataFrame(rows, "symbol string, month date, known_by date, fund double, market double")
    r = risk.capture_by_horizon(pairs, (1,)).first()
    assert (r.months_1y, r.batting_avg_1y, r.upside_1y, r.downside_1y) == (12, 100.0, pytest.approx(200.0), 50.0)


def test_lone_fund_scores_fifty(spark):
    schema = "symbol string, cutoff date, " + ", ".join(f"{m} double" for m in risk.METRICS)
    metrics = spark.createDataFrame([("F", date(2024, 1, 31), *[1.0] * len(risk.METRICS))], schema)
    peers = spark.createDataFrame([], "symbol string, peer_symbol string")
    profile = spark.createDataFrame([("F",)], "symbol string")
    r = risk.etf_group_scores(metrics, peers, profile).first()
    assert (r.performance, r.risk, r.management, r.total_score) == (50.0, 50.0, 50.0, 50.0)
