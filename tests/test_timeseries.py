from datetime import date

import pytest
from pyspark.sql import functions as F

from tickerlake.operators import asof, calendar as cal, timeseries as ts

D = date


def quotes(frame, *rows):
    return frame("symbol string, date date, adj_close double", *rows)


def test_missing_and_zero_base_give_zero_change(frame):
    q = quotes(frame, ("A", D(2024, 3, 5), 10.0), ("Z", D(2024, 3, 4), 0.0), ("Z", D(2024, 3, 5), 5.0))
    got = {r.symbol: r for r in ts.price_performance(q).collect()}
    assert (got["A"].day_change, got["A"].quarter_change, got["A"].ytd_change) == (0.0, 0.0, 0.0)
    assert got["Z"].day_change == 0.0


def test_first_days_of_january(frame):
    q = quotes(frame, ("A", D(2023, 12, 29), 8.0), ("A", D(2024, 1, 2), 10.0), ("A", D(2024, 1, 3), 12.0))
    r = ts.price_performance(q).first()
    assert r.ytd_change == pytest.approx(20.0) and r.day_change == pytest.approx(20.0)
    assert r.week_change == 0.0 and r.quarter_change == 0.0


def test_trend_labels(spark):
    rows = spark.createDataFrame(
        [(3.0, 2.0, 1.0), (1.0, 2.0, 3.0), (4.0, 2.0, 3.0), (1.0, 3.0, 2.0), (1.0, None, 2.0), (2.0, 2.0, 2.0)],
        "p double, s double, l double")
    labels = [r[0] for r in rows.select(ts.trend_label(F.col("p"), F.col("s"), F.col("l"))).collect()]
    assert labels == ["Uptrend", "Downtrend", "HOLD", "HOLD", "Insufficient data", "Downtrend"]


def test_one_week_of_quotes(frame):
    q = quotes(frame, *[("A", D(2024, 3, 4 + i), 1.0 + i) for i in range(5)])
    weekly, daily = (ts.latest_trend(q, basis=b).first() for b in ("weekly", "daily"))
    assert (weekly.sma10, weekly.trend) == (5.0, "Downtrend")
    assert daily.sma10 == pytest.approx(3.0)


def test_month_ends_clamp(spark):
    one = spark.range(1)

    def dates(build, day):
        return one.select(build(F.lit(day))).first()[0]

    assert dates(cal.historical_month_ends, D(2025, 3, 31))[-3:] == [D(2025, 1, 31), D(2025, 2, 28), D(2025, 3, 31)]
    assert len(dates(cal.historical_month_ends, D(2025, 3, 30))) == 12
    clipped = dates(cal.month_ends_clipped, D(2025, 3, 10))
    assert (clipped[-1].month_end, clipped[-1].cutoff) == (D(2025, 3, 31), D(2025, 3, 10))
    assert dates(cal.month_ends_up_to, D(2025, 3, 10))[-1] == D(2025, 2, 28)
    assert dates(cal.month_ends_up_to, D(2025, 2, 28))[-1] == D(2025, 2, 28)


def test_months_back():
    assert cal.months_back(D(2025, 3, 31), 1) == D(2025, 2, 28)
    assert cal.months_back(D(2024, 2, 29), 12) == D(2023, 2, 28)
    assert cal.months_back(D(2025, 1, 15), 1) == D(2024, 12, 15)


def test_period_returns(frame):
    q = quotes(
        frame, ("A", D(2023, 12, 31), 50.0), ("A", D(2024, 1, 1), 40.0), ("A", D(2024, 5, 1), 80.0), ("A", D(2024, 6, 1), 100.0),
        ("B", D(2024, 6, 1), 0.0), ("B", D(2024, 1, 1), 5.0), ("C", D(2024, 7, 1), 1.0))
    day = D(2024, 6, 1)
    le = {r.symbol: r for r in asof.period_returns(q, "adj_close", {day: cal.day_horizons(day)}).collect()}
    lt = {r.symbol: r for r in asof.period_returns(q, "adj_close", {day: cal.day_horizons(day, "lt")}).collect()}
    assert le["A"].return_1m == pytest.approx(25.0) and le["A"].return_1y is None
    assert le["A"].return_ytd == pytest.approx(150.0) and lt["A"].return_ytd == pytest.approx(100.0)
    assert le["B"].return_ytd is None
    assert "C" not in le


def test_asof_keeps_a_null_of_the_newest_row(frame):
    r = frame("symbol string, date date, v double", ("A", D(2024, 1, 1), 1.0), ("A", D(2024, 2, 1), None))
    got = asof.asof_latest_record(r, ["symbol"], "date", [D(2023, 12, 31), D(2024, 1, 31), D(2024, 2, 29)], ["v"]).collect()
    assert sorted((str(x.cutoff), x.v) for x in got) == [("2024-01-31", 1.0), ("2024-02-29", None)]


def test_asof_backward_by_key(frame):
    days = frame("symbol string, date date", ("A", D(2024, 1, 5)), ("A", D(2024, 1, 1)), ("B", D(2024, 1, 5)))
    series = frame("symbol string, date date, r double", ("A", D(2024, 1, 2), 1.0), ("A", D(2024, 1, 5), 2.0), ("B", D(2024, 1, 6), 3.0))
    got = {(x.symbol, x.date.day): x["rate"] for x in asof.asof_backward(days, series, "r", "rate", ["symbol"]).collect()}
    assert got == {("A", 5): 2.0, ("A", 1): None, ("B", 5): None}


def test_month_without_quotes_is_filled(frame):
    q = quotes(frame, ("A", D(2024, 1, 15), 1.0), ("A", D(2024, 3, 20), 3.0))
    got = [(r.month.month, r.adj_close, r.known_by.month) for r in ts.month_last(q, "adj_close").orderBy("month").collect()]
    assert got == [(1, 1.0, 1), (2, 1.0, 3), (3, 3.0, 3)]


def test_slice_edges_are_inclusive(frame):
    q = quotes(frame, ("A", D(2023, 6, 1), 1.0), ("A", D(2023, 5, 31), 1.0), ("A", D(2024, 6, 1), 1.0), ("A", D(2024, 6, 2), 1.0))
    assert sorted(str(r.date) for r in ts.trailing_slice(q, D(2024, 6, 1), 1).collect()) == ["2023-06-01", "2024-06-01"]
