"""Fund risk metrics and the group scores built on them.

Windows of different cut-offs overlap almost entirely. Instead of copying a fund's rows into each,
rows are folded into the cells between window edges: a cell's sums serve every window that covers it,
and the shuffle carries a few dozen cells per fund whatever the length of its history.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.functions.measures import cagr, daily_rate
from tickerlake.operators.asof import asof_backward, interval_index
from tickerlake.operators.calendar import date_array
from tickerlake.operators.joins import peer_group_expand
from tickerlake.operators.skew import join_unique
from tickerlake.operators.timeseries import by_date, month_last, tail_n
from tickerlake.operators.upsert import upsert_update
from tickerlake.session import materialise

SESSIONS = 252
# Points per metric and the metrics where less is better.
WEIGHTS = {
    "return_5y": 12, "return_3y": 20, "batting_avg": 8, "std_dev": 7.5, "beta": 7.5, "sharpe": 7.5, "alpha": 7.5, "mer": 15, "upside": 5,
    "downside": 5, "ter": 5,
}
METRICS = list(WEIGHTS)
LOWER_BETTER = {"std_dev", "beta", "mer", "downside", "ter"}
AREAS = {
    "performance": (["return_5y", "return_3y", "batting_avg"], 40),
    "risk": (["std_dev", "beta", "sharpe", "alpha"], 30),
    "management": (["mer", "upside", "downside", "ter"], 30),
}


def benchmark_returns(bench: DataFrame, price: str = "close") -> DataFrame:
    """Daily relative change of the one benchmark series (a row per calendar day, so one small window)."""
    return _with_change(bench, price).filter(F.col("bench_ret").isNotNull()).select("date", "bench_ret")


def _with_change(bench: DataFrame, price: str) -> DataFrame:
    return bench.withColumn("bench_ret", F.try_divide(F.col(price), F.lag(price).over(Window.orderBy("date"))) - 1)


def _edges_passed(day: str, edges: list[date]) -> Column:
    """How many of the ascending edges are at or before ``day``; 0 for NULL."""
    steps = " ".join(f"WHEN {day} >= DATE '{e}' THEN {i}" for i, e in reversed(list(enumerate(edges, 1))))
    return F.expr(f"CASE {steps} ELSE 0 END")


def _window_starts(cutoffs: list[date], years: int) -> list[date]:
    return [c - timedelta(days=365 * years + 1) for c in cutoffs]


#: Deviations of daily changes up to this share of 1 are rounding of the prices, not risk.
FLAT = 1e-12


def merged_moments(parts: Column) -> Column:
    """n, means and centred sums (mx, my, cxx, cxy, cyy) of all rows from those of disjoint sets of rows.

    Pairwise update: no raw sums of squares, so a small spread around a large mean keeps its digits.
    """
    start = F.expr("named_struct('n', 0D, 'mx', 0D, 'my', 0D, 'cxx', 0D, 'cxy', 0D, 'cyy', 0D)")

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        dx, dy, weight = b["mx"] - a["mx"], b["my"] - a["my"], a["n"] * b["n"] / n
        return F.struct(
            n.alias("n"), (a["mx"] + dx * b["n"] / n).alias("mx"), (a["my"] + dy * b["n"] / n).alias("my"),
            (a["cxx"] + b["cxx"] + dx * dx * weight).alias("cxx"), (a["cxy"] + b["cxy"] + dx * dy * weight).alias("cxy"),
            (a["cyy"] + b["cyy"] + dy * dy * weight).alias("cyy"),
        )

    return F.aggregate(parts, start, add)


def _on_fund_days(rows: DataFrame) -> DataFrame:
    """The benchmark's change between the fund's own return days instead of between its own days."""
    valid = F.col("ret").isNotNull() & F.col("close").isNotNull()
    earlier = by_date().rowsBetween(Window.unboundedPreceding, -1)
    close = F.last(F.when(valid, F.col("close")), ignorenulls=True).over(earlier)
    base = F.last(F.when(valid, F.col("prev")), ignorenulls=True).over(earlier)
    change = F.when(valid, F.try_divide(F.col("close"), close) - 1)
    return rows.withColumns({"bench_ret": change, "base": base})


def daily_metrics(
    quotes: DataFrame, bench: DataFrame, rates: DataFrame, cutoffs: list[date], price: str = "adj_close", rate: str = "month3",
    fund_days: bool = False,
) -> DataFrame:
    """Per fund and cut-off position: growth over 5 and 3 years, and the daily figures against the benchmark.

    ``fund_days`` takes the benchmark's changes between the days the fund has returns on.
    """
    market = asof_backward(
        _with_change(bench.select("date", "close"), "close"),
        rates.select("date", daily_rate(F.col(rate)).alias("_rate")), "_rate", "rf",
    )
    before = F.lag("date").over(by_date())
    starts5, starts3 = _window_starts(cutoffs, 5), _window_starts(cutoffs, 3)
    # no window holds another row, and a return whose base row is outside belongs to none; the range reaches the scan
    recent = quotes.filter(F.col("date").between(F.lit(starts5[0]), F.lit(cutoffs[-1])))
    rows = (
        recent.select("symbol", "date", F.col(price).alias("p"))
        .withColumns({"prev": before, "ret": F.try_divide(F.col("p"), F.lag("p").over(by_date())) - 1})
        # the benchmark and its rates have one row per calendar day
        .join(F.broadcast(market), "date", "left")
    )
    rows = _on_fund_days(rows) if fund_days else rows.withColumn("base", F.col("prev"))
    x = F.when(F.col("ret").isNotNull(), F.col("bench_ret"))
    y = F.when(F.col("bench_ret").isNotNull(), F.col("ret"))
    rf = F.when(F.col("ret").isNotNull() & F.col("bench_ret").isNotNull(), F.col("rf"))
    cells = (
        rows.withColumns(
            {
                "j": interval_index("date", cutoffs),
                "in5": _edges_passed("date", starts5),
                "in3": _edges_passed("date", starts3),
                # a return belongs to a window only when its base row does
                "ret3": _edges_passed("base", starts3),
            }
        )
        .filter("j IS NOT NULL AND in5 > 0")
        .groupBy("symbol", "j", "in5", "in3", "ret3")
        .agg(
            F.count("*").alias("n"),
            F.min("date").alias("d0"), F.min_by("p", "date").alias("p0"),
            F.max("date").alias("d1"), F.max_by("p", "date").alias("p1"),
            F.count(y).cast("double").alias("m"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.var_pop(x).alias("vx"),
            F.covar_pop(x, y).alias("vxy"), F.var_pop(y).alias("vy"), F.sum(rf).alias("srf"), F.count(rf).alias("nrf"),
        )
    )
    k = F.col("k")
    spread = cells.withColumn("k", F.explode(F.sequence(F.col("j"), F.lit(len(cutoffs) - 1)))).filter("in5 > k")

    def within(flag: str, c: str) -> Column:
        return F.when(F.col(flag) > k, F.col(c))

    n = F.col("m")
    moments = F.struct(
        n.alias("n"), "mx", "my", (F.col("vx") * n).alias("cxx"), (F.col("vxy") * n).alias("cxy"), (F.col("vy") * n).alias("cyy"))
    grouped = spread.groupBy("symbol", "k").agg(
        F.sum("n").alias("n5"), F.min("d0").alias("d0_5"), F.min_by("p0", "d0").alias("p0_5"),
        F.max("d1").alias("d1"), F.max_by("p1", "d1").alias("p1"),
        F.sum(within("in3", "n")).alias("n3"), F.min(within("in3", "d0")).alias("d0_3"),
        F.min_by("p0", within("in3", "d0")).alias("p0_3"),
        *[F.sum(within("ret3", c)).alias(c) for c in ("srf", "nrf")],
        # a few dozen cells lie in a window
        F.sort_array(F.collect_list(F.when((F.col("ret3") > k) & (F.col("m") > 0), moments))).alias("_cells"),
    ).withColumn("_all", merged_moments(F.col("_cells")))
    m, mean_x, mean_y = F.col("_all.n"), F.col("_all.mx"), F.col("_all.my")
    mean_rf = F.try_divide(F.col("srf"), F.col("nrf"))

    def deviation(total: str) -> Column:
        std = F.sqrt(F.try_divide(F.col(f"_all.{total}"), m - 1))
        return F.when(std > FLAT, std).when(std.isNotNull(), 0.0)

    std = deviation("cyy")
    beta = F.when(deviation("cxx") > 0, F.col("_all.cxy") / F.col("_all.cxx"))
    sharpe = F.when(std > 0, (mean_y - mean_rf) / std * SESSIONS**0.5).otherwise(0.0)
    return grouped.select(
        "symbol", "k", "n5", "n3", m.alias("m"),
        cagr(F.col("p1"), F.col("p0_5"), F.datediff("d1", "d0_5")).alias("return_5y"),
        cagr(F.col("p1"), F.col("p0_3"), F.datediff("d1", "d0_3")).alias("return_3y"),
        (std * SESSIONS**0.5).alias("std_dev"),
        beta.alias("beta"),
        sharpe.alias("sharpe"),
        (((mean_y - mean_rf) - beta * (mean_x - mean_rf)) * SESSIONS).alias("alpha"),
    )


def monthly_pairs(quotes: DataFrame, bench: DataFrame, price: str = "adj_close") -> DataFrame:
    """(symbol, month, known_by, fund, market): monthly returns where both sides have one."""

    def returns(rows: DataFrame, value: str, out: str) -> DataFrame:
        months = month_last(rows, value)
        by_month = Window.partitionBy("symbol").orderBy("month")
        change = F.try_divide(F.col(value), F.lag(value).over(by_month)) - 1
        return months.select("symbol", "month", "known_by", change.alias(out)).filter(F.col(out).isNotNull())

    fund = returns(quotes.select("symbol", "date", price), price, "fund")
    series = bench.select(F.lit(0).alias("symbol"), "date", F.col("close").alias("_close"))
    market = returns(series, "_close", "market").select("month", F.col("known_by").alias("_market_known"), "market")
    # one benchmark row per calendar month
    return fund.join(F.broadcast(market), "month").select(
        "symbol", "month", F.greatest("known_by", "_market_known").alias("known_by"), "fund", "market"
    )


def _captures(inside: Column | None = None, suffix: str = "", empty: float = 50.0) -> list[Column]:
    """Months, batting average and capture ratios over the rows where ``inside`` holds.

    ``empty`` is the capture ratio when the market had no month of that side.
    """

    def when(condition: Column, value: Column) -> Column:
        return F.when(condition if inside is None else condition & inside, value)

    fund, market = F.col("fund"), F.col("market")

    def capture(side: Column) -> Column:
        ratio = F.try_divide(F.avg(when(side, fund)), F.avg(when(side, market))) * 100
        return F.coalesce(ratio, F.lit(empty))

    every = F.lit(True)
    return [
        F.count(when(every, F.lit(1))).alias(f"months{suffix}"),
        (F.avg(when(every, (fund > market).cast("double"))) * 100).alias(f"batting_avg{suffix}"),
        capture(market > 0).alias(f"upside{suffix}"),
        capture(market < 0).alias(f"downside{suffix}"),
    ]


def monthly_metrics(pairs: DataFrame, cutoffs: list[date], months: int = 36, empty: float = 50.0) -> DataFrame:
    """Batting average and capture ratios over the last ``months`` months at each cut-off position (month ends)."""
    span = (cutoffs[-1].year - cutoffs[0].year) * 12 + cutoffs[-1].month - cutoffs[0].month
    # no earlier row can be among the last months of any cut-off
    recent = tail_n(pairs.filter(F.col("known_by") <= F.lit(cutoffs[-1])), ["symbol"], "month", months + span)
    first = interval_index("known_by", cutoffs)
    dated = recent.withColumn("k", F.explode(F.sequence(first, F.lit(len(cutoffs) - 1))))
    return tail_n(dated, ["symbol", "k"], "month", months).groupBy("symbol", "k").agg(*_captures(empty=empty))


def capture_by_horizon(pairs: DataFrame, years: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """Batting average and capture ratios over the newest 1, 3, 5 and 10 years per fund."""
    newest = F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("month").desc()))
    recent = pairs.withColumn("_n", newest).filter(F.col("_n") <= 12 * max(years))
    columns = [c for y in years for c in _captures(F.col("_n") <= 12 * y, f"_{y}y")]
    return recent.groupBy("symbol").agg(*columns)


def etf_metrics(
    quotes: DataFrame, bench: DataFrame, rates: DataFrame, expenses: DataFrame, cutoffs: list[date],
    min_rows_5y: int = 900, min_rows_3y: int = 252, min_months: int = 12, fund_days: bool = False, empty_capture: float = 50.0,
) -> DataFrame:
    """All metrics per fund and cut-off with enough history; computed once per fund, not once per group."""
    daily = daily_metrics(quotes, bench, rates, cutoffs, fund_days=fund_days)
    enough = daily.filter((F.col("n5") >= min_rows_5y) & (F.col("n3") >= min_rows_3y) & (F.col("m") >= 2))
    known = quotes.filter(F.col("date") <= F.lit(cutoffs[-1]))
    monthly = monthly_metrics(monthly_pairs(known, bench), cutoffs, empty=empty_capture).filter(F.col("months") >= min_months)
    labels = date_array(cutoffs)
    return (
        enough.join(monthly, ["symbol", "k"])
        .join(expenses.select("symbol", F.col("expense_ratio").alias("mer")), "symbol", "left")
        .withColumns({"cutoff": F.get(labels, F.col("k")), "ter": F.col("mer")})
        .select("symbol", "cutoff", *METRICS)
    )


def etf_group_scores(metrics: DataFrame, peers: DataFrame, profile: DataFrame) -> DataFrame:
    """(symbol, date, performance, risk, management, total_score) of each reference among its group.

    Metrics are scaled to 0..1 in the group and weighted; flat, lone and missing ones count half.
    Each area is then scaled to 0..100 in the group.
    """
    # a reference without peers is a group of one
    refs = profile.select("symbol").distinct()
    members = peer_group_expand(peers, profile).unionByName(refs.select(F.col("symbol").alias("ref"), "symbol")).distinct()
    # a stored table on the other side lets a fund that most references list be split
    rows = materialise(members.join(materialise(metrics, "fund-metrics"), "symbol"), "fund-groups")
    group = ["ref", "cutoff"]
    stats = rows.groupBy(*group).agg(
        *[f(c).alias(f"_{n}_{c}") for c in METRICS for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]
    )

    def points(c: str) -> Column:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        position = (F.col(c) - lo) / (hi - lo)
        directed = 1 - position if c in LOWER_BETTER else position
        flat = (F.col(f"_n_{c}") < 2) | (lo == hi)
        return F.when(flat, 0.5).otherwise(F.coalesce(directed, F.lit(0.5))) * float(WEIGHTS[c])

    def total(columns: list[str]) -> Column:
        return reduce(lambda a, b: a + b, [F.col(c) for c in columns])

    scored = join_unique(rows, stats, group, "symbol").withColumns({c: points(c) for c in METRICS})
    areas = {a: total(columns) / top * 100 for a, (columns, top) in AREAS.items()}
    scored = scored.withColumns({**areas, "total_score": total(METRICS)}).select(*group, "symbol", *AREAS, "total_score")
    names = [*AREAS, "total_score"]
    extremes = scored.groupBy(*group).agg(*[f(c).alias(f"_{n}_{c}") for c in names for n, f in (("lo", F.min), ("hi", F.max))])

    def scaled(c: str) -> Column:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        return F.when(hi > lo, (F.col(c) - lo) / (hi - lo) * 100).otherwise(50.0).alias(c)

    own = scored.filter("symbol = ref")
    return own.join(extremes, group).select("symbol", F.col("cutoff").alias("date"), *[scaled(c) for c in names])


def etf_scores_history(
    stored: DataFrame, quotes: DataFrame, bench: DataFrame, rates: DataFrame, expenses: DataFrame, peers: DataFrame,
    profile: DataFrame, cutoffs: list[date], **minimums: int,
) -> DataFrame:
    """Group scores at every cut-off, upserted into the stored scores on (symbol, date)."""
    metrics = etf_metrics(quotes, bench, rates, expenses, cutoffs, **minimums)
    return upsert_update(stored, etf_group_scores(metrics, peers, profile), ["symbol", "date"])
