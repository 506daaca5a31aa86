"""Time-series operators over (symbol, date) rows.

(symbol, date) is unique, so a window over one symbol holds one row per calendar day at most
(about 16 thousand for 60 years). Everything that reads more than that goes through aggregates.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.functions.measures import percent_change
from tickerlake.session import materialise


def by_date():
    return Window.partitionBy("symbol").orderBy("date")


def trailing(rows: int):
    return by_date().rowsBetween(1 - rows, 0)


def last_per_key(df: DataFrame, keys: list[str], day: str, columns: list[str]) -> DataFrame:
    """Newest row per key: an arg-max aggregate, combined map-side."""
    return df.groupBy(*keys).agg(F.max(day).alias(day), *[F.max_by(c, day).alias(c) for c in columns])


def newest_dates(df: DataFrame) -> DataFrame:
    """(symbol, latest), stored: two columns are read and a row per symbol and task is shuffled.

    As a stored table it has a known size. Spark broadcasts it below its threshold, so the history itself is not shuffled, and joins by sorting beyond.
    """
    return materialise(df.groupBy("symbol").agg(F.max("date").alias("latest")), "newest-dates")


def with_latest(df: DataFrame, newest: DataFrame | None = None) -> DataFrame:
    """Adds each symbol's newest date as ``latest``.

    Which rows are the last ones before "newest date less 90 days" is not known before the newest date is; rows at any offset from a task's own newest
    row may be, so no bounded fold of one pass answers it. Hence the dates come first, and the fold over the history is a combined aggregate.
    """
    return df.join(newest_dates(df) if newest is None else newest, "symbol")


def last_before_offset(df: DataFrame, price: str, days: int) -> DataFrame:
    """Last price on or before ``latest - days`` per symbol."""
    old = F.col("date") <= F.date_sub("latest", days)
    return (
        with_latest(df.select("symbol", "date", price))
        .filter(old)
        .groupBy("symbol")
        .agg(F.max("date").alias("date"), F.max_by(price, "date").alias(price))
    )


def first_in_year(df: DataFrame, price: str) -> DataFrame:
    """First price in the year of the symbol's newest date."""
    return (
        with_latest(df.select("symbol", "date", price))
        .filter(F.year("date") == F.year("latest"))
        .groupBy("symbol")
        .agg(F.min("date").alias("date"), F.min_by(price, "date").alias(price))
    )


HORIZON_DAYS = {"day_change": 1, "week_change": 7, "quarter_change": 90}


def base_before(price: str, target: Column) -> Column:
    """Last price on or before ``target``."""
    return F.max_by(price, F.when(F.col("date") <= target, F.col("date")))


def horizon_prices(df: DataFrame, price: str, newest: DataFrame | None = None) -> DataFrame:
    """Latest price and the base price of each horizon: one conditional arg-max aggregate, no self-joins."""
    bases = {name: base_before(price, F.date_sub("latest", days)) for name, days in HORIZON_DAYS.items()}
    bases["ytd_change"] = F.min_by(price, F.when(F.year("date") == F.year("latest"), F.col("date")))
    return (
        with_latest(df.select("symbol", "date", price), newest)
        .groupBy("symbol")
        .agg(
            F.max("latest").alias("date"),
            F.max_by(price, "date").alias("price"),
            *[b.alias(name) for name, b in bases.items()],
        )
    )


def price_performance(df: DataFrame, price: str = "adj_close", newest: DataFrame | None = None) -> DataFrame:
    """Latest price and its percent change over a day, week, quarter and the year; a missing base gives 0."""
    names = [*HORIZON_DAYS, "ytd_change"]
    change = {n: F.coalesce(percent_change(F.col("price"), F.col(n)), F.lit(0.0)) for n in names}
    return horizon_prices(df, price, newest).withColumns(change)


def price_summary(
    df: DataFrame, price: str = "adj_close", newest: DataFrame | None = None, years: tuple[int, ...] = (1, 3, 5, 10), volume: str | None = None
) -> DataFrame:
    """One row per symbol from one aggregate: newest price (and volume), changes of ``price_performance``, returns over a month, the years and since inception, 52-week range.

    A return is NULL where the base is missing or zero; ``start_*`` are the dates the returns run from.
    """
    starts = {"1m": F.add_months("latest", -1), **{f"{y}y": F.add_months("latest", -12 * y) for y in years}}
    bases = {f"_{n}": base_before(price, F.date_sub("latest", d)) for n, d in HORIZON_DAYS.items()}
    bases |= {f"_{n}": base_before(price, start) for n, start in starts.items()}
    bases["_ytd_change"] = F.min_by(price, F.when(F.year("date") == F.year("latest"), F.col("date")))
    known = F.when(F.col(price).isNotNull(), F.col("date"))
    bases["_inception"] = F.min_by(price, known)
    year = F.when(F.col("date") > F.date_sub("latest", 365), F.col(price))
    extra = [F.max_by(volume, "date").alias("volume")] if volume else []
    rows = with_latest(df.select("symbol", "date", price, *([volume] if volume else [])), newest).groupBy("symbol").agg(
        F.max("latest").alias("latest"), F.max_by(price, "date").alias("price"), *extra, *[b.alias(n) for n, b in bases.items()],
        F.min(known).alias("start_inception"), F.min(year).alias("low_52_week"), F.max(year).alias("high_52_week"),
    )
    changes = {n: F.coalesce(percent_change(F.col("price"), F.col(f"_{n}")), F.lit(0.0)) for n in (*HORIZON_DAYS, "ytd_change")}
    returns = {f"perf_{n}": percent_change(F.col("price"), F.col(f"_{n}")) for n in (*starts, "inception")}
    dates = {f"start_{n}": start for n, start in starts.items()}
    return rows.withColumns({**changes, **returns, **dates}).drop(*bases).withColumnRenamed("latest", "date")


def weekly_close(df: DataFrame, price: str = "adj_close") -> DataFrame:
    """Last price of each week starting Monday."""
    return (
        df.groupBy("symbol", F.date_trunc("week", "date").cast("date").alias("week"))
        .agg(F.max("date").alias("date"), F.max_by(price, "date").alias(price))
    )


def rolling_sma(df: DataFrame, price: str = "adj_close", short: int = 10, long: int = 30) -> DataFrame:
    """Means of the last ``short`` and ``long`` rows."""
    return df.withColumns(
        {f"sma{short}": F.avg(price).over(trailing(short)), f"sma{long}": F.avg(price).over(trailing(long))}
    )


def trend_label(price: Column, short: Column, long: Column) -> Column:
    mixed = ((price > long) & (short < long)) | ((price < long) & (short > long))
    return (
        F.when(short.isNull() | long.isNull(), "Insufficient data")
        .when((price > long) & (short > long), "Uptrend")
        .when(mixed, "HOLD")
        .otherwise("Downtrend")
    )


def latest_trend(df: DataFrame, price: str = "adj_close", basis: str = "weekly") -> DataFrame:
    """Averages and label at each symbol's newest row, over weekly closes or daily rows."""
    rows = weekly_close(df, price) if basis == "weekly" else df.select("symbol", "date", price)
    newest = F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("date").desc()))
    # only the last 30 rows of a symbol can reach its newest average, and the limit applies before the shuffle
    recent = rows.withColumn("_n", newest).filter("_n <= 30")
    return recent.groupBy("symbol").agg(
        F.max_by(price, "date").alias("price"),
        F.avg(F.when(F.col("_n") <= 10, F.col(price))).alias("sma10"),
        F.avg(price).alias("sma30"),
    ).withColumn("trend", trend_label(F.col("price"), F.col("sma10"), F.col("sma30")))


def pct_change(df: DataFrame, value: str, out: str = "ret") -> DataFrame:
    """Relative change to the row before; a symbol's first row is dropped."""
    before = F.lag(value).over(by_date())
    return (
        df.withColumn("previous_date", F.lag("date").over(by_date()))
        .withColumn(out, F.try_divide(F.col(value), before) - 1)
        .filter(F.col("previous_date").isNotNull() & F.col(out).isNotNull())
    )


def month_last(df: DataFrame, value: str) -> DataFrame:
    """Last known value of each month from a symbol's first month to its last; months without one repeat the one before.

    ``known_by`` is the first month at or after with own rows: a slice that ends earlier does not hold the row.
    """
    found = df.groupBy("symbol", F.last_day("date").alias("month")).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col("date"))).alias(value)
    )
    span = F.sequence(F.trunc("first", "month"), F.trunc("final", "month"), F.expr("interval 1 month"))
    spine = (
        found.groupBy("symbol")
        .agg(F.min("month").alias("first"), F.max("month").alias("final"))
        .select("symbol", F.explode(span).alias("_m"))
        .select("symbol", F.last_day("_m").alias("month"))
    )
    own = found.withColumn("_own", F.col("month"))
    # one row per calendar month in these windows
    by_month = Window.partitionBy("symbol").orderBy("month")
    following = by_month.rowsBetween(0, Window.unboundedFollowing)
    return (
        spine.join(own, ["symbol", "month"], "left")
        .withColumn(value, F.last(value, ignorenulls=True).over(by_month))
        .withColumn("known_by", F.first("_own", ignorenulls=True).over(following))
        .drop("_own")
    )


def trailing_slice(df: DataFrame, cutoff: date, years: int) -> DataFrame:
    """Rows of the last ``365 * years + 1`` days, both ends included."""
    start = cutoff - timedelta(days=365 * years + 1)
    return df.filter(F.col("date").between(F.lit(start), F.lit(cutoff)))


def tail_n(df: DataFrame, keys: list[str], day: str, n: int) -> DataFrame:
    """The last ``n`` rows per key; the limit is applied map-side before the shuffle."""
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(day).desc()))
    return df.withColumn("_n", newest).filter(F.col("_n") <= n).drop("_n")


def rolling_stddev(df: DataFrame, value: str, rows: int = 756) -> DataFrame:
    """Sample deviation of the newest ``rows`` values per symbol; of all values where there are fewer, with ``complete`` false."""
    return (
        tail_n(df.select("symbol", "date", value), ["symbol"], "date", rows)
        .groupBy("symbol")
        .agg(F.max("date").alias("date"), F.count(value).alias("n"), F.stddev_samp(value).alias("std_dev"))
        .withColumn("complete", F.col("n") >= rows)
    )


def range_52_week(df: DataFrame, price: str = "adj_close") -> DataFrame:
    return (
        with_latest(df.select("symbol", "date", price))
        .filter(F.col("date") > F.date_sub("latest", 365))
        .groupBy("symbol")
        .agg(F.min(price).alias("low_52_week"), F.max(price).alias("high_52_week"))
    )


YEARS = (1, 3, 5, 10)


def _fall(points: Column, peak, trough, fall) -> Column:
    """Peak, trough and deepest fall from a running peak of ``points`` in date order, from those of each point (or piece) alone."""
    start = F.expr("named_struct('peak', CAST(NULL AS DOUBLE), 'trough', CAST(NULL AS DOUBLE), 'fall', CAST(NULL AS DOUBLE))")

    def add(seen: Column, x: Column) -> Column:
        # the deepest fall that crosses the border is from the peak so far to the piece's trough
        across = F.try_divide(trough(x), seen["peak"]) - 1
        return F.struct(
            F.greatest(seen["peak"], peak(x)).alias("peak"), F.least(seen["trough"], trough(x)).alias("trough"),
            F.least(seen["fall"], fall(x), across).alias("fall"),
        )

    return F.aggregate(points, start, add)


def month_pieces(df: DataFrame, price: str, years: tuple[int, ...] = YEARS, newest: DataFrame | None = None) -> DataFrame:
    """(symbol, month, inside, first, piece): each month's prices folded to peak, trough and deepest fall.

    A month is cut where a trailing window begins; ``inside`` counts the windows it lies in. Rows before the longest window and negative prices are left out
    before the shuffle. A symbol has at most 31 rows a month, so no task holds a history.
    """
    inside = sum((F.col("date") > F.add_months("latest", -12 * y)).cast("int") for y in years)
    rows = with_latest(df.select("symbol", "date", F.col(price).cast("double").alias("p")), newest).withColumn("inside", inside)
    days = F.sort_array(F.collect_list(F.struct("date", "p")))
    months = rows.filter((F.col("inside") > 0) & (F.col("p") >= 0)).groupBy("symbol", F.trunc("date", "month").alias("month"), "inside").agg(days.alias("days"))
    # a point falls from itself by 0, and a peak of 0 has no fall
    own = lambda x: F.try_divide(x["p"], x["p"]) - 1
    piece = _fall(F.col("days"), lambda x: x["p"], lambda x: x["p"], own)
    return months.select("symbol", "month", "inside", F.col("days")[0]["date"].alias("first"), piece.alias("piece"))


def max_drawdown(df: DataFrame, price: str = "adj_close", years: tuple[int, ...] = YEARS, newest: DataFrame | None = None) -> DataFrame:
    """Deepest fall from a running peak inside each trailing window ending at the symbol's newest date; a row for every symbol.

    Months are folded where they are gathered, then a symbol's pieces (12 a year and one more per window) are merged in date order.
    """
    newest = newest_dates(df) if newest is None else newest
    pieces = month_pieces(df, price, years, newest)
    ordered = F.sort_array(F.collect_list(F.struct("first", "inside", "piece")))
    folded = pieces.groupBy("symbol").agg(ordered.alias("pieces"))
    part = lambda name: lambda x: x["piece"][name]

    def window(y: int) -> Column:
        least = sum(other >= y for other in years)
        chosen = F.filter("pieces", lambda x: x["inside"] >= least)
        return _fall(chosen, part("peak"), part("trough"), part("fall"))["fall"].alias(f"max_drawdown_{y}y")

    return newest.select("symbol").join(folded.select("symbol", *[window(y) for y in years]), "symbol", "left")


def trailing_window_count(df: DataFrame, key: str, ts: str, seconds: int, limit: int, block: int = 3600) -> DataFrame:
    """Calls per key in the ``seconds`` before each second that has one, flagged at ``limit``.

    Calls are counted per second before the shuffle. Windows run inside blocks of ``block`` seconds; a second is copied into
    every later block whose windows reach back to it, so a hot key is split along time.
    """
    per_second = (
        df.groupBy(key, F.unix_timestamp(ts).alias("second")).agg(F.count("*").alias("calls"))
    )
    home = F.floor(F.col("second") / block)
    blocks = F.sequence(home, F.floor((F.col("second") + seconds) / block))
    spread = per_second.select(key, "second", "calls", home.alias("_home"), F.explode(blocks).alias("_block"))
    recent = Window.partitionBy(key, "_block").orderBy("second").rangeBetween(-seconds, 0)
    return (
        spread.withColumn("trailing_calls", F.sum("calls").over(recent))
        .filter("_home = _block")
        .select(key, "second", "calls", "trailing_calls", (F.col("trailing_calls") >= limit).alias("over_limit"))
    )


def carry_columns_history(scores: DataFrame, months: list[date], value: str) -> DataFrame:
    """Month x symbol matrix: one column per month label."""
    labels = [m.strftime("%Y-%m") for m in months]
    return (
        scores.withColumn("_month", F.date_format("cutoff", "yyyy-MM"))
        .groupBy("symbol")
        .pivot("_month", labels)
        .agg(F.first(value))
    )
