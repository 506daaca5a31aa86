"""Universe-relative scores: five raw scores and their composite, normalised over all symbols of a date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.functions.measures import mean_of
from tickerlake.operators.aggregates import avg_score_by_group, minmax_normalise_universe
from tickerlake.operators.asof import asof_latest_record, period_returns
from tickerlake.operators.calendar import calendar_horizons, date_array
from tickerlake.operators.joins import merge_frames
from tickerlake.operators.ranking import rank_across
from tickerlake.operators.upsert import union_universe
from tickerlake.session import materialise

KEY = ["symbol", "cutoff"]
RAW = ["growth", "valuation", "financial_strength", "profitability", "performance"]
RATIO_COLUMNS = [
    "debt_equity_ratio", "current_ratio", "interest_coverage", "price_earnings_ratio", "price_to_book_ratio",
    "price_earnings_to_growth_ratio", "net_profit_margin", "operating_profit_margin",
]


def _ratios(ratios: DataFrame, cutoffs: list[date], columns: list[str] | None = None) -> DataFrame:
    return asof_latest_record(ratios, ["symbol"], "date", cutoffs, columns or RATIO_COLUMNS).drop("record_date")


def growth_score():
    return mean_of(F.col("revenue_growth") * 100, -F.col("price_earnings_to_growth_ratio"))


def valuation_score():
    return mean_of(*[-F.col(c) for c in ("price_earnings_ratio", "price_to_book_ratio", "price_earnings_to_growth_ratio")])


def strength_score():
    return mean_of(-F.col("debt_equity_ratio"), F.col("current_ratio"), F.col("interest_coverage"))


def profitability_score():
    return mean_of(*[F.col(c) * 100 for c in ("roe", "net_profit_margin", "operating_profit_margin")])


def raw_growth(ratios: DataFrame, growth: DataFrame, cutoffs: list[date]) -> DataFrame:
    r = _ratios(ratios, cutoffs, ["price_earnings_to_growth_ratio"])
    g = asof_latest_record(growth, ["symbol"], "date", cutoffs, ["revenue_growth"]).drop("record_date")
    return r.join(g, KEY, "full").select(*KEY, growth_score().alias("growth"))


def raw_valuation(ratios: DataFrame, cutoffs: list[date]) -> DataFrame:
    return _ratios(ratios, cutoffs, RATIO_COLUMNS[3:6]).select(*KEY, valuation_score().alias("valuation"))


def raw_strength(ratios: DataFrame, cutoffs: list[date]) -> DataFrame:
    return _ratios(ratios, cutoffs, RATIO_COLUMNS[:3]).select(*KEY, strength_score().alias("financial_strength"))


def raw_profitability(ratios: DataFrame, key_metrics: DataFrame, cutoffs: list[date]) -> DataFrame:
    """Only where a ratio row and a key-metrics row both exist as of the cut-off."""
    k = asof_latest_record(key_metrics, ["symbol"], "date", cutoffs, ["roe"]).drop("record_date")
    both = _ratios(ratios, cutoffs, RATIO_COLUMNS[6:]).join(k, KEY)
    return both.select(*KEY, profitability_score().alias("profitability"))


def raw_performance(quotes: DataFrame, cutoffs: list[date]) -> DataFrame:
    returns = period_returns(quotes, "adj_close", {c: calendar_horizons(c) for c in cutoffs})
    names = [c for c in returns.columns if c.startswith("return_")]
    return returns.select(*KEY, mean_of(*[F.col(n) for n in names]).alias("performance"))


def raw_scores(
    quotes: DataFrame, ratios: DataFrame, growth: DataFrame, key_metrics: DataFrame, cutoffs: list[date],
    universe: DataFrame | None = None,
) -> DataFrame:
    """All five raw scores per symbol and cut-off; the ratios are looked up once for four of them.

    With ``universe`` (symbol, cutoff) the result has exactly its rows.
    """
    r = _ratios(ratios, cutoffs).withColumn("_has_ratio", F.lit(True))
    g = asof_latest_record(growth, ["symbol"], "date", cutoffs, ["revenue_growth"]).drop("record_date")
    k = asof_latest_record(key_metrics, ["symbol"], "date", cutoffs, ["roe"]).drop("record_date")
    frames = [r, g, k.withColumn("_has_key", F.lit(True)), raw_performance(quotes, cutoffs)]
    if universe is not None:
        frames.append(universe.select(*KEY, F.lit(True).alias("_listed")))
    merged = merge_frames(frames, KEY)
    if universe is not None:
        merged = merged.filter("_listed")
    return merged.select(
        *KEY,
        growth_score().alias("growth"),
        valuation_score().alias("valuation"),
        strength_score().alias("financial_strength"),
        F.when(F.col("_has_ratio") & F.col("_has_key"), profitability_score()).alias("profitability"),
        "performance",
    )


def universe_scores(
    quotes: DataFrame, ratios: DataFrame, growth: DataFrame, key_metrics: DataFrame, peers: DataFrame,
    profile: DataFrame, cutoffs: list[date], composite: str = "composite",
) -> DataFrame:
    """(symbol, date, score_type, score, rank) of the profile's symbols, ranked among profile and peers.

    ``composite`` names the score type of the mean of the five.
    """
    universe = union_universe(profile, peers).withColumn("cutoff", F.explode(date_array(cutoffs)))
    raw = raw_scores(quotes, ratios, growth, key_metrics, cutoffs, universe)
    # read by two rounds of extremes and the result: written once
    raw = materialise(raw, "raw-scores")
    norms = minmax_normalise_universe(raw, "cutoff", RAW)
    averaged = norms.withColumn(composite, mean_of(*[F.col(c) for c in RAW]))
    final = minmax_normalise_universe(averaged, "cutoff", [composite])
    types = F.array(*[F.struct(F.lit(t).alias("score_type"), F.col(t).alias("score")) for t in [*RAW, composite]])
    long = final.select("symbol", F.col("cutoff").alias("date"), F.inline(types))
    ranked = rank_across(long, ["date", "score_type"], [F.col("score").desc_nulls_last(), F.col("symbol")], "rank")
    listed = ranked.join(profile.select("symbol"), "symbol", "left_semi")
    return listed.withColumn("score", F.round("score", 2).cast("decimal(5,2)"))


def score_group_averages(scores: DataFrame, profile: DataFrame, calculation_date: date) -> DataFrame:
    """Sector and industry means of the newest scores, stamped with the calculation date."""
    return avg_score_by_group(scores, profile).withColumn("calculation_date", F.lit(calculation_date))
