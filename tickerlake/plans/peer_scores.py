"""Peer-relative scores: every reference symbol against itself and its peers at each cut-off."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.functions.cleaning import all_true
from tickerlake.functions.measures import min_max_scale
from tickerlake.operators.asof import asof_latest_record, period_returns
from tickerlake.operators.calendar import date_array, day_horizons
from tickerlake.operators.joins import merge_frames, peer_group_expand
from tickerlake.operators.ranking import rank_across, value_positions
from tickerlake.operators.skew import join_groups, join_unique
from tickerlake.session import materialise

RATIO_METRICS = [
    "return_on_equity", "net_profit_margin", "operating_profit_margin", "debt_equity_ratio", "current_ratio",
    "interest_coverage", "price_earnings_ratio", "price_to_book_ratio", "price_earnings_to_growth_ratio",
]
GROWTH_METRICS = ["three_y_revenue_growth_per_share", "three_y_net_income_growth_per_share"]
RETURN_METRICS = ["return_1m", "return_ytd", "return_1y", "return_3y", "return_5y"]
METRICS = RATIO_METRICS + GROWTH_METRICS + RETURN_METRICS
LOWER_BETTER = {"debt_equity_ratio", "price_earnings_ratio", "price_to_book_ratio", "price_earnings_to_growth_ratio"}
HIGHER_BETTER = {m: m not in LOWER_BETTER for m in METRICS}


@dataclass(frozen=True)
class ScoreModel:
    """Weights per category and metric, and each category's share of the overall score."""

    categories: dict[str, dict[str, float]]
    category_max: dict[str, float]


def _model(profitability: tuple, growth: tuple, maxima: tuple) -> ScoreModel:
    categories = {
        "Profitability": dict(zip(RATIO_METRICS[:3], profitability)),
        "Price Performance": dict(zip(RETURN_METRICS, (1, 2, 5, 10, 7))),
        "Growth": dict(zip(GROWTH_METRICS, growth)),
        "Financial Strength": dict(zip(RATIO_METRICS[3:6], (10, 5, 5))),
        "Valuation": dict(zip(RATIO_METRICS[6:], (8, 6, 6))),
    }
    return ScoreModel(categories, dict(zip(categories, maxima)))


# The weights of the two score models.
MINMAX_MODEL = _model((6, 5, 4), (10, 10), (15, 25, 20, 20, 20))
PERCENTILE_MODEL = _model((12, 10, 8), (15, 15), (30, 25, 30, 20, 20))


def metric_frame(quotes: DataFrame, ratios: DataFrame, growth: DataFrame, cutoffs: list[date]) -> DataFrame:
    """All metrics per symbol and cut-off, computed once however many groups a symbol belongs to."""
    r = asof_latest_record(ratios, ["symbol"], "date", cutoffs, RATIO_METRICS).drop("record_date")
    g = asof_latest_record(growth, ["symbol"], "date", cutoffs, GROWTH_METRICS).drop("record_date")
    p = period_returns(quotes, "adj_close", {c: day_horizons(c) for c in cutoffs}).drop("current_price")
    return merge_frames([r, g, p], ["symbol", "cutoff"])


def group_metrics(members: DataFrame, metrics: DataFrame, cutoffs: list[date]) -> DataFrame:
    """(ref, symbol, cutoff, metrics) for every member and cut-off, also those without any metric."""
    dated = members.withColumn("cutoff", F.explode(date_array(cutoffs)))
    # a stored table on the other side lets a peer that most references list be split
    metrics = materialise(metrics, "metrics")
    # read by the extremes and again by the scores: written once instead of computed twice
    return materialise(dated.join(metrics, ["symbol", "cutoff"], "left"), "group-metrics")


def subscores_minmax(rows: DataFrame, group: list[str], higher_better: dict[str, bool]) -> DataFrame:
    """Directional 0..100 position of each metric in its group; ``rows`` is a stored table.

    Fewer than two values: 50 for all. A flat range: 50. A missing value: 0.
    """
    metrics = list(higher_better)
    stats = rows.groupBy(*group).agg(
        *[F.count(m).alias(f"_n_{m}") for m in metrics],
        *[F.min(m).alias(f"_lo_{m}") for m in metrics],
        *[F.max(m).alias(f"_hi_{m}") for m in metrics],
    )

    def score(m: str):
        value, n, lo, hi = F.col(m), F.col(f"_n_{m}"), F.col(f"_lo_{m}"), F.col(f"_hi_{m}")
        gap = value - lo if higher_better[m] else hi - value
        return (
            F.when(n < 2, 50.0).when(value.isNull(), 0.0).when(lo == hi, 50.0).otherwise(gap * 100 / (hi - lo))
        )

    joined = join_unique(rows, stats, group, "symbol")
    return joined.withColumns({m: score(m) for m in metrics}).select(*rows.columns)


#: Rows of a group whose members are compared in one row, and of one that a task ranks whole. Larger groups are spread over tasks.
COMPARED, RANKED_WHOLE = 64, 10_000


def _by_size(rows: DataFrame, group: list[str], most: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the groups of at most ``most`` rows, and those of larger ones, if there are any."""
    large = materialise(rows.groupBy(*group).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(*group), "large-groups")
    if large.isEmpty():
        return rows, None
    return join_groups(rows, large, group, "left_anti"), join_groups(rows, large, group, "left_semi")


def subscores_percentile(rows: DataFrame, group: list[str], key: str, higher_better: dict[str, bool]) -> DataFrame:
    """Share of the group's values that a value equals or beats, times 100; a missing value scores 0. Rows of one key have its best score."""
    small, large = _by_size(rows, group, COMPARED)
    found = _compared_percentile(small, group, key, higher_better)
    return found if large is None else found.unionByName(_spread_percentile(large, group, key, higher_better))


def _compared_percentile(rows: DataFrame, group: list[str], key: str, higher_better: dict[str, bool]) -> DataFrame:
    """``subscores_percentile`` for small groups: one shuffle of the rows, then each member is compared with the others of its group."""
    metrics = list(higher_better)
    directed = [(F.col(m) if higher_better[m] else -F.col(m)).alias(m) for m in metrics]
    members = rows.groupBy(*group).agg(
        F.collect_list(F.struct(F.col(key), *directed)).alias("_m"), F.count_distinct(key).alias("_keys"), *[F.count(m).alias(f"_n_{m}") for m in metrics])
    known = all_true([F.col(c).isNotNull() for c in group])

    def score(r: Column, m: str) -> Column:
        best = F.array_max(F.transform(F.filter("_m", lambda o: o[key] == r[key]), lambda o: o[m]))
        value = F.when(F.col("_keys") == F.size("_m"), r[m]).otherwise(best)
        share = F.size(F.filter("_m", lambda o: o[m] <= value)) / F.col(f"_n_{m}") * 100
        return F.when(known & r[key].isNotNull() & value.isNotNull(), share).otherwise(0.0).alias(m)

    return members.select(*group, F.inline(F.transform("_m", lambda r: F.struct(r[key].alias(key), *[score(r, m) for m in metrics]))))


def _spread_percentile(rows: DataFrame, group: list[str], key: str, higher_better: dict[str, bool]) -> DataFrame:
    """``subscores_percentile`` for groups of any size."""
    metrics = list(higher_better)
    directed = [
        F.struct(F.lit(m).alias("metric"), (F.col(m) if higher_better[m] else -F.col(m)).alias("value")) for m in metrics
    ]
    long = rows.select(*group, key, F.inline(F.array(*directed))).filter("value IS NOT NULL")
    share = value_positions(long, [*group, "metric"], "value").withColumn("_s", F.col("n_up_to") / F.col("n_all") * 100)
    scored = long.join(share.select(*group, "metric", "value", "_s"), [*group, "metric", "value"])
    wide = scored.groupBy(*group, key).agg(*[F.max(F.when(F.col("metric") == m, F.col("_s"))).alias(m) for m in metrics])
    filled = {m: F.coalesce(F.col(m), F.lit(0.0)) for m in metrics}
    return rows.select(*group, key).join(wide, [*group, key], "left").withColumns(filled)


def _sum(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def category_scores(sub: DataFrame, model: ScoreModel) -> DataFrame:
    """Weighted mean per category, and the overall score from the categories."""
    cats = {
        c: _sum([F.col(m) * float(w) for m, w in weights.items()]) / float(sum(weights.values()))
        for c, weights in model.categories.items()
    }
    with_cats = sub.withColumns(cats)
    total = float(sum(model.category_max.values()))
    overall = _sum([F.col(c) / 100 * float(top) for c, top in model.category_max.items()]) / total * 100
    return with_cats.withColumn("Overall", overall).select("ref", "symbol", "cutoff", *cats, "Overall")


def _ranked(scores: DataFrame, categories: list[str]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("score")) for c in categories])
    order = [F.col("score").desc(), F.col("symbol")]
    group = ["ref", "cutoff"]

    def long(rows: DataFrame) -> DataFrame:
        return rows.select("ref", "symbol", "cutoff", F.inline(entries))

    scores = materialise(scores.select(*group, "symbol", *categories), "scores")
    small, large = _by_size(scores, group, RANKED_WHOLE)
    # a group is brought together before its rows are multiplied
    ranked = long(small.repartition(*group)).withColumn("rank", F.row_number().over(Window.partitionBy(*group, "category").orderBy(*order)).cast("bigint"))
    return ranked if large is None else ranked.unionByName(rank_across(long(large), [*group, "category"], order, "rank"))


def peer_scores_minmax(
    quotes: DataFrame, ratios: DataFrame, growth: DataFrame, peers: DataFrame, profile: DataFrame, cutoffs: list[date],
    model: ScoreModel = MINMAX_MODEL,
) -> DataFrame:
    """(ref, symbol, cutoff, category, score, rank): min-max scores, normalised again inside each group."""
    members = peer_group_expand(peers, profile)
    rows = group_metrics(members, metric_frame(quotes, ratios, growth, cutoffs), cutoffs)
    raw = materialise(category_scores(subscores_minmax(rows, ["ref", "cutoff"], HIGHER_BETTER), model), "category-scores")
    names = [*model.categories, "Overall"]
    extremes = raw.groupBy("ref", "cutoff").agg(
        *[F.min(c).alias(f"_lo_{c}") for c in names], *[F.max(c).alias(f"_hi_{c}") for c in names]
    )
    scaled = {c: min_max_scale(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}")) for c in names}
    return _ranked(join_unique(raw, extremes, ["ref", "cutoff"], "symbol").withColumns(scaled), names)


def peer_scores_percentile(
    quotes: DataFrame, ratios: DataFrame, growth: DataFrame, peers: DataFrame, profile: DataFrame, cutoffs: list[date],
    model: ScoreModel = PERCENTILE_MODEL,
) -> DataFrame:
    """Same shape from percentile subscores, without the final normalisation."""
    members = peer_group_expand(peers, profile)
    rows = group_metrics(members, metric_frame(quotes, ratios, growth, cutoffs), cutoffs)
    sub = subscores_percentile(rows, ["ref", "cutoff"], "symbol", HIGHER_BETTER)
    return _ranked(category_scores(sub, model), [*model.categories, "Overall"])
