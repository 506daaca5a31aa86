"""Peer lists and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerlake.operators import similarity
from tickerlake.plans import peer_scores as ps, peers as peer_plans, universe_scores as us
from tickerlake.registry.core import query
from tickerlake.registry.relational import GROUPS, mean_2
from tickerlake.registry.timeseries import AS_OF, CUTOFFS, DAY_BASES, MONTH_BASES, month_end_list, returns_sql
from tickerlake.sources import views as v

EQUITY_PAIRS = """pairs AS (SELECT a.symbol, b.symbol AS peer_symbol,
    CASE WHEN a.mkt_cap IS NULL OR a.mkt_cap = b.mkt_cap THEN 0 ELSE abs(ln(b.mkt_cap / a.mkt_cap)) END AS distance
    FROM company a JOIN company b ON a.sector = b.sector AND a.industry = b.industry AND a.currency = b.currency
    AND a.symbol <> b.symbol AND (a.mkt_cap IS NULL OR b.mkt_cap BETWEEN a.mkt_cap * 0.5 AND a.mkt_cap * 2.0))"""
FUND_PAIRS = """pairs AS (SELECT a.symbol, b.symbol AS peer_symbol,
    CASE WHEN a.aum IS NOT NULL THEN CASE WHEN a.aum = b.aum THEN 0 ELSE abs(ln(b.aum / a.aum)) END
         WHEN a.expense_ratio IS NOT NULL THEN CASE WHEN a.expense_ratio = b.expense_ratio THEN 0
              ELSE abs(ln(b.expense_ratio / a.expense_ratio)) END ELSE 0 END AS distance
    FROM etf_profile a JOIN etf_profile b ON a.currency = b.currency AND a.domicile = b.domicile AND a.asset_class = b.asset_class
    AND a.symbol <> b.symbol AND (a.expense_ratio IS NULL OR b.expense_ratio BETWEEN a.expense_ratio * 0.8 AND a.expense_ratio * 1.2)
    AND (a.aum IS NULL OR b.aum BETWEEN a.aum * 0.5 AND a.aum * 2.0))"""


def nearest(condition: str = "true") -> str:
    return f"""SELECT symbol, peer_symbol, row_number() OVER (PARTITION BY symbol ORDER BY distance, peer_symbol) AS rank
    FROM pairs WHERE {condition} QUALIFY rank <= 10"""


def few(edges: str) -> str:
    return f"""symbol IN (SELECT symbol FROM {edges} GROUP BY 1 HAVING count(peer_symbol) <= 3)
    AND (symbol, peer_symbol) NOT IN (SELECT (symbol, peer_symbol) FROM {edges})"""


PEERS_OUT = "symbol peer_symbol rank:i"


@query("range_join_peer_similarity", PEERS_OUT, "company", nearest(), EQUITY_PAIRS)
def _(spark, sf):
    company = v.company(spark, sf)
    return similarity.similar_by_size(company, company, peer_plans.EQUITY_CLASS, "mkt_cap")


@query("range_join_etf_similarity", PEERS_OUT, "etf_profile", nearest(), FUND_PAIRS)
def _(spark, sf):
    funds = v.etf_profile(spark, sf)
    return similarity.similar_funds(funds, funds, peer_plans.FUND_CLASS)


@query("peers_from_bulk", "symbol peer_symbol:i", "company company_peers profile",
       "SELECT DISTINCT symbol, peer_symbol FROM company_peers WHERE symbol IN (SELECT symbol FROM profile)")
def _(spark, sf):
    lists = v.company_peers(spark, sf).groupBy("symbol").agg(
        F.concat_ws(", ,", F.collect_list(F.col("peer_symbol").cast("string"))).alias("peers"))
    return peer_plans.peers_from_bulk(lists, v.profile(spark, sf))


@query("peers_boost_equity", PEERS_OUT, "company company_peers", nearest(few("company_peers")), EQUITY_PAIRS)
def _(spark, sf):
    return peer_plans.peers_boost_equity(v.company(spark, sf), v.company_peers(spark, sf))


@query("peers_boost_etf", PEERS_OUT, "etf_profile etf_peers", nearest(few("etf_peers")), FUND_PAIRS)
def _(spark, sf):
    return peer_plans.peers_boost_etf(v.etf_profile(spark, sf), v.etf_peers(spark, sf))


# ---- peer scores

RATIOS_AT = """ratios_at AS (SELECT * FROM (SELECT r.*, cutoff FROM ratios r, cutoffs WHERE date <= cutoff)
    QUALIFY row_number() OVER (PARTITION BY symbol, cutoff ORDER BY date DESC) = 1)"""
GROWTH_AT = """growth_at AS (SELECT * FROM (SELECT g.*, cutoff FROM growth g, cutoffs WHERE date <= cutoff)
    QUALIFY row_number() OVER (PARTITION BY symbol, cutoff ORDER BY date DESC) = 1)"""
METRICS_SQL = ", ".join(ps.METRICS)
MEMBER_METRICS = f"""{AS_OF}, {CUTOFFS}, {GROUPS}, {RATIOS_AT}, {GROWTH_AT}, returns AS ({returns_sql(DAY_BASES)}),
    rows AS (SELECT ref, m.symbol, c.cutoff, {METRICS_SQL} FROM members m CROSS JOIN cutoffs c
    LEFT JOIN ratios_at r ON m.symbol = r.symbol AND c.cutoff = r.cutoff
    LEFT JOIN growth_at g ON m.symbol = g.symbol AND c.cutoff = g.cutoff
    LEFT JOIN returns p ON m.symbol = p.symbol AND c.cutoff = p.cutoff)"""


def _minmax_sub(m: str) -> str:
    gap = f"max({m}) OVER g - {m}" if m in ps.LOWER_BETTER else f"{m} - min({m}) OVER g"
    return f"""CASE WHEN count({m}) OVER g < 2 THEN 50.0 WHEN {m} IS NULL THEN 0.0 WHEN max({m}) OVER g = min({m}) OVER g THEN 50.0
    ELSE ({gap}) * 100 / (max({m}) OVER g - min({m}) OVER g) END AS {m}"""


def _percentile_sub(m: str) -> str:
    beaten = ">=" if m in ps.LOWER_BETTER else "<="
    return f"""CASE WHEN {m} IS NULL THEN 0.0 ELSE (SELECT count(*) FROM rows o WHERE o.ref = rows.ref AND o.cutoff = rows.cutoff
    AND o.{m} {beaten} rows.{m}) / count({m}) OVER g * 100 END AS {m}"""


def _category(model: ps.ScoreModel) -> str:
    parts = []
    for name, weights in model.categories.items():
        total = " + ".join(f"{m} * {float(w)}::DOUBLE" for m, w in weights.items())
        parts.append(f'({total}) / {float(sum(weights.values()))}::DOUBLE AS "{name}"')
    return "SELECT ref, symbol, cutoff, " + ", ".join(parts) + " FROM subs"


def _overall(model: ps.ScoreModel) -> str:
    terms = " + ".join(f'"{c}" / 100 * {float(t)}::DOUBLE' for c, t in model.category_max.items())
    return f'SELECT *, ({terms}) / {float(sum(model.category_max.values()))}::DOUBLE * 100 AS "Overall" FROM cats'


NAMES = [*ps.MINMAX_MODEL.categories, "Overall"]


def _scores(sub, model: ps.ScoreModel, scale: bool) -> str:
    def score(c: str) -> str:
        if not scale:
            return f'"{c}"'
        return f"""CASE WHEN max("{c}") OVER g = min("{c}") OVER g THEN 50.0
        ELSE ("{c}" - min("{c}") OVER g) / (max("{c}") OVER g - min("{c}") OVER g) * 100 END"""

    long = " UNION ALL ".join(
        f"SELECT ref, symbol, cutoff, '{c}' AS category, {score(c)} AS score FROM overall WINDOW g AS (PARTITION BY ref, cutoff)"
        for c in NAMES)
    subs = ", ".join(sub(m) for m in ps.METRICS)
    return f"""{MEMBER_METRICS}, subs AS (SELECT ref, symbol, cutoff, {subs} FROM rows WINDOW g AS (PARTITION BY ref, cutoff)),
    cats AS ({_category(model)}), overall AS ({_overall(model)}), long AS ({long})"""


RANKED = "SELECT *, row_number() OVER (PARTITION BY ref, cutoff, category ORDER BY score DESC, symbol) AS rank FROM long"
SCORES_OUT = "ref symbol cutoff:d category score:6 rank:i"


def _score_inputs(spark, sf):
    return (
        v.quotes(spark, sf), v.ratios(spark, sf), v.growth(spark, sf), v.peers(spark, sf), v.profile(spark, sf),
        month_end_list(spark, sf),
    )


@query("peer_scores_minmax", SCORES_OUT, "quotes profile peers ratios growth", RANKED,
       _scores(_minmax_sub, ps.MINMAX_MODEL, True))
def _(spark, sf):
    return ps.peer_scores_minmax(*_score_inputs(spark, sf))


@query("peer_scores_percentile", SCORES_OUT, "quotes profile peers ratios growth", RANKED,
       _scores(_percentile_sub, ps.PERCENTILE_MODEL, False))
def _(spark, sf):
    return ps.peer_scores_percentile(*_score_inputs(spark, sf))


@query("weighted_category_score", "ref symbol cutoff:d profitability:6 valuation:6", "quotes profile peers ratios growth",
       'SELECT *, "Profitability" AS profitability, "Valuation" AS valuation FROM overall',
       _scores(_minmax_sub, ps.MINMAX_MODEL, False))
def _(spark, sf):
    raw = _raw_categories(spark, sf)
    return raw.select("ref", "symbol", "cutoff", F.col("Profitability").alias("profitability"), F.col("Valuation").alias("valuation"))


@query("overall_score", "ref symbol cutoff:d overall:6", "quotes profile peers ratios growth",
       'SELECT *, "Overall" AS overall FROM overall', _scores(_minmax_sub, ps.MINMAX_MODEL, False))
def _(spark, sf):
    return _raw_categories(spark, sf).select("ref", "symbol", "cutoff", F.col("Overall").alias("overall"))


def _raw_categories(spark, sf):
    quotes, ratios, growth, peers, profile, cutoffs = _score_inputs(spark, sf)
    members = ps.peer_group_expand(peers, profile)
    rows = ps.group_metrics(members, ps.metric_frame(quotes, ratios, growth, cutoffs), cutoffs)
    return ps.category_scores(ps.subscores_minmax(rows, ["ref", "cutoff"], ps.HIGHER_BETTER), ps.MINMAX_MODEL)


# ---- universe scores


def _mean(*terms: str) -> str:
    total = " + ".join(f"coalesce({t}, 0)" for t in terms)
    count = " + ".join(f"(({t}) IS NOT NULL)::INT" for t in terms)
    return f"({total}) / nullif({count}, 0)"


KEYS_AT = """keys_at AS (SELECT * FROM (SELECT k.*, cutoff FROM key_metrics k, cutoffs WHERE date <= cutoff)
    QUALIFY row_number() OVER (PARTITION BY symbol, cutoff ORDER BY date DESC) = 1)"""
RAW_SQL = {
    "growth": _mean("revenue_growth * 100", "-price_earnings_to_growth_ratio"),
    "valuation": _mean("-price_earnings_ratio", "-price_to_book_ratio", "-price_earnings_to_growth_ratio"),
    "financial_strength": _mean("-debt_equity_ratio", "current_ratio", "interest_coverage"),
    "profitability": "CASE WHEN r.symbol IS NOT NULL AND k.symbol IS NOT NULL THEN "
    + _mean("roe * 100", "net_profit_margin * 100", "operating_profit_margin * 100") + " END",
    "performance": _mean("return_1m", "return_ytd", "return_1y", "return_3y", "return_5y"),
}
AT = f"{AS_OF}, {CUTOFFS}, {RATIOS_AT}, {GROWTH_AT}, {KEYS_AT}, returns AS ({returns_sql(MONTH_BASES)})"
RAW_ROWS = "raw AS (SELECT u.symbol, c.cutoff, " + ", ".join(f"{e} AS {n}" for n, e in RAW_SQL.items()) + """
    FROM (SELECT symbol FROM profile UNION SELECT peer_symbol FROM peers) u CROSS JOIN cutoffs c
    LEFT JOIN ratios_at r ON u.symbol = r.symbol AND c.cutoff = r.cutoff
    LEFT JOIN growth_at g ON u.symbol = g.symbol AND c.cutoff = g.cutoff
    LEFT JOIN keys_at k ON u.symbol = k.symbol AND c.cutoff = k.cutoff
    LEFT JOIN returns p ON u.symbol = p.symbol AND c.cutoff = p.cutoff)"""


def _norm(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN NULL WHEN max({c}) OVER d = min({c}) OVER d THEN 50.0
    ELSE least(greatest(({c} - min({c}) OVER d) / (max({c}) OVER d - min({c}) OVER d) * 100, 0), 100) END AS {c}"""


UNIVERSE = f"""{AT}, {RAW_ROWS}, norms AS (SELECT symbol, cutoff, {', '.join(_norm(c) for c in us.RAW)} FROM raw
    WINDOW d AS (PARTITION BY cutoff)), averaged AS (SELECT *, {_mean(*us.RAW)} AS composite FROM norms),
    final AS (SELECT symbol, cutoff, {', '.join(us.RAW)}, {_norm('composite')} FROM averaged WINDOW d AS (PARTITION BY cutoff)),
    scores AS (SELECT symbol, date, score_type, round(score, 2) AS score, rank FROM (SELECT symbol, cutoff AS date, score_type, score,
    row_number() OVER (PARTITION BY cutoff, score_type ORDER BY score DESC NULLS LAST, symbol) AS rank FROM
    (""" + " UNION ALL ".join(
    f"SELECT symbol, cutoff, '{c}' AS score_type, {c} AS score FROM final" for c in [*us.RAW, "composite"]) + """))
    WHERE symbol IN (SELECT symbol FROM profile))"""
UNIVERSE_VIEWS = "quotes profile peers ratios growth key_metrics"


def _universe(spark, sf):
    return us.universe_scores(
        v.quotes(spark, sf), v.ratios(spark, sf), v.growth(spark, sf), v.key_metrics(spark, sf), v.peers(spark, sf),
        v.profile(spark, sf), month_end_list(spark, sf))


@query("universe_scores", "symbol date:d score_type score:2 rank:i", UNIVERSE_VIEWS, "SELECT * FROM scores", UNIVERSE)
def _(spark, sf):
    return _universe(spark, sf)


@query("score_group_averages", "group_type group_name score_type avg_score:2 calculation_date:d", UNIVERSE_VIEWS,
       f"""SELECT 'sector' AS group_type, sector AS group_name, score_type, {mean_2('score')} AS avg_score,
       (SELECT d FROM as_of) AS calculation_date FROM newest JOIN profile USING (symbol) GROUP BY sector, score_type UNION ALL
       SELECT 'industry', industry, score_type, {mean_2('score')}, (SELECT d FROM as_of) FROM newest JOIN profile USING (symbol)
       GROUP BY industry, score_type""",
       f"{UNIVERSE}, newest AS (SELECT * FROM scores WHERE date = (SELECT max(cutoff) FROM cutoffs) AND score IS NOT NULL)")
def _(spark, sf):
    return us.score_group_averages(_universe(spark, sf), v.profile(spark, sf), month_end_list(spark, sf)[-1])


def _raw(name: str, source: str, where: str, build) -> None:
    @query(f"raw_{name}", f"symbol cutoff:d {source}:6", UNIVERSE_VIEWS,
           f"SELECT * FROM raw WHERE (symbol, cutoff) IN (SELECT (symbol, cutoff) FROM {where})", f"{AT}, {RAW_ROWS}")
    def _(spark, sf):
        return build(spark, sf, month_end_list(spark, sf))


_raw("growth", "growth", "(SELECT symbol, cutoff FROM ratios_at UNION SELECT symbol, cutoff FROM growth_at)",
     lambda s, sf, c: us.raw_growth(v.ratios(s, sf), v.growth(s, sf), c))
_raw("valuation", "valuation", "ratios_at", lambda s, sf, c: us.raw_valuation(v.ratios(s, sf), c))
_raw("strength", "financial_strength", "ratios_at", lambda s, sf, c: us.raw_strength(v.ratios(s, sf), c))
_raw("profitability", "profitability", "(SELECT r.symbol, r.cutoff FROM ratios_at r JOIN keys_at k USING (symbol, cutoff))",
     lambda s, sf, c: us.raw_profitability(v.ratios(s, sf), v.key_metrics(s, sf), c))
_raw("performance", "performance", "returns", lambda s, sf, c: us.raw_performance(v.quotes(s, sf), c))
