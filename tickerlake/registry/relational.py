"""Join, aggregate, ranking and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerlake.operators import aggregates as agg, joins, nested, timeseries as ts, topk, upsert
from tickerlake.registry.core import query
from tickerlake.registry.timeseries import LATEST, PERFORMANCE, month_end_list, trend
from tickerlake.session import materialise
from tickerlake.sources import views as v

# ---- joins


@query("join_scores_profile", "symbol company_name sector ytd_change:6", "quotes profile",
       f"SELECT * FROM ({PERFORMANCE}) JOIN profile USING (symbol)", LATEST)
def _(spark, sf):
    return joins.join_scores_profile(ts.price_performance(v.quotes(spark, sf)), v.profile(spark, sf))


@query("semi_join_universe", "symbol date:d adj_close:6", "quotes peers",
       "SELECT * FROM quotes WHERE symbol IN (SELECT symbol FROM peers)")
def _(spark, sf):
    return joins.semi_join_universe(v.quotes(spark, sf), v.peers(spark, sf))


@query("anti_join_existing", "symbol peer_symbol", "company company_peers",
       """SELECT symbol, symbol + 5 AS peer_symbol FROM company WHERE (symbol, symbol + 5) NOT IN
       (SELECT (symbol, peer_symbol) FROM company_peers)""")
def _(spark, sf):
    candidates = v.company(spark, sf).select("symbol", (F.col("symbol") + 5).alias("peer_symbol"))
    return joins.anti_join_existing(candidates, v.company_peers(spark, sf), ["symbol", "peer_symbol"])


@query("left_join_by_symbol", "sector rank:i symbol company_name price:6 day_change:6 trend", "quotes profile",
       f"""SELECT sector, rank, t.symbol, company_name, p.price, day_change, trend FROM
       (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY mkt_cap DESC, symbol) AS rank FROM profile WHERE mkt_cap > 0 AND sector IS NOT NULL) t
       LEFT JOIN ({PERFORMANCE}) p ON t.symbol = p.symbol LEFT JOIN ({trend('quotes')}) d ON t.symbol = d.symbol""", LATEST)
def _(spark, sf):
    ranked = topk.rank_in_sector(v.profile(spark, sf))
    perf = ts.price_performance(v.quotes(spark, sf))
    trends = ts.latest_trend(v.quotes(spark, sf), basis="daily").select("symbol", "trend")
    return ranked.join(perf, "symbol", "left").join(trends, "symbol", "left")


@query("merge_right_biased", "symbol company_name sector mkt_cap:6", "profile company",
       """SELECT c.symbol, c.company_name, c.sector, c.mkt_cap FROM profile p JOIN company c ON p.symbol = c.symbol""")
def _(spark, sf):
    return joins.merge_right_biased(v.profile(spark, sf), v.company(spark, sf))


@query("merge_profile_quote", "symbol company_name country market_cap:6 current_price:6 volume:i", "quotes company",
       """SELECT c.symbol, coalesce(company_name, '') AS company_name, 'US' AS country,
       coalesce(nullif(mkt_cap, 0), q.adj_close * 10) AS market_cap, q.adj_close AS current_price, q.volume
       FROM company c LEFT JOIN (SELECT * FROM quotes QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1) q
       ON c.symbol = q.symbol""")
def _(spark, sf):
    newest = ts.last_per_key(v.quotes(spark, sf), ["symbol"], "date", ["adj_close", "volume"])
    quotes = newest.select(
        "symbol", (F.col("adj_close") * 10).alias("market_cap"), F.col("adj_close").alias("price"),
        F.lit(None).cast("double").alias("change_percentage"), "volume")
    profiles = v.company(spark, sf).withColumn("country", F.lit(None).cast("string"))
    return joins.merge_profile_quote(profiles, quotes)


GROUPS = """edges AS (SELECT DISTINCT symbol AS ref, peer_symbol AS symbol FROM peers WHERE peer_symbol <> symbol
    AND symbol IN (SELECT symbol FROM profile)), members AS (SELECT * FROM edges UNION SELECT ref, ref FROM edges)"""


@query("peer_group_expand", "ref symbol", "profile peers", "SELECT * FROM members", GROUPS)
def _(spark, sf):
    return joins.peer_group_expand(v.peers(spark, sf), v.profile(spark, sf))


SECTOR_PARENTS = {"XAF": "AFRICA", "XAM": "AMERICA", "XAS": "ASIA", "XEU": "EUROPE", "XME": "MIDDLE EAST"}
PARENTS_SQL = "parents(parent_symbol, sector) AS (VALUES " + ", ".join(f"('{p}', '{s}')" for p, s in SECTOR_PARENTS.items()) + ")"
# list parents: two currency indexes next to the sector parents
CONSTITUENTS = """constituents AS (SELECT parent_symbol, symbol FROM profile JOIN parents USING (sector)
    UNION ALL SELECT CASE currency WHEN 'USD' THEN 'SPY' ELSE 'XIU' END, symbol FROM profile)"""


def constituents(spark, sf):
    profile = v.profile(spark, sf)
    lists = profile.select(F.when(F.col("currency") == "USD", "SPY").otherwise("XIU").alias("parent_symbol"), "symbol")
    return joins.constituents_expand(SECTOR_PARENTS, profile, lists)


@query("constituents_expand", "parent_symbol symbol", "profile", "SELECT * FROM constituents", f"{PARENTS_SQL}, {CONSTITUENTS}")
def _(spark, sf):
    return constituents(spark, sf)


@query("join_data_quotes_identifier", "identifier company_name date:d navps:6", "quotes company",
       "SELECT c.symbol AS identifier, company_name, date, adj_close AS navps FROM company c JOIN quotes q ON c.symbol = q.symbol")
def _(spark, sf):
    data = v.company(spark, sf).select(F.col("symbol").alias("identifier"), "company_name")
    quotes = v.quotes(spark, sf).select(F.col("symbol").alias("identifier"), "date", F.col("adj_close").alias("navps"))
    return joins.join_by_identifier(data, quotes)


# ---- aggregates


@query("peer_count_having", "symbol peer_count:i", "company_peers",
       "SELECT symbol, count(peer_symbol) AS peer_count FROM company_peers GROUP BY 1 HAVING count(peer_symbol) <= 3")
def _(spark, sf):
    return agg.peer_count_having(v.company_peers(spark, sf))


RATIO_TYPES = ["return_on_equity", "net_profit_margin", "current_ratio"]


def _ratio_scores(spark, sf):
    kinds = F.array(*[F.struct(F.lit(c).alias("score_type"), F.col(c).alias("score")) for c in RATIO_TYPES])
    return v.ratios(spark, sf).select("symbol", "date", F.inline(kinds))


RATIO_SCORES = "scores AS (" + " UNION ALL ".join(
    f"SELECT symbol, date, '{c}' AS score_type, {c} AS score FROM ratios" for c in RATIO_TYPES) + ")"


def mean_2(value: str) -> str:
    """Mean of non-negative values, half up at two places, in integer arithmetic."""
    total = f"sum(CAST(round({value} * 1000000) AS BIGINT))"
    return f"((2 * {total} + 10000 * count(*)) // (20000 * count(*))) / 100.0"


@query("avg_score_by_group", "group_type group_name score_type avg_score:2", "ratios profile",
       f"""SELECT 'sector' AS group_type, sector AS group_name, score_type, {mean_2('score')} AS avg_score FROM latest JOIN profile
       USING (symbol) WHERE sector IS NOT NULL GROUP BY sector, score_type UNION ALL SELECT 'industry', industry, score_type,
       {mean_2('score')} FROM latest JOIN profile USING (symbol) WHERE industry IS NOT NULL GROUP BY industry, score_type""",
       f"{RATIO_SCORES}, latest AS (SELECT * FROM scores s WHERE date = (SELECT max(date) FROM scores t "
       "WHERE t.score_type = s.score_type) AND score IS NOT NULL)")
def _(spark, sf):
    return agg.avg_score_by_group(_ratio_scores(spark, sf), v.profile(spark, sf))


@query("latest_date_per_group", "score_type symbol date:d score:6", "ratios",
       "SELECT * FROM scores s WHERE date = (SELECT max(date) FROM scores t WHERE t.score_type = s.score_type)", RATIO_SCORES)
def _(spark, sf):
    return agg.latest_rows_per_type(_ratio_scores(spark, sf))


@query("distinct_values", "l_shipmode_flag l_linestatus", sql="SELECT DISTINCT l_returnflag AS l_shipmode_flag, l_linestatus FROM lineitem")
def _(spark, sf):
    return v.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("l_shipmode_flag"), "l_linestatus").distinct()


COUNTED = ["customer", "supplier", "part", "orders", "lineitem", "events"]


@query("table_row_counts", "table rows:i",
       sql=" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in COUNTED))
def _(spark, sf):
    return agg.table_row_counts({t: v.table(spark, sf, t) for t in COUNTED})


@query("max_watermark", "watermark", "messy",
       "SELECT CAST(max(CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE)) AS VARCHAR) AS watermark FROM messy")
def _(spark, sf):
    return upsert.max_watermark(v.messy(spark, sf), "date_text")


@query("minmax_normalise_universe", "symbol date:d return_on_equity:6 current_ratio:6 interest_coverage:6", "ratios",
       "SELECT symbol, date, " + ", ".join(
           f"""CASE WHEN {c} IS NULL THEN NULL WHEN max({c}) OVER d = min({c}) OVER d THEN 50
           ELSE ({c} - min({c}) OVER d) / (max({c}) OVER d - min({c}) OVER d) * 100 END AS {c}"""
           for c in ["return_on_equity", "current_ratio", "interest_coverage"]) + " FROM ratios WINDOW d AS (PARTITION BY date)")
def _(spark, sf):
    rows = v.ratios(spark, sf).select("symbol", "date", "return_on_equity", "current_ratio", "interest_coverage")
    return agg.minmax_normalise_universe(rows, "date", rows.columns[2:])


@query("minmax_normalise_group", "symbol sector date:d return_on_equity:6 interest_coverage:6", "ratios profile",
       "SELECT symbol, sector, date, " + ", ".join(
           f"""CASE WHEN {c} IS NULL THEN NULL WHEN max({c}) OVER d = min({c}) OVER d THEN 50
           ELSE ({c} - min({c}) OVER d) / (max({c}) OVER d - min({c}) OVER d) * 100 END AS {c}"""
           for c in ["return_on_equity", "interest_coverage"])
       + " FROM ratios JOIN profile USING (symbol) WINDOW d AS (PARTITION BY sector, date)")
def _(spark, sf):
    rows = v.ratios(spark, sf).join(v.profile(spark, sf).select("symbol", "sector"), "symbol")
    rows = rows.select("symbol", "sector", "date", "return_on_equity", "interest_coverage")
    return agg.minmax_normalise_group(rows, ["sector", "date"], rows.columns[3:])


@query("metric_subscore_minmax", "ref symbol date:d interest_coverage:6 price_earnings_ratio:6", "profile peers ratios",
       """SELECT ref, m.symbol, date, CASE WHEN count(interest_coverage) OVER g < 2 THEN 50 WHEN interest_coverage IS NULL THEN 0
       WHEN min(interest_coverage) OVER g = max(interest_coverage) OVER g THEN 50
       ELSE 100 * (interest_coverage - min(interest_coverage) OVER g) / (max(interest_coverage) OVER g - min(interest_coverage) OVER g)
       END AS interest_coverage, CASE WHEN count(price_earnings_ratio) OVER g < 2 THEN 50 WHEN price_earnings_ratio IS NULL THEN 0
       WHEN min(price_earnings_ratio) OVER g = max(price_earnings_ratio) OVER g THEN 50 ELSE 100 * (max(price_earnings_ratio) OVER g
       - price_earnings_ratio) / (max(price_earnings_ratio) OVER g - min(price_earnings_ratio) OVER g) END AS price_earnings_ratio
       FROM members m JOIN ratios r ON m.symbol = r.symbol WINDOW g AS (PARTITION BY ref, date)""", GROUPS)
def _(spark, sf):
    from tickerlake.plans.peer_scores import subscores_minmax

    members = joins.peer_group_expand(v.peers(spark, sf), v.profile(spark, sf))
    rows = materialise(members.join(
        v.ratios(spark, sf).select("symbol", "date", "interest_coverage", "price_earnings_ratio"), "symbol"), "members")
    return subscores_minmax(rows, ["ref", "date"], {"interest_coverage": True, "price_earnings_ratio": False})


@query("metric_subscore_percentile", "sector symbol date:d current_ratio:6 interest_coverage:6", "ratios profile",
       """SELECT sector, symbol, date, cume_dist() OVER (PARTITION BY sector, date ORDER BY current_ratio) * 100 AS current_ratio,
       CASE WHEN interest_coverage IS NULL THEN 0 ELSE cume_dist() OVER (PARTITION BY sector, date, interest_coverage IS NULL ORDER BY -interest_coverage) * 100 END
       AS interest_coverage FROM ratios JOIN profile USING (symbol)""")
def _(spark, sf):
    from tickerlake.plans.peer_scores import subscores_percentile

    rows = v.ratios(spark, sf).join(v.profile(spark, sf).select("symbol", "sector"), "symbol")
    rows = materialise(rows.select("sector", "symbol", "date", "current_ratio", "interest_coverage"), "sector-ratios")
    return subscores_percentile(rows, ["sector", "date"], "symbol", {"current_ratio": True, "interest_coverage": False})


@query("nanmean_row", "symbol date:d mean:6", "ratios",
       """SELECT symbol, date, (coalesce(interest_coverage, 0) + coalesce(price_earnings_to_growth_ratio, 0)) /
       nullif((interest_coverage IS NOT NULL)::INT + (price_earnings_to_growth_ratio IS NOT NULL)::INT, 0) AS mean FROM ratios""")
def _(spark, sf):
    from tickerlake.functions.measures import mean_of

    return v.ratios(spark, sf).withColumn(
        "mean", mean_of(F.col("interest_coverage"), F.col("price_earnings_to_growth_ratio")))


@query("ohlcv_daily", "symbol day:d open:6 high:6 low:6 close:6 volume:i trades:i",
       sql="""SELECT event_type AS symbol, CAST(ts AS DATE) AS day, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
       min(value) AS low, arg_max(value, (ts, event_id)) AS close, sum(user_id) AS volume, count(*) AS trades FROM events GROUP BY 1, 2""")
def _(spark, sf):
    ticks = v.table(spark, sf, "events").withColumnRenamed("event_type", "symbol")
    return agg.ohlcv_daily(ticks, "symbol", "ts", "value", "user_id", "event_id")


@query("nav_monthly", "identifier month:d opening_nav:6 closing_nav:6 max_nav:6 min_nav:6 avg_yield:6 trading_days:i", "quotes",
       """SELECT symbol AS identifier, CAST(date_trunc('month', date) AS DATE) AS month, arg_min(adj_close, date) AS opening_nav,
       arg_max(adj_close, date) AS closing_nav, max(adj_close) AS max_nav, min(adj_close) AS min_nav, avg(volume) AS avg_yield,
       count(*) AS trading_days FROM quotes WHERE adj_close IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    return agg.nav_monthly(v.quotes(spark, sf).withColumnRenamed("symbol", "identifier"), "identifier", "adj_close", "volume")


@query("api_usage_by_minute", "minute:t endpoint call_count:i avg_response_time:6 min_rate_limit:i", "api_calls",
       """SELECT date_trunc('minute', ts) AS minute, endpoint, count(*) AS call_count, avg(response_time_ms) AS avg_response_time,
       min(user_id) AS min_rate_limit FROM api_calls GROUP BY 1, 2""")
def _(spark, sf):
    return agg.usage_by_minute(v.api_calls(spark, sf), remaining="user_id")


@query("daily_market_summary", "date:d total_symbols:i avg_navps:6", "quotes",
       "SELECT date, count(*) AS total_symbols, avg(volume) AS avg_navps FROM quotes GROUP BY 1")
def _(spark, sf):
    return agg.daily_market_summary(v.quotes(spark, sf), "volume")


@query("category_average", "symbol sector ytd_change:6 ytd_change_category:6", "quotes profile",
       f"""SELECT symbol, sector, ytd_change, avg(ytd_change) OVER (PARTITION BY sector) AS ytd_change_category
       FROM ({PERFORMANCE}) JOIN profile USING (symbol)""", LATEST)
def _(spark, sf):
    perf = ts.price_performance(v.quotes(spark, sf)).select("symbol", "ytd_change")
    return agg.category_average(perf.join(v.profile(spark, sf).select("symbol", "sector"), "symbol"), "sector", "ytd_change")


@query("exposure_by_dimension", "etf_symbol country value:4 weight_percentage:6", "holdings",
       """SELECT *, value / sum(value) OVER (PARTITION BY etf_symbol) * 100 AS weight_percentage FROM
       (SELECT etf_symbol, country, sum(market_value) AS value FROM holdings GROUP BY 1, 2)""")
def _(spark, sf):
    return agg.exposure_by_dimension(v.holdings(spark, sf), "etf_symbol", "country", "market_value")


# ---- ranking


@query("topk_per_sector", "sector rank:i symbol mkt_cap:6", "profile",
       """SELECT *, row_number() OVER (PARTITION BY sector ORDER BY mkt_cap DESC, symbol) AS rank FROM profile
       WHERE mkt_cap > 0 QUALIFY rank <= 10""")
def _(spark, sf):
    return topk.topk_per_sector(v.profile(spark, sf))


BEST_WORST = """SELECT parent_symbol, 'Gainer' AS category, row_number() OVER
    (PARTITION BY parent_symbol ORDER BY day_change DESC, symbol) AS rank, symbol, day_change FROM moves QUALIFY rank <= 10
    UNION ALL SELECT parent_symbol, 'Loser', row_number() OVER
    (PARTITION BY parent_symbol ORDER BY day_change, symbol DESC) AS rank, symbol, day_change FROM moves QUALIFY rank <= 10"""


@query("gainers_losers_per_parent", "parent_symbol category rank:i symbol day_change:6", "quotes profile", BEST_WORST,
       f"{LATEST}, {PARENTS_SQL}, {CONSTITUENTS}, moves AS (SELECT * FROM constituents JOIN ({PERFORMANCE}) USING (symbol))")
def _(spark, sf):
    moves = constituents(spark, sf).join(ts.price_performance(v.quotes(spark, sf)), "symbol")
    return topk.gainers_losers(moves, ["parent_symbol"])


CHANGES = """changes AS (SELECT symbol, (max(adj_close) FILTER (n = 1) - max(adj_close) FILTER (n = 2))
    / max(adj_close) FILTER (n = 2) * 100 AS c FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS n
    FROM quotes) GROUP BY 1)"""


@query("top10_market", "type rank:i symbol changes_percentage:6", "quotes profile",
       """SELECT 'gainer' AS type, row_number() OVER (ORDER BY coalesce(c, 0) DESC, symbol) AS rank, symbol, coalesce(c, 0) AS changes_percentage
       FROM changes JOIN profile USING (symbol) QUALIFY rank <= 10 UNION ALL
       SELECT 'loser', row_number() OVER (ORDER BY coalesce(c, 0), symbol) AS rank, symbol, coalesce(c, 0)
       FROM changes JOIN profile USING (symbol) QUALIFY rank <= 10""", CHANGES)
def _(spark, sf):
    return topk.top10_market(topk.last_day_change(v.quotes(spark, sf)), v.profile(spark, sf))


@query("rank_scores_in_group", "sector date:d symbol score:6 rank:i", "ratios profile",
       """SELECT sector, date, symbol, current_ratio AS score, row_number() OVER (PARTITION BY sector, date
       ORDER BY current_ratio DESC, symbol) AS rank FROM ratios JOIN profile USING (symbol)""")
def _(spark, sf):
    from tickerlake.operators.ranking import rank_across

    rows = v.ratios(spark, sf).join(v.profile(spark, sf).select("symbol", "sector"), "symbol")
    rows = rows.select("sector", "date", "symbol", F.col("current_ratio").alias("score"))
    return rank_across(rows, ["sector", "date"], [F.col("score").desc(), F.col("symbol")], "rank")


@query("rank_nulls_last_universe", "date:d symbol score:6 rank:i", "ratios profile",
       """SELECT * FROM (SELECT date, symbol, interest_coverage AS score, row_number() OVER (PARTITION BY date
       ORDER BY interest_coverage DESC NULLS LAST, symbol) AS rank FROM ratios) WHERE symbol IN
       (SELECT symbol FROM profile WHERE currency = 'USD')""")
def _(spark, sf):
    from tickerlake.operators.ranking import rank_across

    rows = v.ratios(spark, sf).select("date", "symbol", F.col("interest_coverage").alias("score"))
    ranked = rank_across(rows, ["date"], [F.col("score").desc_nulls_last(), F.col("symbol")], "rank")
    return ranked.join(v.profile(spark, sf).filter("currency = 'USD'").select("symbol"), "symbol", "left_semi")


@query("limit_n_per_key", "symbol peer_symbol", "company_peers",
       "SELECT * FROM company_peers QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY peer_symbol) <= 2")
def _(spark, sf):
    return topk.top_k(v.company_peers(spark, sf), ["symbol"], [F.col("peer_symbol")], 2)


@query("order_by_multi", "sector symbol mkt_cap:6", "profile", "SELECT sector, symbol, mkt_cap FROM profile ORDER BY sector, mkt_cap DESC")
def _(spark, sf):
    return v.profile(spark, sf).orderBy("sector", F.col("mkt_cap").desc())


@query("top_holdings_per_fund", "etf_symbol rank:i asset country market_value:6", "holdings",
       """SELECT *, row_number() OVER (PARTITION BY etf_symbol ORDER BY market_value DESC, asset, country) AS rank FROM holdings
       QUALIFY rank <= 10""")
def _(spark, sf):
    order = [F.col("market_value").desc(), F.col("asset"), F.col("country")]
    return topk.top_k(v.holdings(spark, sf), ["etf_symbol"], order, 10)


@query("limit_one_latest", "date:d close:6", "bench", "SELECT * FROM bench ORDER BY date DESC LIMIT 1")
def _(spark, sf):
    return v.benchmark_close(spark, sf).orderBy(F.col("date").desc()).limit(1)


# ---- sets, dedupe, upsert

RECORDS = "record_id change_date:d value:6 part supp"
FIRST = "QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY change_date DESC, value, part, supp) = 1"
OLD, NEW = "change_date < DATE '1999-01-01'", "change_date >= DATE '1998-07-01'"
BATCHES = f"old AS (SELECT * FROM records WHERE {OLD} {FIRST}), batch AS (SELECT * FROM records WHERE {NEW} {FIRST})"


def batches(spark, sf):
    """A keyed target (records before 1999) and an overlapping newer batch."""
    rows = v.records(spark, sf)
    newest_first = [F.col("change_date").desc()]
    return tuple(upsert.dedupe_by_key(rows.filter(part), ["record_id"], newest_first) for part in (OLD, NEW))


@query("distinct_rows", "l_partkey l_suppkey", sql="SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(spark, sf):
    return v.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("dedupe_by_key", RECORDS, "records", f"SELECT * FROM records {FIRST}")
def _(spark, sf):
    return upsert.dedupe_by_key(v.records(spark, sf), ["record_id"], [F.col("change_date").desc()])


@query("insert_if_absent", RECORDS, "records",
       "SELECT * FROM old UNION ALL SELECT * FROM batch WHERE record_id NOT IN (SELECT record_id FROM old)", BATCHES)
def _(spark, sf):
    return upsert.insert_if_absent(*batches(spark, sf), ["record_id"])


@query("upsert_update", RECORDS, "records",
       "SELECT * FROM batch UNION ALL SELECT * FROM old WHERE record_id NOT IN (SELECT record_id FROM batch)", BATCHES)
def _(spark, sf):
    return upsert.upsert_update(*batches(spark, sf), ["record_id"])


@query("delete_then_append", RECORDS, "records",
       f"""SELECT * FROM records WHERE {NEW} UNION ALL SELECT * FROM old WHERE record_id NOT IN
       (SELECT record_id FROM records WHERE {NEW})""", BATCHES)
def _(spark, sf):
    return upsert.delete_then_append(batches(spark, sf)[0], v.records(spark, sf).filter(NEW))


@query("replace_by_date", "symbol date:d adj_close:6", "quotes",
       """SELECT symbol, date, adj_close FROM quotes WHERE date <> (SELECT max(date) FROM quotes) UNION ALL
       SELECT symbol, date, adj_close * 2 FROM quotes WHERE date = (SELECT max(date) FROM quotes)""")
def _(spark, sf):
    quotes = v.quotes(spark, sf).select("symbol", "date", "adj_close")
    day = month_end_list(spark, sf)[-1]
    batch = quotes.filter(F.col("date") == F.lit(day)).withColumn("adj_close", F.col("adj_close") * 2)
    return upsert.replace_by_date(quotes, batch)


@query("delta_after_watermark", RECORDS, "records",
       f"SELECT * FROM records WHERE change_date > (SELECT max(change_date) FROM records WHERE {OLD})")
def _(spark, sf):
    rows = v.records(spark, sf)
    return upsert.delta_after_watermark(rows.filter(OLD), rows, "change_date")


@query("union_universe", "symbol", "profile company_peers",
       "SELECT symbol FROM profile UNION SELECT peer_symbol FROM company_peers")
def _(spark, sf):
    return upsert.union_universe(v.profile(spark, sf), v.company_peers(spark, sf))


VERSIONS = f"""history AS (SELECT record_id, value, 1 AS data_version, 'CSV' AS data_source FROM old),
    appended AS (SELECT * FROM history UNION ALL SELECT record_id, b.value, coalesce(h.data_version, 0) + 1, 'API'
    FROM batch b LEFT JOIN history h USING (record_id))"""


def _history(spark, sf):
    old, new = batches(spark, sf)
    history = old.select("record_id", "value", F.lit(1).alias("data_version"), F.lit("CSV").alias("data_source"))
    return upsert.versioned_append(history, new.select("record_id", "value"), ["record_id"])


@query("versioned_append", "record_id value:6 data_version:i data_source", "records", "SELECT * FROM appended", f"{BATCHES}, {VERSIONS}")
def _(spark, sf):
    return _history(spark, sf)


@query("latest_version", "record_id value:6 data_version:i data_source", "records",
       "SELECT * FROM appended QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY data_version DESC) = 1",
       f"{BATCHES}, {VERSIONS}")
def _(spark, sf):
    return upsert.latest_version(_history(spark, sf), ["record_id"])


@query("file_hash_dedupe", "file_hash path copies:i",
       sql="""SELECT sha256(text) AS file_hash, min('doc-' || lpad(CAST(doc_id AS VARCHAR), 9, '0')) AS path, count(*) AS copies
       FROM documents GROUP BY 1 HAVING sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'en')""")
def _(spark, sf):
    docs = v.table(spark, sf, "documents")
    seen = docs.filter("lang = 'en'").select(F.sha2(F.col("text").cast("binary"), 256).alias("file_hash"))
    path = F.concat(F.lit("doc-"), F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    return upsert.file_hash_dedupe(docs.select(path.alias("path"), F.col("text").alias("content")), seen)


@query("union_groups", "group_type group_name n:i", "profile",
       """SELECT 'sector' AS group_type, sector AS group_name, count(*) AS n FROM profile GROUP BY 2 UNION ALL
       SELECT 'industry', industry, count(*) FROM profile GROUP BY 2""")
def _(spark, sf):
    profile = v.profile(spark, sf)
    kinds = [
        profile.groupBy(F.col(k).alias("group_name")).agg(F.count("*").alias("n")).withColumn("group_type", F.lit(k))
        for k in ("sector", "industry")
    ]
    return kinds[0].unionByName(kinds[1])


@query("retention_delete", "symbol date:d adj_close:6", "quotes",
       "SELECT * FROM quotes WHERE date >= (SELECT max(date) - INTERVAL 2 YEAR FROM quotes)")
def _(spark, sf):
    return upsert.retention_filter(v.quotes(spark, sf), "date", months=24)


# ---- nested values


@query("split_trim_explode", "symbol peer_symbol:i", "peers", "SELECT symbol, peer_symbol FROM peers")
def _(spark, sf):
    # at most 18 peers per symbol, folded to the vendor's comma list with stray blanks
    lists = v.peers(spark, sf).groupBy("symbol").agg(
        F.concat(F.array_join(F.collect_list(F.col("peer_symbol").cast("string")), ", ,"), F.lit(" ,")).alias("peers"))
    return nested.split_trim_explode(lists, "symbol", "peers", "peer_symbol")


@query("explode_array_index", "identifier label:2 array_source_field array_element_index:i value:5",
       sql="""SELECT vec_id AS identifier, label, 'embedding' AS array_source_field,
       generate_subscripts(embedding, 1) - 1 AS array_element_index, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings""")
def _(spark, sf):
    rows = nested.explode_array_index(v.table(spark, sf, "embeddings"), "vec_id", numeric=["label"])
    return rows.withColumn("value", F.col("array_element_value").try_cast("float"))


@query("json_preserve", "event_id user_id:i event_type k:i",
       sql="SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    kept = nested.json_preserve(v.table(spark, sf, "events").select("event_id", "user_id", "event_type", "props"))
    back = F.from_json("raw_json", "event_id bigint, user_id bigint, event_type string, props string").alias("r")
    return kept.select(back).select("r.*").withColumn("k", F.get_json_object("props", "$.k").try_cast("bigint"))


@query("map_lookup_sector", "symbol sector type", "profile",
       """SELECT DISTINCT c.parent_symbol AS symbol, p.sector, CASE WHEN p.sector IS NULL THEN 'Index' ELSE 'Sector' END AS type
       FROM constituents c LEFT JOIN parents p ON c.parent_symbol = p.parent_symbol""", f"{PARENTS_SQL}, {CONSTITUENTS}")
def _(spark, sf):
    symbols = constituents(spark, sf).select(F.col("parent_symbol").alias("symbol")).distinct()
    return nested.map_lookup_sector(symbols, SECTOR_PARENTS)


@query("power_cagr", "symbol cagr:6", "quotes",
       """SELECT symbol, power(arg_max(adj_close, date) / arg_min(adj_close, date), 365.0 / (max(date) - min(date))) - 1 AS cagr
       FROM quotes GROUP BY 1""")
def _(spark, sf):
    from tickerlake.functions.measures import cagr

    ends = [F.max_by("adj_close", "date"), F.min_by("adj_close", "date"), F.datediff(F.max("date"), F.min("date"))]
    return v.quotes(spark, sf).groupBy("symbol").agg(cagr(*ends).alias("cagr"))
