"""The recurring jobs over catalogue tables, by their canonical names.

Each job reads tables, builds one DataFrame plan per result and replaces, upserts or appends the result table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.functions import cleaning as cl
from tickerlake.operators import calendar as cal, quality, topk
from tickerlake.operators.joins import constituents_expand
from tickerlake.operators.funds import clean_fund_data_rows
from tickerlake.operators.timeseries import rolling_stddev
from tickerlake.operators.universe import file_family
from tickerlake.operators.upsert import dedupe_by_key, delete_then_append, delta_after_watermark, insert_if_absent, required_key, update_ledger, upsert_update
from tickerlake.plans import market, peer_scores, peers, risk, universe_scores
from tickerlake.sources import files, schemas
from tickerlake.sources.sinks import insert_days, overwrite_days, sink_append, sink_replace


def has_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _merged(spark: SparkSession, name: str, rows: DataFrame, merge, keys: list[str] | None = None) -> DataFrame:
    """The stored table merged with new rows, or the rows alone when there is no table yet; rows with a blank key are left out, one stays per key."""
    if keys:
        rows = dedupe_by_key(required_key(rows, keys), keys, [])
    return merge(spark.table(name), rows) if has_table(spark, name) else rows


#: Table of the loads: a row per file and load.
LOAD_LOG = "load_log"


def _logged(spark: SparkSession, log: DataFrame, table: str) -> None:
    """Append a load's rows to the log of loads."""
    rows = log.withColumns({"table": F.lit(table), "family": file_family(F.col("file")), "loaded_at": F.current_timestamp()})
    if has_table(spark, LOAD_LOG):
        rows.select(*spark.table(LOAD_LOG).columns).write.insertInto(LOAD_LOG)
    else:
        sink_replace(rows, LOAD_LOG)


def load_quotes(spark: SparkSession, folder: str, table: str = "equity_quotes") -> DataFrame:
    """Yearly quote files of a folder into a quote table with a partition per day; stored rows win, days that the files do not hold are not touched.

    Files that cannot be read are left out; ``LOAD_LOG`` has a row for every file.
    """
    columns = [c.split()[0] for c in schemas.QUOTE_SCHEMA.split(", ")]
    types = dict(c.split() for c in schemas.QUOTE_SCHEMA.split(", "))
    rows, log = files.load_partition_files(spark, folder, columns, types, schemas.SYMBOL_DATE)
    insert_days(required_key(rows, schemas.SYMBOL_DATE).drop("source_file"), table, schemas.SYMBOL_DATE)
    _logged(spark, log, table)
    return spark.table(table)


def load_bulk_eod(spark: SparkSession, path: str, table: str = "equity_quotes") -> DataFrame:
    """The whole-market dump of a day (or several): its days take the place of the stored ones, and only their partitions are written."""
    rows = dedupe_by_key(required_key(files.ingest_bulk_eod(spark, path), schemas.SYMBOL_DATE), schemas.SYMBOL_DATE, [])
    if has_table(spark, table):
        stored = spark.table(table)
        rows = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in stored.dtypes])
    overwrite_days(rows, table)
    return spark.table(table)


def load_statement(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A statement dump (one CSV row per symbol and date) typed by column name; stored rows win."""
    text = spark.read.options(header=True, quote='"', escape='"').csv(path)
    named = files.snake_columns(text)
    rows = files.cast_staged(named, {c: schemas.statement_type(c) for c in named.columns})
    keys = schemas.KEYS.get(table, schemas.SYMBOL_DATE)
    return sink_replace(_merged(spark, table, rows, lambda t, r: insert_if_absent(t, r, keys), keys), table)


def load_profiles(spark: SparkSession, path: str, table: str = "equity_profile") -> DataFrame:
    """Profile objects; newer values win."""
    rows = files.ingest_profile_json(spark, path)
    return sink_replace(_merged(spark, table, rows, lambda t, r: upsert_update(t, r, ["symbol"]), ["symbol"]), table)


def load_fund_quotes(spark: SparkSession, path: str, table: str = "fund_quotes") -> DataFrame:
    """A fund price dump into a table with a partition per day: only rows newer than the stored ones are added, as new partitions."""
    keys = schemas.KEYS["fund_quotes"]
    raw = files.fund_quotes_transform(spark.read.options(header=True, quote='"', escape='"').csv(path))
    rows = dedupe_by_key(required_key(raw.withColumn("date", cl.safe_date(F.col("date"))), keys), keys, [])
    if has_table(spark, table):
        rows = delta_after_watermark(spark.table(table).select("date"), rows)
    insert_days(rows, table, keys)
    return spark.table(table)


def load_fund_data(spark: SparkSession, path: str, table: str = "fund_data") -> DataFrame:
    """A dump of fund records, cleaned; a record that comes again replaces the stored one."""
    rows = clean_fund_data_rows(spark.read.options(header=True, quote='"', escape='"').csv(path))
    return sink_replace(_merged(spark, table, rows, delete_then_append, ["record_id"]), table)


def load_fund_seeds(spark: SparkSession, folder: str, names: list[str], ledger: str = "seed_ledger") -> list[str]:
    """Seed files of a folder into their tables. A file whose content was loaded before is skipped, and the ledger counts its passes; returns the tables written."""
    found = files.read_file_contents(spark, [f"{folder}/{n}" for n in names]).select("path", F.sha2("content", 256).alias("file_hash"))
    # a row per seed file
    hashes = {r["path"].rsplit("/", 1)[-1]: r["file_hash"] for r in found.collect()}
    known = {r[0] for r in spark.table(ledger).select("file_hash").collect()} if has_table(spark, ledger) else set()
    fresh = [n for n in names if hashes[n] not in known]
    tables = files.scan_fund_seed_files(spark, folder, fresh) if fresh else {}
    for name, rows in tables.items():
        sink_replace(rows, name)
    seen = found.select("file_hash")
    stored = spark.table(ledger) if known else seen.limit(0).withColumn("processing_count", F.lit(0).cast("bigint"))
    sink_replace(update_ledger(stored, seen), ledger)
    return sorted(tables)


def load_treasury(spark: SparkSession, path: str, table: str = "treasury") -> DataFrame:
    rows = files.ingest_treasury(spark, path).filter("date IS NOT NULL")
    return sink_replace(_merged(spark, table, rows, lambda t, r: upsert_update(t, r, ["date"]), ["date"]), table)


def load_peers(spark: SparkSession, path: str, table: str = "equity_peers", profile: str = "equity_profile") -> DataFrame:
    """The bulk peer dump (symbol, comma list) restricted to the profile, then topped up."""
    lists = spark.read.schema("symbol string, peers string").options(header=True, quote='"', escape='"').csv(path)
    new = peers.peers_from_bulk(lists, spark.table(profile))
    return sink_replace(_merged(spark, table, new, lambda t, r: insert_if_absent(t, r, ["symbol", "peer_symbol"])), table)


def boost_peers(spark: SparkSession) -> None:
    """Adds similar companies and funds to symbols with at most three peers."""
    for table, profile, boost in (
        ("equity_peers", "equity_profile", peers.peers_boost_equity),
        ("etfs_peers", "etfs_profile", peers.peers_boost_etf),
    ):
        if has_table(spark, table) and has_table(spark, profile):
            stored = spark.table(table).select("symbol", "peer_symbol")
            new = boost(spark.table(profile), stored).select("symbol", "peer_symbol")
            sink_replace(stored.unionByName(new), table)


def daily_reports(spark: SparkSession, members: DataFrame | None = None) -> None:
    """Index performance, market pages, sector leaders and the day's top ten.

    ``members`` lists (parent_symbol, symbol) of the broad indexes; sector funds take their sector's companies,
    the Toronto fund its fixed list.
    """
    quotes, market_quotes = spark.table("equity_quotes"), spark.table("market_sector_quotes")
    profile = spark.table("equity_profile")
    symbols = spark.createDataFrame([(s,) for s in [*market.INDEX_SYMBOLS, *market.SECTOR_FUNDS]], "symbol string")
    sink_replace(market.index_performance(market_quotes, symbols), "index_performance")
    toronto = market.toronto_members(spark)
    listed = toronto if members is None else toronto.unionByName(members.select("parent_symbol", "symbol"))
    constituents = constituents_expand(market.SECTOR_FUNDS, profile, listed)
    pages = market.market_pages(quotes, market_quotes, profile, constituents, market.SECTOR_FUNDS)
    sink_replace(pages, "market_sector_pages_performance")
    sink_replace(market.sector_top_holdings(profile, quotes), "sector_top_holdings")
    sink_replace(topk.top10_market(topk.last_day_change(quotes), profile), "top_10")


def weekly_scores(spark: SparkSession, as_of: date | None = None) -> None:
    """Peer-relative, universe-relative and fund scores at twelve dates up to ``as_of`` (the newest quote)."""
    quotes, ratios = spark.table("equity_quotes"), spark.table("equity_financial_ratio")
    growth, profile, edges = spark.table("equity_financial_growth"), spark.table("equity_profile"), spark.table("equity_peers")
    today = as_of or cal.latest_date(quotes)
    one = spark.range(1)
    cutoffs = one.select(cal.historical_month_ends(F.lit(today))).first()[0]
    month_ends = one.select(cal.month_ends_up_to(F.lit(today))).first()[0]

    scores = peer_scores.peer_scores_minmax(quotes, ratios, growth, edges, profile, cutoffs)
    key = ["ref", "symbol", "cutoff", "category"]
    sink_replace(_merged(spark, "peer_scores", scores, lambda t, r: upsert_update(t, r, key)), "peer_scores")

    universe = universe_scores.universe_scores(
        quotes, ratios, growth, spark.table("equity_key_metrics"), edges, profile, cutoffs)
    stored = sink_replace(universe, "universe_scores")
    averages = universe_scores.score_group_averages(stored, profile, today)
    history = _merged(spark, "equity_scores_average", averages, lambda t, r: t.unionByName(r))
    sink_replace(history, "equity_scores_average")

    sink_replace(rolling_stddev(quotes, "adj_close"), "equity_std_dev")
    if has_table(spark, "etfs_quotes"):
        funds = spark.table("etfs_profile")
        bench = spark.table("market_sector_quotes").filter("symbol = 'SPY'").select("date", "close")
        metrics = risk.etf_metrics(
            spark.table("etfs_quotes").drop("adj_close").withColumnRenamed("close", "adj_close"), bench,
            spark.table("treasury").filter("date >= DATE '2010-01-01'"), funds, month_ends)
        rows = risk.etf_group_scores(metrics, spark.table("etfs_peers"), funds)
        sink_replace(_merged(spark, "etfs_scores", rows, lambda t, r: upsert_update(t, r, ["symbol", "date"])), "etfs_scores")


def seed_report(spark: SparkSession, minimums: dict[str, int] | None = None) -> DataFrame:
    """Tables that are missing, unreadable or below their minimum row count."""
    wanted = minimums or schemas.SEED_MINIMUMS
    tables = {t: spark.table(t) for t in wanted if has_table(spark, t)}
    return quality.under_seeded_tables(spark, tables, wanted)


def load_health(spark: SparkSession, minimums: dict[str, int] | None = None) -> DataFrame:
    """One row: critical tables filled, share of files loaded, and both quote folders complete, from the log of loads."""
    wanted = minimums or schemas.CRITICAL_MINIMUMS
    tables = {t: spark.table(t) for t in wanted if has_table(spark, t)}
    return quality.critical_load_check(spark, tables, wanted, spark.table(LOAD_LOG))


def export_log(spark: SparkSession, log: quality.RunLog, path: str) -> int:
    """Append the log of a run."""
    return sink_append(log.rows(), path)
