"""Readers, sinks, layouts, streams and quality reports. Files are written by Spark from the given tables
into the shared scratch folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickerlake.operators import aggregates as agg, quality, upsert
from tickerlake.plans.refresh import refresh_aggregates
from tickerlake.registry.core import query
from tickerlake.registry.timeseries import month_end_list
from tickerlake.session import scratch_path
from tickerlake.sources import files, records, schemas, sinks, views as v
from tickerlake.streaming import jobs


def _csv(df, spark, label: str) -> str:
    path = scratch_path(spark, label)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def _json(df, spark, label: str) -> str:
    path = scratch_path(spark, label)
    df.write.json(path)
    return path


def _in_files(df, least: int):
    """At least ``least`` partitions: the table's own splits where these are enough, so that no row is shuffled to its file."""
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


# ---- readers


@query("scan_csv_typed", "l_orderkey l_linenumber:i l_extendedprice:6 l_returnflag ship_date:d",
       sql="SELECT *, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem")
def _(spark, sf):
    rows = v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", F.col("l_shipdate").cast("date").alias("ship_date"))
    schema = "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, ship_date date"
    return files.scan_csv_typed(spark, _csv(rows, spark, "csv-typed"), schema)


@query("scan_csv_staged_text", "l_orderkey l_linenumber:i int_text:i float_text:6 volume_text:i", "messy",
       """SELECT l_orderkey, l_linenumber, TRY_CAST(nullif(trim(int_text), '') AS BIGINT) AS int_text,
       TRY_CAST(nullif(trim(float_text), '') AS DOUBLE) AS float_text,
       CAST(round_even(TRY_CAST(nullif(trim(volume_text), '') AS DOUBLE), 0) AS BIGINT) AS volume_text FROM messy""")
def _(spark, sf):
    rows = v.messy(spark, sf).select("l_orderkey", "l_linenumber", "int_text", "float_text", "volume_text")
    types = {"l_orderkey": "bigint", "l_linenumber": "bigint", "int_text": "bigint", "float_text": "double", "volume_text": "bigint"}
    return files.scan_csv_staged_text(spark, _csv(rows, spark, "csv-staged"), types)


LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


@query("scan_partition_files", "id a b c:i", "dirty_lines",
       f"""SELECT DISTINCT {LINE_ID} AS id, CASE l_orderkey % 5 WHEN 0 THEN 'October ' || CAST(l_linenumber AS VARCHAR) || ' 12' WHEN 1 THEN 'open,' || CAST(l_partkey AS VARCHAR)
       WHEN 2 THEN CAST(l_partkey AS VARCHAR) WHEN 4 THEN 'a' END AS a,
       CASE l_orderkey % 5 WHEN 0 THEN CAST(l_partkey AS VARCHAR) WHEN 4 THEN 'b' END AS b,
       CASE l_orderkey % 5 WHEN 0 THEN 3 WHEN 3 THEN l_partkey WHEN 4 THEN l_partkey END AS c FROM dirty_lines""")
def _(spark, sf):
    # all five kinds of line, each behind its number
    numbered = F.concat(F.expr(LINE_ID), F.lit(","), F.col("line")).alias("line")
    path = scratch_path(spark, "partition-files")
    _in_files(v.dirty_lines(spark, sf).select(numbered), 4).write.text(path)
    return files.scan_partition_files(spark, path, ["id", "a", "b", "c"], {"c": "bigint"}, ["id"])


@query("load_partition_files", "status files:i lines:i accepted:i rejected:i", "dirty_lines",
       f"""SELECT 'loaded' AS status, 4 AS files, count(*) AS lines, count(*) FILTER (l_orderkey % 5 <> 2) AS accepted,
       count(*) FILTER (l_orderkey % 5 = 2) AS rejected FROM dirty_lines""")
def _(spark, sf):
    # lines of one cell have no key
    line = F.when(F.col("l_orderkey") % 5 == 2, F.concat(F.lit(","), "line")).otherwise(F.concat(F.expr(LINE_ID), F.lit(","), F.col("line")))
    # the check counts four files
    path = scratch_path(spark, "logged-files")
    _in_files(v.dirty_lines(spark, sf).select(line.alias("line")), 4).coalesce(4).write.text(path)
    log = files.load_partition_files(spark, path, ["id", "a", "b", "c"], {"c": "bigint"}, ["id"])[1]
    lines = log.filter("lines > 0")
    return lines.groupBy("status").agg(
        F.count("*").alias("files"), F.sum("lines").alias("lines"), F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


@query("scan_csv_records", "id note part:i",
       sql=f"""SELECT {LINE_ID} AS id, CASE WHEN l_linenumber % 3 = 0 THEN 'line ' || CAST(l_linenumber AS VARCHAR) || chr(10) || 'said "yes", then' || chr(10) || 'no'
       WHEN l_linenumber % 3 = 1 THEN 'plain' END AS note, l_partkey AS part FROM lineitem""")
def _(spark, sf):
    folder = scratch_path(spark, "csv-records")
    number = F.col("l_linenumber")
    note = F.when(number % 3 == 0, F.concat(F.lit("line "), number.cast("string"), F.lit('\nsaid "yes", then\nno'))).when(number % 3 == 1, "plain")
    rows = v.table(spark, sf, "lineitem").select(F.expr(LINE_ID).alias("Id"), note.alias("Note"), F.col("l_partkey").alias("Part"), "l_orderkey")
    # files with different headers in one folder
    one = rows.filter("l_orderkey % 2 = 0").select("Id", "Note", "Part")
    other = rows.filter("l_orderkey % 2 = 1").select("Part", F.lit(1).alias("extra"), "Id", "Note")
    for part in (one, other):
        _in_files(part, 2).write.mode("append").option("header", True).option("escape", '"').csv(folder)
    return records.scan_csv_records(spark, folder, "id string, note string, part bigint")


PRICING = ["Pricing2015to2017.csv", "Pricing2018to2019.csv", "Pricing2020to2021.csv", "Pricing2022to2023.csv", "Pricing2024to2025.csv"]


@query("scan_fund_seed_files", "table rows:i", sql=" UNION ALL ".join(
       f"SELECT '{files.fund_seed_table(n)}' AS \"table\", count(DISTINCT l_partkey) AS rows FROM lineitem WHERE l_partkey % {len(schemas.FUND_SEEDS)} = {i}"
       for i, n in enumerate(schemas.FUND_SEEDS)) + " UNION ALL SELECT 'fund_quotes', count(*) FROM (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) FROM lineitem)")
def _(spark, sf):
    folder = scratch_path(spark, "seeds")
    line = v.table(spark, sf, "lineitem")
    # records repeat in every file
    holding = line.select(F.col("l_partkey").alias("RecordId"), F.col("l_quantity").alias("MarketPercent"))
    for i, name in enumerate(schemas.FUND_SEEDS):
        holding.filter(F.col("RecordId") % len(schemas.FUND_SEEDS) == i).write.option("header", True).csv(f"{folder}/{name}")
    nav = line.select(
        F.col("l_suppkey").alias("InstrumentKey"), F.col("l_shipdate").cast("date").alias("Date"), F.col("l_extendedprice").alias("NAVPS"))
    for i, name in enumerate(PRICING):
        part = nav.filter(F.year("Date") % len(PRICING) == i)
        # later files have a column more
        (part.withColumn("Split", F.lit(1)) if i else part).write.option("header", True).csv(f"{folder}/{name}")
    tables = files.scan_fund_seed_files(spark, folder, schemas.FUND_SEEDS)
    tables["fund_quotes"] = files.scan_pricing_files(spark, [f"{folder}/{n}" for n in PRICING])
    return agg.table_row_counts(tables)


@query("ingest_json_records", "symbol date:d adj_close:6 volume:i", "quotes", "SELECT symbol, date, adj_close, volume FROM quotes")
def _(spark, sf):
    # the vendor's shape: one object per symbol with its days (one per calendar day) in an array
    nested = v.quotes(spark, sf).groupBy("symbol").agg(
        F.collect_list(F.struct("date", F.col("adj_close").alias("adjClose"), "volume")).alias("historical"))
    schema = "symbol bigint, historical array<struct<date: date, adjClose: double, volume: bigint>>"
    return files.ingest_json_records(spark, _json(nested, spark, "json"), schema)


@query("ingest_profile_json", "symbol company_name mkt_cap:i price:6 is_etf ipo_date:d", "company",
       """SELECT CAST(symbol AS VARCHAR) AS symbol, company_name, CASE WHEN symbol % 7 = 0 THEN NULL
       ELSE CAST(round_even(mkt_cap, 0) AS BIGINT) END AS mkt_cap, mkt_cap / 100 AS price, symbol % 2 = 0 AS is_etf,
       CASE WHEN symbol % 3 = 0 THEN NULL ELSE DATE '2001-02-03' END AS ipo_date FROM company""")
def _(spark, sf):
    symbol = F.col("symbol")
    raw = v.company(spark, sf).select(
        symbol.cast("string").alias("symbol"), F.col("company_name").alias("companyName"),
        F.when(symbol % 7 == 0, "n/a").otherwise(F.col("mkt_cap").cast("string")).alias("mktCap"),
        (F.col("mkt_cap") / 100).alias("price"), (symbol % 2 == 0).alias("isEtf"),
        F.when(symbol % 3 == 0, "").otherwise("2001-02-03").alias("ipoDate"))
    return files.ingest_profile_json(spark, _json(raw, spark, "profile"))


@query("ingest_bulk_eod", "symbol date:d high:6 low:6 adj_close:6 volume:i", "quotes",
       "SELECT CAST(symbol AS VARCHAR) AS symbol, date, high, low, adj_close, volume FROM quotes")
def _(spark, sf):
    dump = v.quotes(spark, sf).select(
        "symbol", "date", F.col("low").alias("open"), "low", "high", F.col("adj_close").alias("close"),
        F.col("adj_close").alias("adjClose"), F.col("volume").cast("double").alias("volume"))
    return files.ingest_bulk_eod(spark, _csv(dump, spark, "eod"))


@query("ingest_treasury", "date:d month3:6 year1:6", "treasury", "SELECT date, month3, CAST(NULL AS DOUBLE) AS year1 FROM treasury")
def _(spark, sf):
    dump = v.treasury(spark, sf).select(F.col("date").alias("Date"), F.col("month3").alias("Month3"), F.lit("n/a").alias("Year1"))
    return files.ingest_treasury(spark, _csv(dump, spark, "treasury"))


# ---- sinks


@query("sink_csv_export", "table rows:i has_bytes",
       sql=" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows, true AS has_bytes FROM {t}" for t in ("orders", "customer", "nation")))
def _(spark, sf):
    tables = {t: v.table(spark, sf, t) for t in ("orders", "customer", "nation")}
    return sinks.sink_csv_export(tables, scratch_path(spark, "export")).withColumn("has_bytes", F.col("bytes") > 0)


@query("sink_append", "symbol peer_symbol copies:i", "peers",
       "SELECT symbol, peer_symbol, 2 * count(*) AS copies FROM peers GROUP BY 1, 2")
def _(spark, sf):
    path = scratch_path(spark, "append")
    peers = v.peers(spark, sf)
    sinks.sink_append(peers, path)
    sinks.sink_append(peers, path)
    return spark.read.parquet(path).groupBy("symbol", "peer_symbol").agg(F.count("*").alias("copies"))


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


@query("sink_replace", "symbol mkt_cap:6", "profile", "SELECT symbol, mkt_cap * 2 AS mkt_cap FROM profile")
def _(spark, sf):
    name = _table_name("replaced")
    sinks.sink_replace(v.profile(spark, sf).select("symbol", "mkt_cap"), name)
    # reads the table it replaces
    doubled = spark.table(name).withColumn("mkt_cap", F.col("mkt_cap") * 2)
    return sinks.sink_replace(doubled, name)


@query("sink_truncate_selective", "table rows:i",
       sql="SELECT 'profiles' AS \"table\", 0 AS rows UNION ALL SELECT 'peers', count(*) FROM customer")
def _(spark, sf):
    cleared, kept = _table_name("profiles"), _table_name("peers")
    sinks.sink_replace(v.profile(spark, sf), cleared)
    sinks.sink_replace(v.company(spark, sf), kept)
    sinks.sink_truncate_selective(spark, [cleared, kept], [cleared])
    return agg.table_row_counts({"profiles": spark.table(cleared), "peers": spark.table(kept)})


@query("export_price_json", "symbol equity_chart_price points:i", "quotes",
       """SELECT symbol, CAST(to_json(list(struct_pack(date := CAST(date AS VARCHAR), adj_close := adj_close) ORDER BY date)) AS VARCHAR)
       AS equity_chart_price, count(*) AS points FROM quotes GROUP BY 1""")
def _(spark, sf):
    return sinks.export_price_json(v.quotes(spark, sf))


@query("schema_evolve_widen", "symbol growth_rank growth_name volume:i", "quotes",
       "SELECT symbol, CAST(volume AS DOUBLE) AS growth_rank, 'x' AS growth_name, volume FROM quotes")
def _(spark, sf):
    rows = v.quotes(spark, sf).select("symbol", F.col("volume").alias("growth_rank"), F.lit("x").alias("growth_name"), "volume")
    widened = sinks.schema_evolve_widen(rows)
    if dict(widened.dtypes)["growth_rank"] != "double":
        raise AssertionError("growth_rank was not widened")
    return widened


@query("schema_align_to_target", "symbol date:d adj_close:6 high:6", "quotes",
       "SELECT symbol, date, adj_close, CAST(NULL AS DOUBLE) AS high FROM quotes")
def _(spark, sf):
    quotes = v.quotes(spark, sf)
    incoming = quotes.select(F.lit("x").alias("unknownColumn"), F.col("adj_close").alias("adjClose"), "symbol", "date")
    return sinks.schema_align_to_target(incoming, quotes.select("symbol", "date", "adj_close", "high"))


@query("concat_files_to_csv", "symbol:i sector mkt_cap:6", "profile company",
       "SELECT symbol, sector, mkt_cap FROM profile UNION ALL SELECT symbol, sector, NULL FROM company")
def _(spark, sf):
    path = scratch_path(spark, "concat")
    sinks.concat_files_to_csv([v.profile(spark, sf).select("symbol", "sector", "mkt_cap"), v.company(spark, sf).select("symbol", "sector")], path)
    return spark.read.schema("symbol bigint, sector string, mkt_cap double").option("header", True).csv(path)


# ---- layouts


@query("write_time_partitioned", "symbol date:d adj_close:6 year:i", "quotes", "SELECT symbol, date, adj_close, year(date) AS year FROM quotes")
def _(spark, sf):
    return sinks.write_time_partitioned(v.quotes(spark, sf), scratch_path(spark, "by-time"))


@query("write_bucketed", "symbol n:i", "quotes", "SELECT symbol, count(*) AS n FROM quotes GROUP BY 1")
def _(spark, sf):
    table = sinks.write_bucketed(v.quotes(spark, sf), _table_name("bucketed"))
    return table.groupBy("symbol").agg(F.count("*").alias("n"))


@query("write_clustered", "symbol sector mkt_cap:6", "company", "SELECT symbol, sector, mkt_cap FROM company")
def _(spark, sf):
    return sinks.write_clustered(v.company(spark, sf), scratch_path(spark, "clustered"), ["sector", "symbol"], bloom="symbol")


@query("refresh_aggregates", "identifier month:d opening_nav:6 closing_nav:6 trading_days:i", "quotes",
       """SELECT symbol AS identifier, CAST(date_trunc('month', date) AS DATE) AS month, arg_min(adj_close, date) AS opening_nav,
       arg_max(adj_close, date) AS closing_nav, count(*) AS trading_days FROM quotes GROUP BY 1, 2""")
def _(spark, sf):
    path = scratch_path(spark, "monthly")
    quotes = v.quotes(spark, sf).withColumnRenamed("symbol", "identifier")

    def monthly(rows):
        return agg.nav_monthly(rows, "identifier", "adj_close", "volume")

    early = quotes.filter("date < DATE '1999-06-15'")
    sinks.replace_partitions(monthly(early), path, "month")
    late = quotes.filter("date >= DATE '1999-06-15'")
    refresh_aggregates(quotes, late, path, "month", "month", monthly)
    return spark.read.parquet(path)


# ---- streams


def _calls_landing(spark, sf) -> tuple[str, str]:
    path = scratch_path(spark, "calls")
    v.api_calls(spark, sf).write.parquet(path)
    return path, "id bigint, endpoint string, ts timestamp, user_id bigint, response_time_ms double"


def _run(spark, stream, label: str):
    return jobs.stream_append(stream, scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint"))


# a window is final once the watermark (newest row minus the allowed lateness) has passed its end
FINAL = "<= (SELECT max(ts) - INTERVAL 10 MINUTE FROM api_calls)"


#: Files of the landing folder, over which the months are dealt.
LANDED = 64


@query("stream_quotes_upsert", "symbol date:d adj_close:6 volume:i", "quotes",
       "SELECT symbol, date, adj_close, volume FROM quotes")
def _(spark, sf):
    landing, path = scratch_path(spark, "eod-landing"), scratch_path(spark, "eod-table")
    quotes = v.quotes(spark, sf).select("symbol", "date", "adj_close", "volume")
    # a month lies in one file; the files are many, so that none holds much more than its months, and come in two batches
    quotes.repartition(LANDED, F.trunc("date", "month")).write.option("header", True).csv(landing)
    schema = "symbol bigint, date date, adj_close double, volume bigint"
    stream = jobs.read_landing(spark, landing, schema, "csv", header=True, maxFilesPerTrigger=LANDED // 2)
    jobs.stream_quotes_upsert(stream, path, scratch_path(spark, "eod-checkpoint"), "month").awaitTermination()
    return spark.read.parquet(path)


@query("stream_usage_tumbling", "minute:t endpoint call_count:i avg_response_time:6", "api_calls",
       f"""SELECT date_trunc('minute', ts) AS minute, endpoint, count(*) AS call_count, avg(response_time_ms) AS avg_response_time
       FROM api_calls GROUP BY 1, 2 HAVING date_trunc('minute', min(ts)) + INTERVAL 1 MINUTE {FINAL}""")
def _(spark, sf):
    return _run(spark, jobs.usage_tumbling(jobs.read_landing(spark, *_calls_landing(spark, sf))), "tumbling")


@query("stream_usage_sliding", "window_start:t endpoint call_count:i over_limit", "api_calls",
       f"""SELECT window_start, endpoint, count(*) AS call_count, count(*) >= 2 AS over_limit FROM
       (SELECT endpoint, time_bucket(INTERVAL 10 SECOND, ts) - to_seconds(10 * i) AS window_start FROM api_calls, range(6) AS r(i))
       GROUP BY 1, 2 HAVING window_start + INTERVAL 60 SECOND {FINAL}""")
def _(spark, sf):
    return _run(spark, jobs.usage_sliding(jobs.read_landing(spark, *_calls_landing(spark, sf)), limit=2), "sliding")


@query("stream_ohlcv_daily", "day:d endpoint open:6 high:6 low:6 close:6 volume:i", "api_calls",
       """SELECT CAST(ts AS DATE) AS day, endpoint, arg_min(response_time_ms, (ts, id)) AS open, max(response_time_ms) AS high,
       min(response_time_ms) AS low, arg_max(response_time_ms, (ts, id)) AS close, sum(user_id) AS volume FROM api_calls GROUP BY 1, 2
       HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM api_calls)""")
def _(spark, sf):
    ticks = jobs.read_landing(spark, *_calls_landing(spark, sf))
    return _run(spark, jobs.ohlcv_daily(ticks, "endpoint", "response_time_ms", "user_id", "id"), "ohlcv")


@query("stream_dedupe_records", "record_id", "records", "SELECT DISTINCT record_id FROM records")
def _(spark, sf):
    landing, path, checkpoint = (scratch_path(spark, n) for n in ("records", "deduped", "dedupe-checkpoint"))
    records = v.records(spark, sf).select("record_id", F.col("change_date").cast("timestamp").alias("ts"))
    # two deliveries of everything, far more than the watermark apart: the second one is refused by what is stored
    again = records.withColumn("ts", F.col("ts") + F.expr("interval 10 years"))
    for delivery in (records, again):
        delivery.write.mode("append").parquet(landing)
        rows = jobs.read_landing(spark, landing, "record_id bigint, ts timestamp")
        jobs.stream_dedupe_records(rows, "record_id", "ts", path, checkpoint, late="30 days").awaitTermination()
    return spark.read.parquet(path).select("record_id")


@query("stream_file_ledger", "n_records:i runs:i", "api_calls",
       "SELECT 2 * count(*) AS n_records, 2 AS runs FROM api_calls")
def _(spark, sf):
    landing, schema = _calls_landing(spark, sf)
    path, checkpoint = scratch_path(spark, "ledger"), scratch_path(spark, "ledger-checkpoint")
    jobs.stream_file_ledger(jobs.read_landing(spark, landing, schema), path, checkpoint).awaitTermination()
    # files that arrive later are taken alone; the first ones are skipped
    v.api_calls(spark, sf).write.mode("append").parquet(landing)
    jobs.stream_file_ledger(jobs.read_landing(spark, landing, schema), path, checkpoint).awaitTermination()
    return spark.read.parquet(path).agg(F.sum("records_count").alias("n_records"), F.countDistinct("batch").alias("runs"))


# ---- quality


MINIMUMS = {"customer": 10, "supplier": 1_000_000, "part": 10, "orders": 1_000_000_000, "equity_income": 270_000}


@query("under_seeded_tables", "table rows:i minimum:i", sql="SELECT * FROM (" + " UNION ALL ".join(
       f"SELECT '{t}' AS \"table\", {'count(*)' if t != 'equity_income' else '0'} AS rows, {m} AS minimum"
       + (f" FROM {t}" if t != "equity_income" else "") for t, m in MINIMUMS.items()) + ") WHERE rows < minimum")
def _(spark, sf):
    tables = {t: v.table(spark, sf, t) for t in MINIMUMS if t != "equity_income"}
    return quality.under_seeded_tables(spark, tables, MINIMUMS)


@query("critical_load_check", "critical_failures:i files_ok quotes_ok loaded", "api_calls",
       """SELECT ((SELECT count(*) FROM customer) < 10)::BIGINT + ((SELECT count(*) FROM orders) < 1000000000)::BIGINT AS critical_failures,
       avg(ok) >= 0.6 AS files_ok, coalesce(min(ok) FILTER (endpoint = 'click') = 1, false) AND coalesce(min(ok) FILTER (endpoint = 'view') = 1, false) AS quotes_ok,
       false AS loaded FROM (SELECT endpoint, user_id, max((response_time_ms > 5)::INT) AS ok FROM api_calls GROUP BY 1, 2)""")
def _(spark, sf):
    tables = {t: v.table(spark, sf, t) for t in ("customer", "orders")}
    # the calls as a ledger: a user is a file that may be tried several times
    return quality.critical_load_check(
        spark, tables, {"customer": 10, "orders": 1_000_000_000}, v.api_calls(spark, sf), "user_id", "endpoint", F.col("response_time_ms") > 5, ["click", "view"])


@query("download_coverage", "endpoint files:i succeeded:i success_ratio:6 complete", "api_calls",
       """SELECT endpoint, count(*) AS files, count(*) FILTER (response_time_ms > 5) AS succeeded,
       count(*) FILTER (response_time_ms > 5) / count(*) AS success_ratio,
       count(*) FILTER (response_time_ms > 5) / count(*) >= 0.8 AS complete FROM api_calls GROUP BY 1""")
def _(spark, sf):
    return quality.download_coverage(v.api_calls(spark, sf), "endpoint", F.col("response_time_ms") > 5)


CHECKED = ["return_on_equity", "interest_coverage", "price_earnings_to_growth_ratio"]


@query("metric_availability", "symbol metric available", "ratios", " UNION ALL ".join(
       f"SELECT symbol, '{m}' AS metric, count({m}) > 0 AS available FROM ratios GROUP BY 1" for m in CHECKED))
def _(spark, sf):
    return quality.metric_availability(v.ratios(spark, sf), CHECKED)


@query("history_coverage", "symbol metric records:i first_date:d last_date:d sufficient", "quotes ratios", " UNION ALL ".join(
       f"""SELECT symbol, '{m}' AS metric, count({m}) AS records, min(date) FILTER ({m} IS NOT NULL) AS first_date,
       max(date) FILTER ({m} IS NOT NULL) AS last_date, count({m}) >= 2 AS sufficient FROM ratios
       WHERE date >= (SELECT max(date) FROM quotes) - INTERVAL 12 MONTH GROUP BY 1""" for m in CHECKED))
def _(spark, sf):
    return quality.history_coverage(v.ratios(spark, sf), {m: 2 for m in CHECKED}, month_end_list(spark, sf)[-1])


@query("duplicate_key_report", "l_orderkey l_linenumber:i copies:i",
       sql="SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, sf):
    return upsert.duplicate_keys(v.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("run_log", "task status records_processed:i errors:i", "messy",
       """SELECT 'load messy' AS task, 'completed' AS status, count(*) FILTER (l_partkey % 6 IN (0, 1, 5)) AS records_processed,
       count(*) FILTER (l_partkey % 6 IN (2, 3, 4)) AS errors FROM messy UNION ALL SELECT 'load orders', 'completed', count(*), 0 FROM orders""")
def _(spark, sf):
    messy = v.messy(spark, sf)
    rules = quality.required_fields(messy, ["name_text", "int_text"])
    log = quality.RunLog(spark)
    log.write("load messy", messy.select("l_orderkey", "name_text", "int_text"), scratch_path(spark, "messy"), rules)
    log.write("load orders", v.table(spark, sf, "orders"), scratch_path(spark, "orders"))
    return log.rows()
