"""Line repair, typing, validation and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerlake.functions import cleaning as cl
from tickerlake.functions.naming import lower_columns, snake_columns
from tickerlake.operators import joins, quality, universe, upsert
from tickerlake.registry.core import query
from tickerlake.sources import files, views as v

LINE_KEY = "l_orderkey l_linenumber:i"

# the four kinds of dirty line after each step, spelled out per kind
OCTOBER = "concat('\"October ', CAST(l_linenumber AS VARCHAR), ' 12\",', CAST(l_partkey AS VARCHAR), ',3')"
PART = "CAST(l_partkey AS VARCHAR)"


@query("csv_fix_month_comma", f"{LINE_KEY} fixed", "dirty_lines",
       f"SELECT *, CASE WHEN l_orderkey % 5 = 0 THEN {OCTOBER} ELSE line END AS fixed FROM dirty_lines")
def _(spark, sf):
    return v.dirty_lines(spark, sf).withColumn("fixed", cl.fix_month_comma(F.col("line")))


@query("csv_fix_unterminated_quote", f"{LINE_KEY} fixed", "dirty_lines",
       """SELECT *, CASE WHEN (length(line) - length(replace(line, '"', ''))) % 2 = 1 AND line NOT LIKE '%"'
       THEN line || '"' ELSE line END AS fixed FROM dirty_lines""")
def _(spark, sf):
    return v.dirty_lines(spark, sf).withColumn("fixed", cl.fix_unterminated_quote(F.col("line")))


@query("csv_pad_columns", f"{LINE_KEY} fixed", "dirty_lines",
       """SELECT *, line || repeat(',', greatest(3 - len(string_split(regexp_replace(line, '"[^"]*"', 'q', 'g'), ',')), 0)) AS fixed
       FROM dirty_lines WHERE l_orderkey % 5 <> 1""")
def _(spark, sf):
    closed = v.dirty_lines(spark, sf).filter(~cl.has_open_quote(F.col("line")))
    return closed.withColumn("fixed", cl.pad_columns(F.col("line"), 3))


CLEANED = f"""CASE l_orderkey % 5 WHEN 0 THEN {OCTOBER} WHEN 1 THEN concat('"open,', {PART}, '",,') WHEN 2 THEN {PART} || ',,'
    WHEN 3 THEN 'null , None,' || {PART} ELSE concat('a,b,', {PART}, ',extra') END"""


@query("csv_clean_line", f"{LINE_KEY} fixed", "dirty_lines", f"SELECT *, {CLEANED} AS fixed FROM dirty_lines")
def _(spark, sf):
    return v.dirty_lines(spark, sf).withColumn("fixed", cl.clean_line(F.col("line"), 3))


CELLS = f"""SELECT l_orderkey, l_linenumber,
    CASE l_orderkey % 5 WHEN 0 THEN 'October ' || CAST(l_linenumber AS VARCHAR) || ' 12' WHEN 1 THEN 'open,' || {PART}
        WHEN 2 THEN {PART} WHEN 4 THEN 'a' END AS a,
    CASE l_orderkey % 5 WHEN 0 THEN {PART} WHEN 4 THEN 'b' END AS b,
    CASE l_orderkey % 5 WHEN 0 THEN '3' WHEN 3 THEN {PART} WHEN 4 THEN {PART} END AS c FROM dirty_lines"""


@query("csv_normalise_cells", f"{LINE_KEY} a b c", "dirty_lines", CELLS)
def _(spark, sf):
    lines = v.dirty_lines(spark, sf).select("l_orderkey", "l_linenumber", "line")
    return files.parse_lines(lines, "line", ["a", "b", "c"])


@query("csv_quarantine", f"{LINE_KEY} line reason", "dirty_lines",
       """SELECT *, CASE l_orderkey % 5 WHEN 1 THEN 'open quote' WHEN 4 THEN 'too many fields' ELSE 'b is not a bigint' END AS reason
       FROM dirty_lines WHERE l_orderkey % 5 IN (1, 3, 4)""")
def _(spark, sf):
    lines = v.dirty_lines(spark, sf)
    return files.split_parsable(lines, "line", ["a", "b", "c"], {"b": "bigint"})[1]


@query("header_lowercase", "n_nationkey:i n_name n_regionkey:i", sql="SELECT * FROM nation")
def _(spark, sf):
    nation = v.table(spark, sf, "nation")
    return lower_columns(nation.toDF(*[c.upper() for c in nation.columns]))


@query("camel_to_snake", "user_id ts_text:t event_type n_events:i", "api_calls",
       "SELECT user_id, ts AS ts_text, endpoint AS event_type, 1 AS n_events FROM api_calls")
def _(spark, sf):
    calls = v.api_calls(spark, sf).select(
        F.col("user_id").alias("userId"), F.col("ts").alias("tsText"), F.col("endpoint").alias("eventType"), F.lit(1).alias("nEvents"))
    return snake_columns(calls)


MESSY = "l_orderkey l_linenumber:i l_partkey value"


def _typed(name: str, kind: str, sql_value: str, column, source: str) -> None:
    @query(name, f"{MESSY}{kind}", "messy", f"SELECT *, {sql_value} AS value FROM messy")
    def _(spark, sf):
        return v.messy(spark, sf).withColumn("value", column(F.col(source)))


def _try(column: str, to: str) -> str:
    return f"TRY_CAST(nullif(trim({column}), '') AS {to})"


_typed("safe_int", ":i", _try("int_text", "BIGINT"), cl.safe_int, "int_text")
_typed("safe_float", ":6", _try("float_text", "DOUBLE"), cl.safe_float, "float_text")
_typed("numeric_coerce", ":6", _try("money_text", "DOUBLE"), cl.safe_float, "money_text")
_typed("safe_date", ":d", "CAST(try_strptime(nullif(trim(date_text), ''), '%Y-%m-%d') AS DATE)", cl.safe_date, "date_text")
_typed("datetime_coerce", ":t", "CAST(try_strptime(nullif(trim(date_text), ''), '%Y-%m-%d') AS TIMESTAMP)", cl.safe_timestamp, "date_text")
_typed("safe_bool", "", _try("bool_text", "BOOLEAN"), cl.safe_bool, "bool_text")
_typed("decimal_string_to_bigint", ":i",
       "CAST(round_even(TRY_CAST(nullif(trim(volume_text), '') AS DOUBLE), 0) AS BIGINT)", cl.decimal_text_to_bigint, "volume_text")
_typed("parse_percent", ":6", "TRY_CAST(nullif(rtrim(trim(percent_text), '%'), '') AS DOUBLE)", cl.parse_percent, "percent_text")
_typed("parse_money_decimal", ":6", "TRY_CAST(nullif(trim(replace(replace(money_text, '$', ''), ',', '')), '') AS DOUBLE)",
       cl.parse_money, "money_text")
_typed("parse_date_multi_format", ":d", """coalesce(CAST(try_strptime(trim(date_text), '%Y-%m-%d') AS DATE),
       CAST(try_strptime(trim(date_text), '%m/%d/%Y') AS DATE), CAST(try_strptime(trim(date_text), '%d/%m/%Y') AS DATE))""",
       cl.parse_date_any, "date_text")
_typed("decimal_standardise", ":2", "TRY_CAST(decimal_text AS DECIMAL(14, 2))", cl.standard_decimal, "decimal_text")
_typed("truncate_strings", "", "nullif(trim(substr(trim(name_text), 1, 12)), '')",
       lambda c: cl.clip_text(c, 12, trim_end=True), "name_text")


@query("case_when_null_empty", f"{MESSY}:i missing:i", "messy",
       f"SELECT l_partkey % 6 AS l_orderkey, 0 AS l_linenumber, 0 AS l_partkey, count({_try('int_text', 'BIGINT')}) AS value, "
       f"count(*) - count({_try('int_text', 'BIGINT')}) AS missing FROM messy GROUP BY 1")
def _(spark, sf):
    value = files.cast_staged(v.messy(spark, sf).select("int_text", F.col("l_partkey").cast("string").alias("part")),
                              {"int_text": "bigint", "part": "bigint"})
    return value.groupBy((F.col("part") % 6).alias("l_orderkey")).agg(
        F.count("int_text").alias("value"), (F.count("*") - F.count("int_text")).alias("missing")
    ).withColumns({"l_linenumber": F.lit(0), "l_partkey": F.lit(0).cast("int")})


@query("filter_required_key", "l_orderkey l_linenumber:i l_partkey name_text", "messy",
       "SELECT * FROM messy WHERE name_text IS NOT NULL AND trim(name_text) <> ''")
def _(spark, sf):
    return upsert.required_key(v.messy(spark, sf), ["name_text"])


@query("validate_record", "l_orderkey l_linenumber:i l_partkey violations:s", "messy",
       """SELECT *, CASE WHEN l_partkey % 6 = 3 THEN 'name_text'
       WHEN l_partkey % 6 = 4 THEN 'name_text,int_text' ELSE 'int_text' END AS violations FROM messy WHERE l_partkey % 6 IN (2, 3, 4)""")
def _(spark, sf):
    rows = v.messy(spark, sf)
    rejected = quality.split_valid(rows, quality.required_fields(rows, ["name_text", "int_text"]))[1]
    return rejected.withColumn("violations", F.array_join("violations", ","))


@query("validate_profile_domain", "l_orderkey l_linenumber:i l_partkey violations", "messy",
       """SELECT *, concat_ws(',', CASE WHEN upper(trim(exchange)) NOT IN ('NYSE', 'NASDAQ', 'AMEX', 'TSX', 'TSXV') THEN 'exchange' END,
       CASE WHEN mkt_cap < 0 OR mkt_cap > 1e14 THEN 'market_cap' END) AS violations FROM messy""")
def _(spark, sf):
    checked = quality.with_violations(v.messy(spark, sf), quality.profile_rules())
    return checked.withColumn("violations", F.array_join("violations", ","))


@query("validate_price_row", "l_orderkey l_linenumber:i l_partkey violations", "messy",
       """SELECT *, concat_ws(',', CASE WHEN mkt_cap < 0 THEN 'mkt_cap' END, CASE WHEN split <= 0 THEN 'split' END) AS violations
       FROM messy WHERE mkt_cap < 0 OR split <= 0""")
def _(spark, sf):
    rules = quality.price_rules(["mkt_cap", "l_extendedprice"], "price", "split")
    rejected = quality.split_valid(v.messy(spark, sf), rules)[1]
    return rejected.withColumn("violations", F.array_join("violations", ","))


@query("screener_filter", "symbol", "company",
       """SELECT DISTINCT symbol FROM company WHERE sector IN ('BUILDING', 'MACHINERY') AND currency = 'USD' AND mkt_cap > 1000
       AND symbol % 4 <> 0""")
def _(spark, sf):
    cap = F.col("mkt_cap")
    listed = v.company(spark, sf).select(
        "symbol", F.col("sector").alias("exchange_short_name"), F.col("currency").alias("country"), cap.alias("price"),
        cap.alias("vol_avg"), F.lit(False).alias("is_etf"), (F.col("symbol") % 4 != 0).alias("is_actively_trading"))
    return universe.screener_filter(listed, ["BUILDING", "MACHINERY"], "USD", 1, 1000)


@query("etf_profile_filter", "symbol name price:6", "etf_profile", "SELECT * FROM etf_profile WHERE price > 1 AND aum > 1000")
def _(spark, sf):
    return universe.etf_profile_filter(v.etf_profile(spark, sf), "aum", 1, 1000)


@query("as_of_date_filter", "symbol date:d adj_close:6", "quotes", "SELECT * FROM quotes WHERE date <= DATE '1998-06-30'")
def _(spark, sf):
    return v.quotes(spark, sf).filter("date <= DATE '1998-06-30'")


@query("filter_in_list", "symbol date:d adj_close:6", "quotes profile",
       "SELECT * FROM quotes WHERE symbol IN (SELECT symbol FROM profile WHERE currency = 'USD')")
def _(spark, sf):
    return joins.filter_in_list(v.quotes(spark, sf), v.profile(spark, sf).filter("currency = 'USD'"), "symbol")


@query("clean_fund_quote_row", "identifier record_state date:d navps:6 navps_percent_change:6 split", "messy",
       """SELECT CAST(l_partkey AS VARCHAR) AS identifier, 'Active' AS record_state,
       coalesce(CAST(try_strptime(trim(date_text), '%Y-%m-%d') AS DATE), CAST(try_strptime(trim(date_text), '%m/%d/%Y') AS DATE),
       CAST(try_strptime(trim(date_text), '%d/%m/%Y') AS DATE)) AS date,
       TRY_CAST(nullif(trim(replace(replace(money_text, '$', ''), ',', '')), '') AS DOUBLE) AS navps,
       TRY_CAST(nullif(trim(float_text), '') AS DOUBLE) AS navps_percent_change, nullif(trim(int_text), '') AS split FROM messy""")
def _(spark, sf):
    from tickerlake.operators.funds import clean_fund_quote_rows

    raw = v.messy(spark, sf).select(
        F.col("l_partkey").cast("string").alias("InstrumentKey"), F.col("date_text").alias("Date"),
        F.col("money_text").alias("NAVPS"), F.col("float_text").alias("NAVPSPercentChange"), F.col("int_text").alias("Split"))
    return clean_fund_quote_rows(raw)


@query("fund_quotes_transform", "instrument_key:i date navps split_factor distribution_pay_date", "messy",
       """SELECT l_partkey AS instrument_key, date_text AS date, money_text AS navps, int_text AS split_factor,
       CAST(NULL AS VARCHAR) AS distribution_pay_date FROM messy""")
def _(spark, sf):
    raw = v.messy(spark, sf).select(
        F.col("l_partkey").alias("InstrumentKey"), F.col("date_text").alias("Date"), F.col("money_text").alias("NAVPS"),
        F.col("int_text").alias("Split"))
    return files.fund_quotes_transform(raw)
