"""Market-data views over the generated test tables, in the column names the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ship_day():
    return F.col("l_shipdate").cast("date")


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    """One row per symbol and day. The aggregate combines map-side, so a hot symbol cannot pile up."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("symbol"), _ship_day().alias("date"))
        .agg(
            F.max("l_extendedprice").alias("adj_close"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
    )


def _places(spark: SparkSession, sf: str) -> DataFrame:
    """Nation with its region: both tables have a fixed size (25 and 5 rows)."""
    region = table(spark, sf, "region")
    return table(spark, sf, "nation").join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))


def _currency(key: str):
    return F.when(F.col(key) % 2 == 0, "USD").otherwise("CAD")


def profile(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "supplier")
        .join(F.broadcast(_places(spark, sf)), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("symbol"),
            F.col("s_name").alias("company_name"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("industry"),
            _currency("s_suppkey").alias("currency"),
            F.col("s_acctbal").alias("mkt_cap"),
        )
    )


def company(spark: SparkSession, sf: str) -> DataFrame:
    """A larger universe with the profile's columns; every 50th cap is missing."""
    return (
        table(spark, sf, "customer")
        .join(F.broadcast(_places(spark, sf)), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("symbol"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("sector"),
            F.col("n_name").alias("industry"),
            _currency("c_custkey").alias("currency"),
            F.when(F.col("c_custkey") % 50 != 0, F.col("c_acctbal")).alias("mkt_cap"),
        )
    )


def etf_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Funds from the part table; some expense ratios and sizes are missing."""
    key = F.col("p_partkey")
    return table(spark, sf, "part").select(
        key.alias("symbol"),
        F.col("p_name").alias("name"),
        F.when(key % 2 == 0, "USD").otherwise("CAD").alias("currency"),
        F.substring("p_brand", 1, 7).alias("domicile"),
        F.substring("p_type", 1, 1).alias("asset_class"),
        F.when(key % 11 != 0, F.col("p_size") / 100.0).alias("expense_ratio"),
        F.when(key % 13 != 0, F.col("p_retailprice") * (1 + key % 7)).alias("aum"),
        F.col("p_retailprice").alias("price"),
    )


PEER_STEPS = [s for s in range(-9, 10) if s]


def _neighbours(base: DataFrame, same: str) -> DataFrame:
    """Edges to the symbols at most nine away in the same class: 18 candidates per symbol, then an equi-join."""
    other = base.select(F.col("symbol").alias("peer_symbol"), F.col(same).alias("_class"))
    return (
        base.select("symbol", same, F.explode(F.array(*[F.lit(s) for s in PEER_STEPS])).alias("_step"))
        .select("symbol", same, (F.col("symbol") + F.col("_step")).alias("peer_symbol"))
        .join(other, "peer_symbol")
        .filter(F.col(same) == F.col("_class"))
        .select("symbol", "peer_symbol")
    )


def peers(spark: SparkSession, sf: str) -> DataFrame:
    return _neighbours(profile(spark, sf), "sector")


def company_peers(spark: SparkSession, sf: str) -> DataFrame:
    return _neighbours(company(spark, sf), "sector")


def etf_peers(spark: SparkSession, sf: str) -> DataFrame:
    return _neighbours(etf_profile(spark, sf), "domicile")


def _quarter():
    return F.date_trunc("quarter", "l_shipdate").cast("date").alias("date")


def ratios(spark: SparkSession, sf: str) -> DataFrame:
    n = F.count("*")
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("symbol"), _quarter())
        .agg(
            F.max("l_discount").alias("return_on_equity"),
            F.max("l_tax").alias("net_profit_margin"),
            F.min("l_discount").alias("operating_profit_margin"),
            (n / 10.0).alias("debt_equity_ratio"),
            (F.max("l_quantity") / F.min("l_quantity")).alias("current_ratio"),
            F.when(n % 4 != 0, F.max("l_quantity")).alias("interest_coverage"),
            (F.max("l_extendedprice") / F.max("l_quantity")).alias("price_earnings_ratio"),
            (F.min("l_extendedprice") / 1000.0).alias("price_to_book_ratio"),
            F.when(n % 3 != 0, F.min("l_quantity")).alias("price_earnings_to_growth_ratio"),
        )
    )


def growth(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .filter("l_linenumber <= 3")
        .groupBy(F.col("l_suppkey").alias("symbol"), _quarter())
        .agg(
            (F.max("l_tax") - F.min("l_tax")).alias("revenue_growth"),
            (F.max("l_discount") - F.max("l_tax")).alias("three_y_revenue_growth_per_share"),
            (F.min("l_discount") - F.max("l_tax")).alias("three_y_net_income_growth_per_share"),
        )
    )


def key_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Key metrics start a little later than the ratios, so some as-of pairs are one-sided."""
    return (
        table(spark, sf, "lineitem")
        .filter("l_linenumber = 1")
        .groupBy(F.col("l_suppkey").alias("symbol"), _quarter())
        .agg(F.max("l_discount").alias("roe"))
    )


def income(spark: SparkSession, sf: str) -> DataFrame:
    price = "l_extendedprice"
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("symbol"), _quarter())
        .agg(
            (F.max(price) * 3).alias("revenue"), F.max(price).alias("gross_profit"), (F.max(price) - F.min(price)).alias("operating_income"),
            (F.min(price) * F.max("l_discount")).alias("net_income"), (F.max("l_tax") * 10).alias("eps"), (F.max(price) / 2).alias("ebitda"),
        )
    )


def balance(spark: SparkSession, sf: str) -> DataFrame:
    """Balances come a little earlier than the income statements; some have no current liabilities."""
    price = "l_extendedprice"
    return (
        table(spark, sf, "lineitem")
        .filter("l_linenumber <= 3")
        .groupBy(F.col("l_suppkey").alias("symbol"), _quarter())
        .agg(
            (F.max(price) * 20).alias("total_assets"), (F.max(price) * 5).alias("current_assets"), (F.min(price) * 8).alias("total_liabilities"),
            (F.min(price) * (F.count("*") % 3)).alias("current_liabilities"), (F.max(price) * 20 - F.min(price) * 8).alias("total_equity"),
            (F.min(price) * 3).alias("total_debt"),
        )
    )


def cash_flow(spark: SparkSession, sf: str) -> DataFrame:
    price = "l_extendedprice"
    return (
        table(spark, sf, "lineitem")
        .filter("l_linenumber = 2")
        .groupBy(F.col("l_suppkey").alias("symbol"), _quarter())
        .agg((F.max(price) / 4).alias("operating_cash_flow"), (F.max(price) / 4 - F.min(price) / 5).alias("free_cash_flow"))
    )


def financial_scores(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("symbol"), (F.col("s_acctbal") / 1000).alias("altman"), (F.col("s_suppkey") % 10).alias("piotroski"))


def fund_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Stored fund scores: a row per symbol and month with quotes."""
    key = F.col("l_suppkey") * 13 + F.month("l_shipdate")
    return (
        table(spark, sf, "lineitem")
        .select(F.col("l_suppkey").alias("symbol"), F.last_day(_ship_day()).alias("date"), key.alias("_k"))
        .distinct()
        .select("symbol", "date", (F.col("_k") % 101).alias("performance"), (F.col("_k") % 83).alias("risk"), (F.col("_k") % 97).alias("management"),
                (F.col("_k") % 89).alias("total_score"))
    )


def benchmark_close(spark: SparkSession, sf: str) -> DataFrame:
    """The benchmark: at most one row per calendar day."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.max("o_totalprice").alias("close"))
    )


def treasury(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse risk-free rate in percent: at most one row per calendar day."""
    return (
        table(spark, sf, "lineitem")
        .filter(F.dayofmonth("l_shipdate") % 3 == 0)
        .groupBy(_ship_day().alias("date"))
        .agg((F.max("l_tax") * 100).alias("month3"))
    )


def holdings(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier")
    nation = table(spark, sf, "nation")
    return (
        table(spark, sf, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("l_orderkey").alias("etf_symbol"), F.col("l_partkey").alias("asset"), F.col("n_name").alias("country"))
        .agg(F.max("l_extendedprice").alias("market_value"))
    )


def api_calls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("endpoint"),
        "ts",
        "user_id",
        F.col("value").alias("response_time_ms"),
    )


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Change records; a record_id repeats."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("record_id"),
        _ship_day().alias("change_date"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
    )


def dirty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Five kinds of malformed three-column CSV line."""
    part = F.col("l_partkey").cast("string")
    kind = F.col("l_orderkey") % 5
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(kind == 0, F.concat(F.lit('"October '), F.col("l_linenumber").cast("string"), F.lit(', 12",'), part, F.lit(",3")))
        .when(kind == 1, F.concat(F.lit('"open,'), part))
        .when(kind == 2, part)
        .when(kind == 3, F.concat(F.lit(" null , None,"), part))
        .otherwise(F.concat(F.lit("a,b,"), part, F.lit(",extra")))
        .alias("line"),
    )


def messy(spark: SparkSession, sf: str) -> DataFrame:
    """Text columns as vendors send them: blanks, spellings of NULL, bad values, several date formats."""
    kind = F.col("l_partkey") % 6
    part = F.col("l_partkey").cast("string")
    day = F.col("l_shipdate")

    def by_kind(*values):
        c = F.when(kind == 0, values[0])
        for i, value in enumerate(values[1:], 1):
            c = c.when(kind == i, value)
        return c

    lit, text = F.lit, lambda: F.lit(None).cast("string")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        by_kind(part, F.concat(lit(" "), part, lit(" ")), lit(""), lit("abc"), text(), lit("-7")).alias("int_text"),
        by_kind(
            F.concat(part, lit(".25")), F.concat(lit(" -"), part, lit(".5 ")), lit(" "), lit("NaN?"), text(), lit("1e3")
        ).alias("float_text"),
        by_kind(lit("true"), lit(" FALSE "), lit(""), lit("maybe"), text(), lit("1")).alias("bool_text"),
        by_kind(
            F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "MM/dd/yyyy"), F.date_format(day, "dd/MM/yyyy"),
            lit(" "), lit("soon"), text(),
        ).alias("date_text"),
        by_kind(F.concat(part, lit(".5")), F.concat(part, lit(".0")), part, lit("x"), lit(""), text()).alias("volume_text"),
        by_kind(F.concat(part, lit(".5%")), F.concat(part, lit("%")), part, lit("%"), lit("n%a"), text()).alias("percent_text"),
        by_kind(
            F.concat(lit("$1,"), F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0"), lit(".75")),
            F.concat(lit(" $"), part), part, lit("free"), lit("$"), text(),
        ).alias("money_text"),
        by_kind(
            F.concat(part, lit(".455")), F.concat(lit("0."), F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0")),
            lit("N/A"), lit("none"), lit("invalid"), lit("999999999999.99"),
        ).alias("decimal_text"),
        by_kind(F.concat(lit("  "), part, lit(" Growth Fund of the Month  ")), part, lit("  "), lit(""), text(), lit("x")).alias("name_text"),
        by_kind(lit("NYSE"), lit(" nasdaq"), lit("TSX"), lit("LSE"), text(), lit("AMEX")).alias("exchange"),
        (F.col("l_extendedprice") - 1000 * (kind == 5).cast("int") * 1000).alias("mkt_cap"),
        F.col("l_quantity").alias("price"),
        F.col("l_tax").alias("split"),
        "l_extendedprice",
        "l_discount",
    )
