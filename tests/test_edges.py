"""Cases that small tables do not show: no caps, missing and bad values, table versions."""

import os
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tickerlake.functions.cleaning import standard_decimal
from tickerlake.jobs import load_quotes
from tickerlake.operators import aggregates, skew, timeseries, topk, universe, upsert
from tickerlake.session import scratch_path
from tickerlake.sources.sinks import sink_replace


def test_a_sector_of_any_size_is_ranked(spark):
    rows = spark.range(3000).selectExpr("id AS symbol", "IF(id < 2500, 'A', 'B') AS sector", "CAST(1 + id % 700 AS double) AS mkt_cap")
    ranked = topk.rank_in_sector(rows)
    assert ranked.count() == 3000
    assert ranked.groupBy("sector").agg(F.max("rank"), F.countDistinct("rank")).where("sector = 'A'").first()[1:] == (2500, 2500)


def test_screener_has_no_limit_of_its_own(spark):
    listed = spark.range(12_000).selectExpr(
        "CAST(id AS string) AS symbol", "'TSX' AS exchange_short_name", "'CA' AS country", "5.0 AS price", "50000 AS vol_avg", "false AS is_etf", "true AS is_actively_trading"
    )
    assert universe.screener_filter(listed, **universe.CANADA_STOCKS).count() == 12_000
    assert universe.screener_filter(listed, **universe.CANADA_STOCKS, limit=5).count() == 5


def test_large_amounts_keep_their_value(spark):
    df = spark.createDataFrame([("3400000000000.005",), ("0.045",), ("n/a",)], "t string")
    assert [r[0] for r in df.select(standard_decimal(F.col("t"))).collect()] == [Decimal("3400000000000.01"), Decimal("0.05"), None]


def test_windows_longer_than_a_block(spark):
    start = datetime(2020, 1, 1)
    calls = spark.createDataFrame([("k", start + timedelta(seconds=s)) for s in (0, 3700, 7300, 20_000)], "key string, ts timestamp")
    found = timeseries.trailing_window_count(calls, "key", "ts", 7200, 2).orderBy("second").collect()
    assert [r["trailing_calls"] for r in found] == [1, 2, 2, 1]
    assert [r["over_limit"] for r in found] == [False, True, True, False]


def test_month_without_a_last_value(spark):
    rows = [("s", date(2020, 1, 31), 10.0), ("s", date(2020, 2, 10), 20.0), ("s", date(2020, 2, 20), None), ("s", date(2020, 3, 5), None)]
    found = timeseries.month_last(spark.createDataFrame(rows, "symbol string, date date, v double"), "v")
    assert [r["v"] for r in found.orderBy("month").collect()] == [10.0, 20.0, 20.0]


def test_short_series_are_marked(spark):
    rows = [("a", date(2020, 1, 1) + timedelta(i), float(i)) for i in range(5)] + [("b", date(2020, 1, 1), 1.0)]
    found = {r["symbol"]: (r["n"], r["complete"]) for r in timeseries.rolling_stddev(spark.createDataFrame(rows, "symbol string, date date, v double"), "v", 5).collect()}
    assert found == {"a": (5, True), "b": (1, False)}


def test_bad_dates_are_no_news(spark):
    target = spark.createDataFrame([("2020-01-05",), ("n/a",)], "date string")
    batch = spark.createDataFrame([("2020-01-04",), ("n/a",), (None,), ("2020-01-06",)], "date string")
    assert [r[0] for r in upsert.delta_after_watermark(target, batch).collect()] == ["2020-01-06"]


def test_equal_values_do_not_keep_a_hot_group_together(spark):
    """90 % zeros in one group: the pieces are cut by the symbol, not by the value."""
    rows = spark.range(4000).selectExpr("id AS symbol", "'g' AS category", "IF(id % 10 = 0, CAST(id AS double), 0.0) AS v")
    assert aggregates.category_average(rows, "category", "v").count() == 4000
    pieces = rows.withColumn("piece", F.pmod(F.xxhash64("symbol"), F.lit(4))).groupBy("piece").count()
    assert pieces.agg(F.max("count")).first()[0] < 1200
    cut = skew.join_unique(rows, rows.groupBy("category").agg(F.max("v").alias("top")), ["category"], "symbol")
    assert cut.count() == 4000 and "_piece" not in cut.columns


def test_replacing_twice_in_one_root(spark, tmp_path):
    root = str(tmp_path)
    for n in (3, 5, 7):
        table = sink_replace(spark.range(n).withColumnRenamed("id", "v"), "edges_twice", root)
        assert table.count() == spark.table("edges_twice").count() == n
    versions = [d for d in os.listdir(f"{root}/edges_twice.versions") if d.startswith("version-")]
    assert len(versions) == 2
    spark.sql("DROP TABLE edges_twice")


def test_tables_do_not_live_in_scratch(spark):
    sink_replace(spark.range(4), "edges_place")
    place = spark.sql("DESCRIBE TABLE EXTENDED edges_place").where("col_name = 'Location'").first()["data_type"]
    assert os.path.dirname(scratch_path(spark, "x")) not in place
    spark.sql("DROP TABLE edges_place")


def test_first_load_is_deduplicated(spark, tmp_path):
    from tickerlake.sources import schemas

    names = [c.split()[0] for c in schemas.QUOTE_SCHEMA.split(", ")]
    types = [c.split()[1] for c in schemas.QUOTE_SCHEMA.split(", ")]
    value = lambda n, t: {"symbol": "A", "date": "2020-01-02"}.get(n, "1" if t != "string" else "x")
    line = ",".join(value(n, t) for n, t in zip(names, types))
    (tmp_path / "a.csv").write_text("\n".join([",".join(names), line, line]))
    assert load_quotes(spark, str(tmp_path), "edges_quotes").count() == 1
    assert load_quotes(spark, str(tmp_path), "edges_quotes").count() == 1
    spark.sql("DROP TABLE edges_quotes")
