from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickerlake.operators import nested, quality, upsert
from tickerlake.session import scratch_path, shared_folder
from tickerlake.sources import files, sinks
from tickerlake.streaming import jobs


def test_array_explosion(spark):
    """Four sectors and two holdings give six rows; each keeps the record."""
    rows = spark.createDataFrame(
        [("X1", "1.005", ["a", "b", "c", "d"], [1, 2]), ("X2", "n/a", [], [])],
        "id string, nav string, sectors array<string>, holdings array<int>")
    got = nested.explode_array_index(rows, "id", numeric=["nav"]).collect()
    first = [(r.array_source_field, r.array_element_index, r.array_element_value) for r in got if r.identifier == "X1"]
    assert sorted(first) == [("holdings", 0, "1"), ("holdings", 1, "2"), *[("sectors", i, c) for i, c in enumerate("abcd")]]
    [empty] = [r for r in got if r.identifier == "X2"]
    assert (empty.array_source_field, empty.array_element_index, empty.nav) == (None, None, None)
    assert all('"sectors"' in r.raw_json for r in got)


def test_versions(frame, values):
    history = frame("id string, v int, data_version int, data_source string", ("a", 1, 1, "CSV"))
    both = upsert.versioned_append(history, frame("id string, v int", ("a", 2), ("b", 3)), ["id"])
    assert values(both, "id", "v", "data_version", "data_source") == [
        ("a", 1, 1, "CSV"), ("a", 2, 2, "API"), ("b", 3, 1, "API")]
    assert values(upsert.latest_version(both, ["id"]), "id", "v") == [("a", 2), ("b", 3)]


def test_upserts(frame, values):
    target = frame("k int, v string", (1, "old"), (2, "old"))
    updates = frame("k int, v string", (2, "new"), (3, "b"), (3, "a"))
    assert values(upsert.upsert_update(target, updates, ["k"])) == [(1, "old"), (2, "new"), (3, "a")]
    assert values(upsert.insert_if_absent(target, updates, ["k"])) == [(1, "old"), (2, "old"), (3, "a")]
    assert values(upsert.delete_then_append(target, updates, "k")) == [(1, "old"), (2, "new"), (3, "a"), (3, "b")]


def test_watermark_compares_dates(frame, values):
    target = frame("k int, date string", (1, "2024-09-30"))
    batch = frame("k int, date string", (2, "2024-10-01"), (3, "2024-09-30"))
    assert values(upsert.delta_after_watermark(target, batch), "k") == [(2,)]
    empty = target.filter("k < 0")
    assert upsert.delta_after_watermark(empty, batch).count() == 2
    assert upsert.max_watermark(frame("d string", ("x",), ("2024-01-02",)), "d").first()[0] == "2024-01-02"
    assert upsert.max_watermark(frame("d string", ("x",), ("b",)), "d").first()[0] == "x"


def test_ledger(frame, values):
    seen = frame("path string, content string", ("p1", "one"), ("p2", "one"), ("p3", "two"))
    known = frame("c string", ("two",)).select(F.sha2("c", 256).alias("file_hash"), F.lit(4).cast("bigint").alias("processing_count"))
    new = upsert.file_hash_dedupe(seen, known)
    assert values(new, "path", "copies") == [("p1", 2)]
    ledger = upsert.update_ledger(known, new)
    assert sorted(r.processing_count for r in ledger.collect()) == [1, 4]


def test_replace_reads_its_own_table(spark):
    sinks.sink_replace(spark.range(3), "numbers_replaced")
    twice = sinks.sink_replace(spark.table("numbers_replaced").selectExpr("id * 2 AS id"), "numbers_replaced")
    assert sorted(r.id for r in twice.collect()) == [0, 2, 4]
    assert sinks.sink_truncate_selective(spark, ["numbers_replaced"], ["other"]) == []
    spark.sql("DROP TABLE numbers_replaced")


def test_bucketed_tables_join_without_a_shuffle(spark):
    rows = spark.range(200).selectExpr("id % 20 AS symbol", "id AS v")
    left, right = sinks.write_bucketed(rows, "bucketed_left"), sinks.write_bucketed(rows, "bucketed_right")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = left.groupBy("symbol").agg(F.sum("v").alias("a")).join(right.groupBy("symbol").agg(F.max("v").alias("b")), "symbol")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    spark.sql("DROP TABLE bucketed_left")
    spark.sql("DROP TABLE bucketed_right")


def test_time_partitions_are_pruned(spark):
    rows = spark.range(800).selectExpr("id % 8 AS symbol", "date_add(DATE '2020-01-01', CAST(id AS int)) AS date", "1.0D AS p")
    table = sinks.write_time_partitioned(rows, scratch_path(spark, "pruned"))
    one = table.filter("year = 2021 AND symbol = 3")
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().toString()
    assert one.count() == rows.filter("year(date) = 2021 AND symbol = 3").count()


def test_clustered_rows_are_near_in_every_key(spark):
    rows = spark.range(20_000).selectExpr("CAST(id * 7919 % 20000 AS INT) AS a", "concat('k', lpad(CAST(id * 104729 % 20000 AS STRING), 5, '0')) AS b", "id * 2 AS n")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = sinks.write_clustered(rows, scratch_path(spark, "curve"), ["a", "b"], bloom="n")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert table.count() == 20_000 and table.agg(F.sum("n")).first()[0] == 20_000 * 19_999
    spans = table.groupBy(F.input_file_name()).agg(F.max("a") - F.min("a"), F.max(F.substring("b", 2, 5).cast("int")) - F.min(F.substring("b", 2, 5).cast("int"))).collect()
    assert len(spans) >= 12
    # a file covers a fraction of both keys: a lookup by either skips most files
    assert sum(r[1] for r in spans) / len(spans) < 9_000 and sum(r[2] for r in spans) / len(spans) < 9_000
    assert table.filter("n = 20").count() == 1 and table.filter("n = 21").count() == 0


def test_partition_replace_keeps_other_dates(spark, values):
    path = scratch_path(spark, "t")
    old = spark.createDataFrame([("A", date(2024, 1, 1), 1.0), ("A", date(2024, 1, 2), 1.0)], "symbol string, date date, p double")
    sinks.replace_partitions(old, path)
    sinks.replace_partitions(spark.createDataFrame([("B", date(2024, 1, 2), 9.0)], old.schema), path)
    assert values(spark.read.parquet(path), "symbol", "p") == [("A", 1.0), ("B", 9.0)]


def test_schema_helpers(frame):
    wide = sinks.schema_evolve_widen(frame("growthRank int, growthName string, n int", (1, "x", 2)))
    assert dict(wide.dtypes) == {"growthRank": "double", "growthName": "string", "n": "int"}
    target = frame("adj_close double, volume bigint", (1.0, 2))
    aligned = sinks.schema_align_to_target(frame("adjClose float, extra string", (1.5, "x")), target)
    assert aligned.dtypes == target.dtypes and aligned.first()[:] == (1.5, None)


def test_rules(frame):
    rows = frame("symbol string, exchange string, mkt_cap double, employees int",
                 ("A", " nyse", 5.0, 1), ("B", "LSE", -1.0, -2), ("C", None, None, None), ("", "TSX", 0.0, 0))
    rules = {**quality.required_fields(rows, ["symbol"]), **quality.profile_rules(employees="employees")}
    good, bad = quality.split_valid(rows, rules)
    assert sorted(r.symbol for r in good.collect()) == ["A", "C"]
    assert {r.symbol: r.violations for r in bad.collect()} == {"B": ["exchange", "market_cap", "employees"], "": ["symbol"]}


def test_failed_write_is_logged(spark):
    log = quality.RunLog(spark)
    path = scratch_path(spark, "log")
    log.write("first", spark.range(5), path)
    with pytest.raises(Exception):
        log.write("again", spark.range(5), path)
    assert [(r.task, r.status, r.records_processed) for r in log.rows().collect()] == [("first", "completed", 5), ("again", "failed", 0)]


def test_late_rows_are_dropped(spark):
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("calls", "out", "checkpoint"))
    schema = "endpoint string, ts timestamp, response_time_ms double"

    def land(*minutes):
        rows = [("q", datetime(2024, 1, 1, m // 60, m % 60), 1.0) for m in minutes]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)

    def run():
        return jobs.stream_append(jobs.usage_tumbling(jobs.read_landing(spark, landing, schema)), out, checkpoint)

    land(0, 0, 30)
    assert [(r.minute.minute, r.call_count) for r in run().collect()] == [(0, 2)]
    # minute 1 is behind the watermark of minute 20, minute 25 is not
    land(1, 25, 90)
    assert sorted((r.minute.minute, r.call_count) for r in run().collect()) == [(0, 2), (25, 1), (30, 1)]


def test_dedupe_stream_across_runs(spark):
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("records", "out", "checkpoint"))
    schema = "record_id int, ts timestamp"
    for ids in ([1, 2, 2], [2, 3]):
        rows = [(i, datetime(2024, 1, 1)) for i in ids]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        got = jobs.stream_append(jobs.dedupe_records(jobs.read_landing(spark, landing, schema), "record_id", "ts"), out, checkpoint)
    assert sorted(r.record_id for r in got.collect()) == [1, 2, 3]


def test_profile_json(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"symbol":"A","price":"1.5","mktCap":"12.0","isEtf":false,"ipoDate":"","range":"1-2","zip":"9"}\n{"price":"3"}\n')
    [row] = files.ingest_profile_json(spark, str(tmp_path)).collect()
    assert (row.symbol, row.price, row.mkt_cap, row.is_etf, row.ipo_date, row.range_str, row.zip_code) == (
        "A", 1.5, 12, False, None, "1-2", "9")
    assert len(row) == 36


def test_shared_folder_is_the_configured_one(spark):
    assert spark.conf.get("spark.checkpoint.dir") == shared_folder(spark)
