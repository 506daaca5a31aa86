"""Replacing, dated and accounted loads; records with line breaks; failures as values."""

import gzip
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerlake import jobs
from tickerlake.operators import aggregates, quality
from tickerlake.plans.refresh import refresh_aggregates, touched_ranges
from tickerlake.session import scratch_path, table_path
from tickerlake.sources import files, loads, records, sinks, views as v
from tickerlake.streaming import jobs as streams


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    spark.sql(f"CREATE DATABASE loads_test LOCATION '{tmp_path_factory.mktemp('db')}'")
    spark.sql("USE loads_test")
    yield spark
    spark.sql("USE default")


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_replacing_a_managed_table(base):
    base.range(3).write.saveAsTable("managed")
    # rows of another schema that are computed from the table itself
    sinks.sink_replace(base.table("managed").selectExpr("id * 2 AS id", "'x' AS more"), "managed")
    assert ids(base.table("managed")) == [0, 2, 4] and base.table("managed").columns == ["id", "more"]
    sinks.sink_replace(base.table("managed").selectExpr("id + 1 AS id", "more"), "managed")
    assert ids(base.table("managed")) == [1, 3, 5]


def test_a_failed_replacement_keeps_the_table(base, monkeypatch):
    sinks.sink_replace(base.range(4), "kept")

    def fail(*args, **more):
        raise RuntimeError("no")

    monkeypatch.setattr(type(base.catalog), "createTable", fail)
    with pytest.raises(RuntimeError):
        sinks.sink_replace(base.range(2).selectExpr("id AS other"), "kept")
    monkeypatch.undo()
    assert ids(base.table("kept")) == [0, 1, 2, 3]


def test_two_writers_leave_each_other_alone(base):
    sinks.sink_replace(base.range(1), "shared_by_two")
    # another writer has written its version and not yet made it current
    waiting = table_path(base, "shared_by_two")
    base.range(7).write.parquet(waiting)
    for n in (2, 3, 4):
        sinks.sink_replace(base.range(n), "shared_by_two")
    assert base.read.parquet(waiting).count() == 7
    base.sql(f"ALTER TABLE shared_by_two SET LOCATION '{waiting}'")
    base.catalog.refreshTable("shared_by_two")
    sinks.sink_replace(base.range(5), "shared_by_two")
    assert base.table("shared_by_two").count() == 5


DAY = "symbol string, date date, p double"


def part_files(spark, table):
    return {f: None for f in spark.table(table).inputFiles()}


def test_a_daily_load_touches_its_day_only(base):
    spark = base
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    first = spark.createDataFrame([("A", d, 1.0) for d in days] + [("B", d, 2.0) for d in days], DAY)
    sinks.overwrite_days(first, "dated")
    before = part_files(spark, "dated")
    for _ in range(2):
        sinks.overwrite_days(spark.createDataFrame([("A", days[1], 9.0)], DAY), "dated")
        rows = sorted(tuple(r) for r in spark.table("dated").select("symbol", "date", "p").collect())
        assert rows == sorted([("A", days[0], 1.0), ("B", days[0], 2.0), ("A", days[1], 9.0), ("A", days[2], 1.0), ("B", days[2], 2.0)])
    after = part_files(spark, "dated")
    assert {f for f in before if "2024-01-02" not in f} == {f for f in after if "2024-01-02" not in f}
    new = spark.createDataFrame([("A", days[1], 5.0), ("C", days[1], 5.0), ("C", date(2024, 1, 9), 5.0)], DAY)
    for _ in range(2):
        sinks.insert_days(new, "dated", ["symbol", "date"])
        assert spark.table("dated").filter("p = 5.0").count() == 2 and spark.table("dated").count() == 7


def test_a_dump_with_another_column_order(base, tmp_path):
    (tmp_path / "d1.csv").write_text("date,symbol,close,open,low,high,adjClose,volume\n2024-03-01,A,4,1,2,3,5,10.0\n2024-03-01, ,4,1,2,3,5,10\n2024-03-01,,4,1,2,3,5,1\n")
    (tmp_path / "d2.csv").write_text("symbol,date,open,low,high,close,adjClose,volume\nA,2024-03-02,1,2,3,4,6,10\n")
    for _ in range(2):
        for name in ("d1.csv", "d2.csv"):
            jobs.load_bulk_eod(base, str(tmp_path / name), "eod")
    rows = sorted(tuple(r) for r in base.table("eod").select("symbol", F.col("date").cast("string"), "open", "close", "adj_close").collect())
    assert rows == [("A", "2024-03-01", 1.0, 4.0, 5.0), ("A", "2024-03-02", 1.0, 4.0, 6.0)]


def test_headers_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,A,c\n2,1,x\n")
    assert files.scan_csv_typed(spark, str(tmp_path), "a int, b int").collect() == [(1, 2)]
    with pytest.raises(ValueError, match="missing"):
        files.scan_csv_typed(spark, str(tmp_path), "a int, missing int")
    (tmp_path / "b.csv").write_text("A,b,c\n1,2,x\n")
    with pytest.raises(Exception):
        files.scan_csv_typed(spark, str(tmp_path), "a int, b int").collect()
    assert sorted(r[:2] for r in records.scan_csv_records(spark, str(tmp_path), "a int, b int").collect()) == [(1, 2), (1, 2)]


CELLS = st.text(alphabet='ab",\n é', max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(CELLS, CELLS), min_size=1, max_size=12))
def test_line_breaks_like_one_task(spark, tmp_path_factory, rows):
    folder = tmp_path_factory.mktemp("breaks")
    text = "x,y\n" + "".join(",".join('"' + c.replace('"', '""') + '"' for c in ("r" + a, "r" + b)) + "\n" for a, b in rows)
    (folder / "a.csv").write_text(text)
    folder = str(folder)
    # blocks of a few bytes: records span tasks
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "4")
    try:
        assert spark.read.text(folder).rdd.getNumPartitions() > 1 or len(text) < 32
        found = sorted(tuple(r)[:2] for r in records.scan_csv_records(spark, folder, "x string, y string").collect())
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{name}")
    assert found == sorted(("r" + a, "r" + b) for a, b in rows)


def test_a_quote_that_is_never_closed(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,2\n"3,4\n' + "5,6\n" * 30)
    found = records.scan_csv_records(spark, str(tmp_path), "x string, y int", longest=5)
    assert found.filter("x = '5' AND y = 6").count() == 30 and found.count() == 32


def test_records_longer_than_a_block_or_the_limit(spark, tmp_path):
    # whole and lost records over many small blocks and batches, as one pass over the lines gives them
    texts = []
    for i in range(12):
        texts += [f"{i},plain", f'{i},"two\nlines"', f'{i},"' + "\n".join(f"l{j}" for j in range(3 + i % 9)) + '"']
    (tmp_path / "a.csv").write_text("x,y\n" + "\n".join(texts) + "\n")
    (tmp_path / "b.csv").write_text('x,y\n1,"open\n' + "2,3\n" * 12)
    want = {0: [], 1: []}
    for n, name in enumerate(("a.csv", "b.csv")):
        held = []
        for line in (tmp_path / name).read_text().splitlines():
            held.append(line)
            if "\n".join(held).count('"') % 2 == 0:
                want[n] += ["\n".join(held)] if len(held) <= 7 else held
                held = []
        want[n] += ["\n".join(held)] if 0 < len(held) <= 7 else held
    settings = {"sql.files.maxPartitionBytes": "48", "sql.files.openCostInBytes": "0", "sql.files.minPartitionNum": "4", "sql.execution.arrow.maxRecordsPerBatch": "3"}
    for size in ("48", "100000"):
        for k, value in (settings | {"sql.files.maxPartitionBytes": size}).items():
            spark.conf.set(f"spark.{k}", value)
        try:
            found = records.csv_records(spark, str(tmp_path), longest=7).collect()
        finally:
            for k in settings:
                spark.conf.unset(f"spark.{k}")
        for n, name in enumerate(("a.csv", "b.csv")):
            assert sorted(r.text for r in found if r.file.endswith(name)) == sorted(want[n])
        ordered = [r.text for r in sorted((r for r in found if r.file.endswith("a.csv") and "\n" not in r.text and "," in r.text), key=lambda r: r.record)]
        assert [t for t in ordered if t.endswith("plain")] == [t for t in texts if t.endswith("plain")]


def test_records_are_read_without_shuffling_them(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"\n' + "2,3\n" * 9)
    plan = records.csv_records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    # only the lines of records that cross a block are grouped
    assert "record-pieces" in plan and plan.count("Exchange hashpartitioning") <= 2
    assert records.csv_records(spark, str(tmp_path)).count() == 11 and spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_a_corrupt_file_is_a_row_of_the_log(spark, tmp_path):
    for i in range(5):
        with gzip.open(tmp_path / f"f{i}.csv.gz", "wt") as out:
            out.write("".join(f"{i * 1000 + j},{j}\n" for j in range(400)) + ",no key\n")
    whole = (tmp_path / "f3.csv.gz").read_bytes()
    (tmp_path / "f3.csv.gz").write_bytes(whole[: len(whole) // 2])
    rows, log = files.load_partition_files(spark, str(tmp_path), ["k", "v"], {"k": "bigint", "v": "bigint"}, ["k"])
    assert rows.count() == 4 * 400 and rows.filter("source_file = 'f3.csv.gz'").count() == 0
    entries = {r["file"]: r for r in log.collect()}
    assert len(entries) == 5 and all(entries[f"f{i}.csv.gz"][1:2] == ("loaded",) for i in (0, 1, 2, 4))
    assert (entries["f0.csv.gz"].lines, entries["f0.csv.gz"].accepted, entries["f0.csv.gz"].rejected) == (401, 400, 1)
    bad = entries["f3.csv.gz"]
    assert (bad.status, bad.lines, bad.accepted) == ("failed", 0, 0) and bad.reason and bad.bytes == len(whole) // 2


def test_no_task_writes_a_quarter_of_the_months(spark, tmp_path, monkeypatch):
    """Landed files are many, each with whole months; text files come from the table's own splits."""
    from tickerlake import registry
    from tickerlake.registry import storage

    days = spark.range(7 * 365).selectExpr("id AS l_orderkey", "1 AS l_linenumber", "id % 50 AS l_partkey", "id % 9 AS l_suppkey", "1.0D AS l_quantity", "2.0D AS l_extendedprice",
                                           "CAST(date_add(DATE '1992-01-01', CAST(id AS INT)) AS TIMESTAMP) AS l_shipdate")
    days.repartition(6).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen = {}
    monkeypatch.setattr(storage, "scratch_path", lambda session, label: seen.setdefault(label, scratch_path(session, label)))
    assert registry.QUERIES["stream_quotes_upsert"](spark, str(tmp_path)).count() == 7 * 365
    landed = spark.read.option("header", True).csv(seen["eod-landing"]).select(F.substring("date", 1, 7).alias("month"), F.input_file_name().alias("file"))
    assert landed.distinct().groupBy("month").count().filter("count > 1").count() == 0
    assert max(r["count"] for r in landed.groupBy("file").count().collect()) < 7 * 365 / 8
    assert registry.QUERIES["scan_partition_files"](spark, str(tmp_path)).count() == 7 * 365
    assert [r.files for r in registry.QUERIES["load_partition_files"](spark, str(tmp_path)).collect()] == [4]
    for label in ("partition-files", "logged-files"):
        lines = storage._in_files(v.dirty_lines(spark, str(tmp_path)).select("line"), 4)
        assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString() or spark.read.parquet(f"{tmp_path}/lineitem.parquet").rdd.getNumPartitions() < 4
    assert storage._in_files(spark.range(9, numPartitions=6), 4).rdd.getNumPartitions() == 6 and storage._in_files(spark.range(9, numPartitions=2), 4).rdd.getNumPartitions() == 4


def test_load_health_follows_the_log(base):
    log = base.createDataFrame(
        [("a", "equity_quotes", "loaded"), ("b", "equity_quotes", "failed"), ("b", "equity_quotes", "loaded"), ("c", "etfs_quotes", "failed"), ("d", None, "loaded")],
        "file string, family string, status string")
    [row] = quality.critical_load_check(base, {"t": base.range(9)}, {"t": 5}, log).collect()
    assert tuple(row) == (0, True, False, False)
    [row] = quality.critical_load_check(base, {"t": base.range(9)}, {"t": 5, "gone": 1}, log.filter("file <> 'c'"), whole=["equity_quotes"]).collect()
    assert tuple(row) == (1, True, True, False)


def test_a_table_with_a_missing_file_counts_as_under_seeded(spark):
    path = scratch_path(spark, "broken")
    spark.range(10).repartition(2).write.parquet(path)
    broken = spark.read.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    victim = hadoop.Path(broken.inputFiles()[0])
    victim.getFileSystem(spark._jsc.hadoopConfiguration()).delete(victim, False)
    counts = {r["table"]: r for r in aggregates.table_row_counts({"whole": spark.range(4), "broken": broken}).collect()}
    assert counts["whole"].rows == 4 and counts["whole"].error is None
    assert counts["broken"].rows is None and counts["broken"].error
    short = {r["table"]: r for r in quality.under_seeded_tables(spark, {"whole": spark.range(4), "broken": broken}, {"whole": 3, "broken": 1, "gone": 1}).collect()}
    assert set(short) == {"broken", "gone"} and short["broken"].rows == 0 and short["broken"].error


def test_a_refresh_reads_its_months_only(spark):
    raw_path, path = scratch_path(spark, "raw"), scratch_path(spark, "months")
    raw = spark.range(400).selectExpr("date_add(DATE '2023-01-01', CAST(id AS INT)) AS date", "CAST(id AS DOUBLE) AS v")
    raw.write.parquet(raw_path)
    stored = spark.read.parquet(raw_path)

    def monthly(rows):
        return rows.groupBy(F.trunc("date", "month").alias("month")).agg(F.count("*").alias("n"))

    sinks.replace_partitions(monthly(stored), path, "month")
    changed = spark.createDataFrame([(date(2023, 3, 9),), (date(2023, 4, 2),), (date(2023, 12, 5),)], "date date")
    assert touched_ranges(changed, "month") == [(date(2023, 3, 1), date(2023, 5, 1)), (date(2023, 12, 1), date(2024, 1, 1))]
    rows = refresh_aggregates(stored, changed, path, "month", "month", monthly)
    assert rows.count() == 31 + 30 + 31
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "2023-03-01" in plan.split("PushedFilters")[1]
    assert spark.read.parquet(path).agg(F.sum("n")).first()[0] == 400


def test_a_key_behind_the_watermark_is_refused(spark):
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("late", "late-out", "late-checkpoint"))
    schema = "record_id int, ts timestamp"
    days = [("2024-01-01", [1, 2, 2]), ("2024-03-01", [3]), ("2024-06-01", [4]), ("2024-09-01", [1, 5])]
    kept = []
    for day, keys in days:
        spark.createDataFrame([(i, day) for i in keys], "record_id int, d string").selectExpr("record_id", "CAST(d AS TIMESTAMP) AS ts").write.mode("append").parquet(landing)
        query = streams.stream_dedupe_records(streams.read_landing(spark, landing, schema), "record_id", "ts", out, checkpoint)
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert ids(spark.read.parquet(out).select("record_id")) == [1, 2, 3, 4, 5]
    # state holds the newest keys, not all that ever came
    assert max(kept) <= 3


def test_fund_loads(base, tmp_path):
    (tmp_path / "FundGeneralSeed.csv").write_text("RecordId,LegalName\n1,One\n1,One\n2,Two\n")
    assert jobs.load_fund_seeds(base, str(tmp_path), ["FundGeneralSeed.csv"]) == ["fund_general"]
    assert jobs.load_fund_seeds(base, str(tmp_path), ["FundGeneralSeed.csv"]) == []
    assert base.table("fund_general").count() == 2
    assert [r.processing_count for r in base.table("seed_ledger").collect()] == [2]
    dump = tmp_path / "navs.csv"
    dump.write_text("InstrumentKey,Date,NAVPS\n7,2024-01-02,1.5\n7,2024-01-02,1.5\n,2024-01-02,9\n8,2024-01-03,2\n9,soon,2\n")
    jobs.load_fund_quotes(base, str(dump), "navs")
    dump.write_text("InstrumentKey,Date,NAVPS\n7,2024-01-02,99\n7,2024-01-04,3\n")
    for _ in range(2):
        jobs.load_fund_quotes(base, str(dump), "navs")
        rows = sorted((r.instrument_key, str(r.date), r.navps) for r in base.table("navs").collect())
        assert rows == [(7, "2024-01-02", "1.5"), (7, "2024-01-04", "3"), (8, "2024-01-03", "2")]
    data = tmp_path / "data.csv"
    data.write_text("InstrumentKey,RecordId,LegalName\nK1,r1,  One \nK2,r2,Two\n,r3,No\nK4,,No\n")
    jobs.load_fund_data(base, str(data))
    data.write_text("InstrumentKey,RecordId,LegalName\nK1,r1,New\n")
    jobs.load_fund_data(base, str(data))
    assert sorted((r.record_id, r.legal_name) for r in base.table("fund_data").collect()) == [("r1", "New"), ("r2", "Two")]


def test_reasons_are_short():
    assert loads.reason_of(RuntimeError("one\nCaused by: a\nCaused by: b")) == "b"
    assert loads.reason_of(RuntimeError("")) == "RuntimeError"
