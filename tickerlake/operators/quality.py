"""Data-quality reports over tables given as DataFrames."""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickerlake.functions.cleaning import violations
from tickerlake.operators.aggregates import table_row_counts

EXCHANGES = ["NYSE", "NASDAQ", "AMEX", "TSX", "TSXV"]
CAP_LIMIT = 100_000_000_000_000


def with_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.withColumn("violations", violations(rules))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected rows name the broken rules."""
    checked = with_violations(df, rules)
    return checked.filter(F.size("violations") == 0).drop("violations"), checked.filter(F.size("violations") > 0)


def required_fields(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    """Present and truthy: text not empty, numbers not zero, flags true."""
    empty = {"string": F.lit(""), "boolean": F.lit(False)}
    types = dict(df.dtypes)
    return {c: F.coalesce(F.col(c) != empty.get(types[c], F.lit(0)), F.lit(False)) for c in columns}


def profile_rules(exchange: str = "exchange", cap: str = "mkt_cap", employees: str | None = None) -> dict[str, Column]:
    rules = {
        "exchange": F.upper(F.trim(exchange)).isin(EXCHANGES),
        "market_cap": F.col(cap).between(0, CAP_LIMIT),
    }
    return {**rules, "employees": F.col(employees) >= 0} if employees else rules


def price_rules(prices: list[str], volume: str, split: str | None = None) -> dict[str, Column]:
    rules = {**{p: F.col(p) >= 0 for p in prices}, volume: F.col(volume) >= 0}
    return {**rules, split: F.col(split) > 0} if split else rules


def under_seeded_tables(spark: SparkSession, tables: dict[str, DataFrame], minimums: dict[str, int]) -> DataFrame:
    """Tables whose count is below the minimum. A table that is not there counts 0, and so does one that cannot be read, with the reason in ``error``."""
    wanted = spark.createDataFrame(list(minimums.items()), "table string, minimum bigint")
    if not tables:
        return wanted.withColumns({"rows": F.lit(0).cast("bigint"), "error": F.lit(None).cast("string")})
    counts = table_row_counts({t: df for t, df in tables.items() if t in minimums})
    return (
        wanted.join(counts, "table", "left")
        .withColumn("rows", F.coalesce(F.col("rows"), F.lit(0)))
        .filter("rows < minimum")
    )


#: Share of files that must have been loaded, and the families whose files must all have been.
FILE_SHARE, WHOLE_FAMILIES = 0.60, ["equity_quotes", "etfs_quotes"]


def critical_load_check(
    spark: SparkSession, tables: dict[str, DataFrame], minimums: dict[str, int], ledger: DataFrame, file: str = "file", family: str = "family",
    ok: Column | None = None, whole: list[str] | None = None,
) -> DataFrame:
    """One row: critical tables filled, at least 60 % of the files loaded, both quote folders complete.

    ``ledger`` has the loads' files; a file counts by its best try.
    """
    ok = F.col("status") == "loaded" if ok is None else ok
    whole = WHOLE_FAMILIES if whole is None else whole
    best = ledger.groupBy(family, file).agg(F.max(ok.cast("int")).alias("_ok"))
    state = best.agg(
        F.coalesce(F.avg("_ok") >= FILE_SHARE, F.lit(False)).alias("files_ok"),
        *[F.coalesce(F.min(F.when(F.col(family) == f, F.col("_ok"))) == 1, F.lit(False)).alias(f"_whole_{i}") for i, f in enumerate(whole)],
    )
    complete = F.lit(True)
    for i in range(len(whole)):
        complete = complete & F.col(f"_whole_{i}")
    failures = under_seeded_tables(spark, tables, minimums).agg(F.count("*").alias("critical_failures"))
    # two frames of one row each
    joined = failures.withColumn("_one", F.lit(1)).join(state.withColumn("_one", F.lit(1)), "_one")
    checked = joined.withColumn("quotes_ok", complete).select("critical_failures", "files_ok", "quotes_ok")
    return checked.withColumn("loaded", (F.col("critical_failures") == 0) & F.col("files_ok") & F.col("quotes_ok"))


def download_coverage(ledger: DataFrame, family: str, ok: Column, share: float = 0.8) -> DataFrame:
    """Success share per file family, complete from ``share`` on."""
    return (
        ledger.groupBy(family)
        .agg(F.count("*").alias("files"), F.sum(ok.cast("bigint")).alias("succeeded"))
        .withColumn("success_ratio", F.col("succeeded") / F.col("files"))
        .withColumn("complete", F.col("success_ratio") >= share)
    )


def _long(per_symbol: DataFrame, metrics: list[str]) -> DataFrame:
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"_{m}").alias("_v")) for m in metrics])
    return per_symbol.select("symbol", F.inline(values))


def metric_availability(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(symbol, metric, available): any non-NULL value, for all symbols in one aggregate."""
    found = df.groupBy("symbol").agg(*[F.max(F.col(m).isNotNull()).alias(f"_{m}") for m in metrics])
    return _long(found, metrics).withColumnRenamed("_v", "available")


def history_coverage(df: DataFrame, metrics: dict[str, int], as_of: date) -> DataFrame:
    """Count, first and last date of non-NULL values in the last twelve months; sufficient from the metric's minimum."""
    year = df.filter(F.col("date") >= F.add_months(F.lit(as_of), -12))

    def stats(m: str) -> Column:
        seen = F.when(F.col(m).isNotNull(), F.col("date"))
        return F.struct(F.count(seen).alias("records"), F.min(seen).alias("first_date"), F.max(seen).alias("last_date"))

    needed = F.create_map(*[x for m, n in metrics.items() for x in (F.lit(m), F.lit(n))])
    found = year.groupBy("symbol").agg(*[stats(m).alias(f"_{m}") for m in metrics])
    return (
        _long(found, list(metrics))
        .select("symbol", "metric", "_v.*")
        .withColumn("sufficient", F.col("records") >= needed[F.col("metric")])
    )


class RunLog:
    """Log of finished writes: task, status, records, errors, seconds. Counts are observed while writing."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._rows: list[tuple] = []

    def write(self, task: str, df: DataFrame, path: str, rules: dict[str, Column] | None = None) -> None:
        """Write the rows that keep the rules; the rest count as errors. A failed write is logged and raised."""
        checked = with_violations(df, rules or {"row": F.lit(True)})
        seen, start = Observation(), time.monotonic()
        broken = F.sum((F.size("violations") > 0).cast("bigint"))
        counted = checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(broken, F.lit(0)).alias("errors"))
        try:
            counted.filter(F.size("violations") == 0).drop("violations").write.parquet(path)
        except Exception:
            self._rows.append((task, "failed", 0, 0, time.monotonic() - start))
            raise
        found = seen.get
        done = found["rows"] - found["errors"]
        self._rows.append((task, "completed", done, found["errors"], time.monotonic() - start))

    def rows(self) -> DataFrame:
        schema = "task string, status string, records_processed bigint, errors bigint, seconds double"
        return self._spark.createDataFrame(self._rows, schema)
