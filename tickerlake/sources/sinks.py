"""Writers. Nothing passes through the driver; counts come from observed metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickerlake.functions.naming import camel_to_snake
from tickerlake.session import materialise, table_path

#: Marks a version folder that has been replaced; readers skip names with an underscore.
SUPERSEDED = "_superseded"


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def sink_csv_export(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Each table to ``folder/<table>`` as CSV with header; returns (table, rows, bytes)."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        counted, seen = _counted(df)
        counted.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}")
        rows.append((name, seen.get["rows"]))
    counts = spark.createDataFrame(rows, "table string, rows bigint")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .groupBy(F.element_at(F.split("path", "/"), -2).alias("table"))
        .agg(F.sum("length").alias("bytes"))
    )
    return counts.join(files, "table")


def sink_append(df: DataFrame, path: str) -> int:
    """Append; returns the rows written."""
    counted, seen = _counted(df)
    counted.write.mode("append").parquet(path)
    return seen.get["rows"]


def sink_replace(df: DataFrame, table: str, root: str | None = None) -> DataFrame:
    """Replace a whole table: write a new version folder, then point the table at it.

    Nothing is dropped before the new rows are written, outside the table's own folder, and the table that points at them exists; if that fails the old table is
    back. The version it replaces stays, so running queries and ``df`` itself may read it. Versions that an earlier replacement marked as superseded are deleted; what another
    writer has written and not yet made current is not marked, so it is safe. ``root`` defaults to the warehouse folder: the scratch folder may be emptied between jobs.
    """
    spark = df.sparkSession
    path = table_path(spark, table, root)
    df.write.mode("errorifexists").parquet(path)
    before = _stored(spark, table)
    if before and before["Type"] == "EXTERNAL" and spark.table(table).dtypes == df.dtypes:
        # one catalogue change: readers see the old version or the new one
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        aside = f"{table}_replaced_{uuid.uuid4().hex[:12]}" if before else None
        if aside:
            spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        try:
            spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
        except Exception:
            if aside:
                spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
            raise
        if aside:
            spark.sql(f"DROP TABLE {aside}")
    if before and before["Type"] == "EXTERNAL":
        _supersede(spark, before["Location"])
    return spark.table(table)


def _stored(spark: SparkSession, table: str) -> dict[str, str] | None:
    """Type and location of a stored table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name IN ('Type', 'Location')").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _supersede(spark: SparkSession, replaced: str) -> None:
    """Delete the versions beside ``replaced`` that were marked earlier, then mark ``replaced``."""
    jvm = spark._jvm.org.apache.hadoop.fs
    old = jvm.Path(replaced)
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if not old.getName().startswith("version-") or not files.exists(old):
        return
    for status in files.listStatus(old.getParent()):
        version = status.getPath()
        if version.getName().startswith("version-") and version.getName() != old.getName() and files.exists(jvm.Path(version, SUPERSEDED)):
            files.delete(version, True)
    files.createNewFile(jvm.Path(old, SUPERSEDED))


def sink_truncate_selective(spark: SparkSession, tables: list[str], selected: list[str] | None = None) -> list[str]:
    """Empty only the selected tables (all when none are given); returns the cleared ones."""
    cleared = [t for t in tables if selected is None or t in selected]
    for table in cleared:
        sink_replace(spark.table(table).limit(0), table)
    return cleared


def replace_partitions(df: DataFrame, path: str, by: str = "date") -> None:
    """Overwrite only the partitions present in ``df``.

    Rebalanced first: a partition is written by one task, or by several when it is large.
    """
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def dated_table(df: DataFrame, table: str, by: str = "date", root: str | None = None) -> None:
    """Create ``table`` with the columns of ``df``, a partition per ``by``, unless it exists."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{c}` {t}" for c, t in [*[x for x in df.dtypes if x[0] != by], *[x for x in df.dtypes if x[0] == by]])
        path = table_path(spark, table, root)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{by}`) LOCATION '{path}'")


def _into_days(rows: DataFrame, table: str, by: str, mode: str) -> None:
    """Write stored rows into the folders of their days, and tell the catalogue of new ones."""
    spark = rows.sparkSession
    columns = spark.table(table).columns
    # bounded by the calendar
    days = [str(r[0]) for r in rows.select(by).distinct().collect()]
    writer = rows.select(*columns).hint("rebalance", by).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(by).parquet(_stored(spark, table)["Location"])
    for at in range(0, len(days), 200):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION (`{by}` = '{d}')" for d in days[at : at + 200]))
    spark.catalog.refreshTable(table)


def overwrite_days(df: DataFrame, table: str, by: str = "date") -> None:
    """The days in ``df`` take the place of the stored ones; no other partition is read or written. A repeated load gives the same rows."""
    rows = materialise(df.filter(F.col(by).isNotNull()), "whole-days")
    dated_table(rows, table, by)
    _into_days(rows, table, by, "overwrite")


def insert_days(df: DataFrame, table: str, keys: list[str], by: str = "date") -> None:
    """Rows of ``df`` with keys that are not stored yet are added to their days; stored rows stay as they are.

    Only the touched days of the table are read: their list, bounded by the calendar, is a literal in the partition filter.
    """
    spark = df.sparkSession
    rows = materialise(df.filter(F.col(by).isNotNull()), "new-days")
    dated_table(rows, table, by)
    days = [r[0] for r in rows.select(by).distinct().collect()]
    stored = spark.table(table).filter(F.col(by).isin(days)).select(*keys)
    # stored apart: the table must not be read while it is written
    _into_days(materialise(rows.join(stored, keys, "left_anti"), "absent-days"), table, by, "append")


def schema_evolve_widen(df: DataFrame, prefix: str = "growth") -> DataFrame:
    """Integer columns whose name starts with ``prefix`` become double."""
    whole = {"tinyint", "smallint", "int", "bigint"}
    return df.select(
        *[F.col(c).cast("double").alias(c) if c.startswith(prefix) and t in whole else F.col(c) for c, t in df.dtypes]
    )


def schema_align_to_target(df: DataFrame, target: DataFrame) -> DataFrame:
    """Incoming rows with exactly the target's columns and types: extra columns dropped, missing ones NULL."""
    names = {camel_to_snake(c): c for c in df.columns}
    return df.select(
        *[
            (F.col(names[f.name]) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )


def concat_files_to_csv(frames: list[DataFrame], path: str) -> None:
    """Union by name and write one CSV folder."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    merged.write.mode("overwrite").option("header", True).csv(path)


def export_price_json(quotes: DataFrame, price: str = "adj_close") -> DataFrame:
    """Full history per symbol as one JSON array in date order (one point per calendar day)."""
    points = F.sort_array(F.collect_list(F.struct(F.col("date"), F.col(price))))
    return quotes.groupBy("symbol").agg(F.to_json(points).alias("equity_chart_price"), F.count("*").alias("points"))


def write_time_partitioned(df: DataFrame, path: str, day: str = "date", key: str = "symbol", buckets: int = 16) -> DataFrame:
    """Year folders, each split by a hash of the key: a year and key filter reads one folder and one file group."""
    laid_out = df.withColumn("year", F.year(day)).withColumn("key_bucket", F.pmod(F.hash(key), F.lit(buckets)))
    # adaptive rebalancing splits a folder with a hot key over several writers and merges small ones
    spread = laid_out.hint("rebalance", "year", "key_bucket")
    spread.sortWithinPartitions("year", "key_bucket", key, day).write.mode("overwrite").partitionBy(
        "year", "key_bucket"
    ).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str = "symbol", buckets: int = 16) -> DataFrame:
    """Bucketed and sorted by key, so joins and aggregates on the key need no shuffle."""
    path = table_path(df.sparkSession, table)
    # rows are brought together by the bucket id Spark will use, a large bucket over several writers
    placed = df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets))).hint("rebalance", "_bucket").drop("_bucket")
    (
        placed.write.mode("overwrite").option("path", path).format("parquet")
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )
    return df.sparkSession.table(table)


def write_clustered(df: DataFrame, path: str, keys: list[str], bloom: str | None = None) -> DataFrame:
    """Rows of nearby keys in the same files, so file statistics skip most files on a lookup by any of the keys.

    With one key rows are range-partitioned and sorted by it; with several, by the order of a space-filling curve through them, which keeps every key's range in a file
    short, not only the first one's. ``bloom`` names an identifier column that gets a bloom filter per row group, for lookups that ranges cannot narrow.
    """
    placed = df.withColumn("_at", curve_position(df, keys) if len(keys) > 1 else F.lit(0))
    by = ["_at", *keys]
    writer = placed.repartitionByRange(*by).sortWithinPartitions(*by).drop("_at").write.mode("overwrite")
    if bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Steps of a key on the curve are 2 ** BITS; their bounds rest on about SAMPLE rows.
CURVE_BITS, CURVE_SAMPLE = 6, 4096


def curve_position(df: DataFrame, keys: list[str]) -> Column:
    """The place of a row on a Z-order curve through its keys, each cut into steps of about equally many rows.

    The bounds of the steps come from a bounded sample; NULL is step 0. Equal keys have equal places.
    """

    def step_of(key: str, bounds: list) -> Column:
        known = F.array(*[F.lit(b) for b in bounds])
        return F.coalesce(F.size(F.filter(known, lambda b: b <= F.col(key))), F.lit(0))

    share = max(1, df.count() // CURVE_SAMPLE)
    sample = df.select(*keys).filter(F.pmod(F.xxhash64(F.lit("curve"), *keys), F.lit(share)) == 0).limit(2 * CURVE_SAMPLE).collect()
    steps = 1 << CURVE_BITS
    place = F.lit(0)
    for at, key in enumerate(keys):
        values = sorted({r[key] for r in sample if r[key] is not None})
        bounds = sorted({values[i * len(values) // steps] for i in range(1, steps)}) if values else []
        step = step_of(key, bounds) if bounds else F.lit(0)
        for bit in range(CURVE_BITS):
            place = place + F.shiftleft(F.shiftright(step, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(keys) + len(keys) - 1 - at)
    return place
