"""Set, dedupe, upsert and versioning operators. Results are new DataFrames; sinks decide where they land."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.functions.cleaning import all_true


def dedupe_by_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the first by ``order``, then by all columns, so the choice is reproducible.

    ``row_number = 1`` is pushed below the shuffle: each task sends one row per key at most.
    """
    rest = [F.col(c) for c in df.columns if c not in keys] or [F.col(keys[0])]
    first = Window.partitionBy(*keys).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order], *rest)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def insert_if_absent(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows win; new keys are added once."""
    new = dedupe_by_key(updates, keys, []).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new)


def upsert_update(target: DataFrame, updates: DataFrame, keys: list[str], order: list[str | Column] | None = None) -> DataFrame:
    """Updates win; target rows with other keys stay. ``order`` picks among several updates of one key."""
    new = dedupe_by_key(updates, keys, order or [])
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new)


def delete_then_append(target: DataFrame, updates: DataFrame, key: str = "record_id") -> DataFrame:
    """Drop target rows whose key is in the batch, then add the whole batch."""
    return target.join(updates.select(key), key, "left_anti").unionByName(updates)


def replace_by_date(target: DataFrame, batch: DataFrame, day: str = "date") -> DataFrame:
    """All target rows on the batch's dates give way to the batch."""
    # distinct dates: bounded by the calendar
    dates = F.broadcast(batch.select(day).distinct())
    return target.join(dates, day, "left_anti").unionByName(batch)


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    """Largest date of a text or date column; the largest text when none parses."""
    text = F.col(column).cast("string")
    return df.agg(
        F.max(F.try_to_date(text, "yyyy-MM-dd")).alias("max_date"), F.max(text).alias("max_text")
    ).select(F.coalesce(F.col("max_date").cast("string"), F.col("max_text")).alias("watermark"))


def delta_after_watermark(target: DataFrame, batch: DataFrame, day: str = "date") -> DataFrame:
    """Batch rows newer than everything in the target; dates are compared as dates, and rows without a valid one are left out.

    The watermark is one scalar read first, so the filter is a literal and reaches the batch's scan.
    """
    def as_date(c: Column) -> Column:
        return c.try_cast("date")

    newest = target.agg(F.max(as_date(F.col(day)))).first()[0]
    return batch if newest is None else batch.filter(as_date(F.col(day)) > F.lit(newest))


def union_universe(profile: DataFrame, peers: DataFrame) -> DataFrame:
    """Profile symbols and all peers, once each."""
    return profile.select("symbol").union(peers.select("peer_symbol")).distinct().filter("symbol IS NOT NULL")


def versioned_append(history: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Adds one API version per updated key on top of the newest kept version; old versions stay."""
    newest = history.groupBy(*keys).agg(F.max("data_version").alias("_newest"))
    added = (
        updates.join(newest, keys, "left")
        .withColumn("data_version", F.coalesce(F.col("_newest"), F.lit(0)) + 1)
        .withColumn("data_source", F.lit("API"))
        .drop("_newest")
    )
    return history.unionByName(added, allowMissingColumns=True)


def latest_version(history: DataFrame, keys: list[str], version: str = "data_version") -> DataFrame:
    """The newest version per key, an arg-max aggregate combined map-side."""
    rest = [c for c in history.columns if c not in (*keys, version)]
    newest = history.groupBy(*keys).agg(F.max(version).alias(version), *[F.max_by(c, version).alias(c) for c in rest])
    return newest.select(*history.columns)


def file_hash_dedupe(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files with content not in the ledger, each content once (first path).

    ``files`` has path and content; ``ledger`` has file_hash. Only the 64-character hash is shuffled.
    """
    hashed = files.select("path", F.sha2(F.col("content").cast("binary"), 256).alias("file_hash"))
    first = hashed.groupBy("file_hash").agg(F.min("path").alias("path"), F.count("*").alias("copies"))
    return first.join(ledger.select("file_hash").distinct(), "file_hash", "left_anti")


def update_ledger(ledger: DataFrame, seen: DataFrame) -> DataFrame:
    """Adds one pass per seen file hash; new files start at one."""
    passes = ledger.select("file_hash", "processing_count").unionByName(
        seen.select("file_hash", F.lit(1).cast("bigint").alias("processing_count"))
    )
    return passes.groupBy("file_hash").agg(F.sum("processing_count").alias("processing_count"))


def retention_filter(df: DataFrame, day: str, months: int = 0, days: int = 0) -> DataFrame:
    """Rows within the retention period that ends at the newest row."""
    newest = df.agg(F.max(day)).first()[0]
    if newest is None:
        return df
    edge = F.date_sub(F.add_months(F.lit(newest).cast("date"), -months), days)
    return df.filter(F.col(day) >= edge)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def required_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key columns are neither NULL nor blank."""
    return df.filter(all_true([F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != "") for k in keys]))
