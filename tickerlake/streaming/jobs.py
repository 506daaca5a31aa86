"""Incremental jobs over landing folders. State is keyed and bounded by watermarks; every sink is
idempotent or checkpointed, so a restarted job neither loses nor repeats rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickerlake.operators.upsert import dedupe_by_key
from tickerlake.sources.sinks import replace_partitions


def read_landing(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", **options) -> DataFrame:
    """Files of a landing folder as a stream; each file is taken once per checkpoint."""
    return spark.readStream.schema(schema).format(kind).options(**options).load(folder)


def _append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )


def stream_quotes_upsert(quotes: DataFrame, path: str, checkpoint: str, unit: str = "date") -> StreamingQuery:
    """Replace by date: what a batch brings overwrites its partitions, so a repeated batch changes nothing.

    ``unit`` is the span a landed file is complete for: ``date`` for daily dumps, ``month`` for a backfill
    of whole months, which keeps the number of partitions small.
    """

    def land(batch: DataFrame, _: int) -> None:
        keyed = dedupe_by_key(batch.filter("symbol IS NOT NULL"), ["symbol", "date"], [])
        rows = keyed if unit == "date" else keyed.withColumn(unit, F.trunc("date", unit))
        replace_partitions(rows, path, unit)

    return quotes.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def usage_tumbling(calls: DataFrame, width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Calls and mean response per window and endpoint; rows later than the watermark are dropped."""
    return (
        calls.withWatermark("ts", late)
        .groupBy(F.window("ts", width), "endpoint")
        .agg(F.count("*").alias("call_count"), F.avg("response_time_ms").alias("avg_response_time"))
        .select(F.col("window.start").alias("minute"), "endpoint", "call_count", "avg_response_time")
    )


def usage_sliding(
    calls: DataFrame, limit: int, width: str = "60 seconds", slide: str = "10 seconds", late: str = "10 minutes"
) -> DataFrame:
    """Calls per sliding window and endpoint, flagged at the limit."""
    return (
        calls.withWatermark("ts", late)
        .groupBy(F.window("ts", width, slide), "endpoint")
        .agg(F.count("*").alias("call_count"))
        .select(
            F.col("window.start").alias("window_start"), "endpoint", "call_count",
            (F.col("call_count") >= limit).alias("over_limit"),
        )
    )


def ohlcv_daily(ticks: DataFrame, key: str, price: str, volume: str, tie: str, late: str = "1 day") -> DataFrame:
    """Daily open, high, low, close and volume, emitted once the day has passed the watermark."""
    at = F.struct(F.col("ts"), F.col(tie))
    return (
        ticks.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 day"), key)
        .agg(
            F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
            F.max_by(price, at).alias("close"), F.sum(volume).alias("volume"),
        )
        .select(F.col("window.start").cast("date").alias("day"), key, "open", "high", "low", "close", "volume")
    )


def dedupe_records(records: DataFrame, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """The first arrival of each key within the watermark; state older than that is dropped."""
    return records.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def stream_dedupe_records(records: DataFrame, key: str, ts: str, path: str, checkpoint: str, late: str = "1 day") -> StreamingQuery:
    """Each key once for all time: repeats within the watermark go by state, which stays as small as the watermark is short, and later ones by what is stored.

    A batch writes its own folder, and compares itself with the folders of other batches only, so a batch that is run again after a failure gives the same rows. Only keys are read back.
    """
    spark = records.sparkSession
    schema = records.schema

    def land(batch: DataFrame, batch_id: int) -> None:
        seen = _batches(spark, path, schema)
        new = dedupe_by_key(batch, [key], [ts])
        if seen is not None:
            new = new.join(seen.filter(F.col("batch") != batch_id).select(key), key, "left_anti")
        new.select(*schema.names).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        dedupe_records(records, key, ts, late).writeStream.foreachBatch(land).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _batches(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The rows of all batches stored so far with their ``batch``; None before the first."""
    jvm = spark._jvm.org.apache.hadoop.fs
    folder = jvm.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)


def stream_append(rows: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run over all files available now, append to Parquet, and read the result back."""
    query = _append(rows, path, checkpoint)
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stream_file_ledger(files: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """One ledger row per processed file with its row count; the checkpoint skips files seen before."""

    def note(batch: DataFrame, batch_id: int) -> None:
        seen = batch.groupBy("file_path").agg(F.count("*").alias("records_count"))
        # the batch id names the folder, so a repeated batch rewrites its own rows
        seen.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    named = files.withColumn("file_path", F.col("_metadata.file_path"))
    return named.writeStream.foreachBatch(note).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
