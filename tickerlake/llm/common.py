"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerlake.llm import words
from tickerlake.session import materialise

#: Largest id. Ids are given out downwards from it to rows without one.
NO_ID = (1 << 63) - 1
#: Bytes of an Arrow batch under ``small_batches``.
BATCH_BYTES = 2 << 20
ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers on machines that see this folder import the package wherever they run; a cluster without it gets it by ``--py-files``."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *[p for p in paths if p]])


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes.

    A task holds some at a time, in the JVM and again in its Python worker; Spark's own bounds of 10 000 rows and 64 MB may take a quarter of a small executor.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text, so that columns of the caller never clash with those made here."""
    importable(df.sparkSession)
    return df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def text_print(text: str | Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def identified(given: DataFrame) -> tuple[DataFrame, int]:
    """The rows (doc_id, text) with an id each, and the least of the ids given to rows without one, larger than all others (``NO_ID`` without such rows, which is no id then); NULL and empty text are one.

    Rows without an id have the same one if their texts are equal. They are numbered by the digests of their texts, in cells by the first digits, so no
    task sees them all.
    """
    nameless = given.where(F.col("doc_id").isNull()).select("text", text_print("text").alias("print"))
    if not nameless.limit(1).count():
        return given, NO_ID
    prints = materialise(nameless.select("print").distinct().withColumn("cell", F.substring("print", 1, 4)), "nameless-prints")
    least = NO_ID - prints.count() + 1
    if (given.agg(F.max("doc_id")).first()[0] or 0) >= least:
        raise ValueError("no ids are left above the largest doc_id for the rows without one")
    # A row for each of 16 ** 4 cells at most.
    cells = prints.groupBy("cell").count().select("cell", (F.sum("count").over(Window.orderBy("cell")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("cell").orderBy("print"))
    numbered = prints.join(cells, "cell").select("print", (F.lit(least - 1) + F.col("before") + place).cast("bigint").alias("doc_id"))
    stored = materialise(nameless.join(numbered, "print").select("doc_id", "text"), "nameless")
    return given.where(F.col("doc_id").isNotNull()).unionByName(stored), least


def id_remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``: fixes which labelled rows are held out."""
    return F.crc32(F.col(key).cast("string")) % F.lit(divisor)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    It does so when the driver's JVM collects their plans, which may otherwise take half an hour; between large steps that is disk for nothing.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """At the end of a task or a part of it: return free memory of its Python worker to the system, because workers live on while other stages need it."""
    words.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def key_sample(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """About ``rows`` rows with keys chosen by hash, ``2 * rows`` at most; all of a smaller table.

    The share is set from the row count, so no task passes on more than its share of the sample.
    """
    share = max(1, df.count() // max(1, rows))
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(share)) == 0).limit(2 * rows)
