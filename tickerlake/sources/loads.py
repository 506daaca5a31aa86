"""Loads that account for every file: what was read, what was rejected, and which files could not be read and why."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.session import materialise, reason_of

LOG = "file string, status string, bytes bigint, lines bigint, accepted bigint, rejected bigint, reason string"


def file_sizes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, bytes) of all files of a path; contents are not read."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def unreadable(spark: SparkSession, files: list[str], read: Callable[[list[str]], DataFrame]) -> dict[str, str]:
    """The files that cannot be read to their end, with the reason.

    Halves that can be read as a whole are done, so n files with b bad ones take about b * log2(n) jobs, which count rows and move none. File names pass through the driver, as in any
    file listing of Spark.
    """
    bad: dict[str, str] = {}
    waiting = [files]
    while waiting:
        part = waiting.pop()
        try:
            read(part).groupBy().count().collect()
        except Exception as error:  # any failure of the read is a fact about the file
            if len(part) == 1:
                bad[part[0]] = reason_of(error)
            else:
                middle = len(part) // 2
                waiting += [part[:middle], part[middle:]]
    return bad


def load_files(
    spark: SparkSession, path: str | list[str], read: Callable[[list[str]], DataFrame], accept: Callable[[DataFrame], Column], file: str = "source_file"
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, log with a row per file) of the files of ``path``.

    ``read`` gives the rows of a list of files with the file in the column ``file``; ``accept`` says which rows are taken. All files are read at once. Only if that fails, the files that
    cannot be read are searched for, logged as failed, and left out whole: no part of a broken file gets in.
    """
    sizes = materialise(file_sizes(spark, path), "file-sizes")
    files = sorted(r["file"] for r in sizes.select("file").toLocalIterator())
    schema = read(files[:1]).schema if files else None
    failed: dict[str, str] = {}

    def stored(part: list[str]) -> DataFrame:
        rows = read(part)
        return materialise(rows.withColumn("_accepted", F.coalesce(accept(rows), F.lit(False))), "loaded-lines")

    if not files:
        raise FileNotFoundError(f"no files in {path}")
    try:
        rows = stored(files)
    except Exception:
        failed = unreadable(spark, files, lambda part: read(part))
        if not failed:
            raise
        good = [f for f in files if f not in failed]
        empty = spark.createDataFrame([], schema).withColumn("_accepted", F.lit(True))
        rows = stored(good) if good else empty
    counted = rows.groupBy(F.col(file).alias("file")).agg(F.count("*").alias("lines"), F.sum(F.col("_accepted").cast("bigint")).alias("accepted"))
    reasons = spark.createDataFrame(list(failed.items()), "file string, reason string")
    log = sizes.join(counted, "file", "left").join(reasons, "file", "left").select(
        F.element_at(F.split("file", "/"), -1).alias("file"),
        F.when(F.col("reason").isNull(), "loaded").otherwise("failed").alias("status"), "bytes",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in (
            ("lines", F.col("lines")), ("accepted", F.col("accepted")), ("rejected", F.col("lines") - F.col("accepted")))], "reason",
    )
    return rows.filter("_accepted").drop("_accepted"), log
