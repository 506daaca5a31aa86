"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tickerlake", cpus: int | str = "*", partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster supplies its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    if not SparkSession.getActiveSession() and not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tickerlake-"))
    if not SparkSession.getActiveSession() and not SparkConf().contains("spark.sql.warehouse.dir"):
        builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tickerlake-tables-"))
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as ``spark.checkpoint.dir`` names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so concurrent jobs cannot collide."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def table_path(spark: SparkSession, table: str, root: str | None = None) -> str:
    """A fresh version folder of a stored table, under ``root`` or the warehouse folder; unlike scratch, it outlives a job.

    It is not inside the folder that a managed table of that name would own, which goes when such a table is dropped.
    """
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{table}.versions/version-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage on durable storage: a lost executor re-reads files instead of
    recomputing, and every reader sees the same rows. Parquet keeps column pruning.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reason_of(error: Exception) -> str:
    """The first line that says what went wrong."""
    lines = [x.strip() for x in str(error).splitlines() if x.strip()]
    causes = [x.removeprefix("Caused by: ") for x in lines if x.startswith("Caused by: ")]
    return (causes or lines or [type(error).__name__])[-1 if causes else 0][:500]
