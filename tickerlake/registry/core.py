"""Registration of a query together with the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.registry.views_sql import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _spark_column(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "d":
        return c.cast("string").alias(name)
    if kind == "t":
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name)
    if kind == "i":
        return c.cast("bigint").alias(name)
    if kind == "s":
        return c.cast("string").alias(name)
    if kind:
        return F.round(c.cast("double"), int(kind)).alias(name)
    return c


def _sql_column(name: str, kind: str) -> str:
    if kind in ("d", "s"):
        return f'CAST("{name}" AS VARCHAR) AS "{name}"'
    if kind == "t":
        return f"strftime(\"{name}\", '%Y-%m-%d %H:%M:%S') AS \"{name}\""
    if kind == "i":
        return f'CAST("{name}" AS BIGINT) AS "{name}"'
    if kind:
        return f'round(CAST("{name}" AS DOUBLE), {kind}) + 0.0 AS "{name}"'
    return f'"{name}"'


def query(name: str, out: str, views: str = "", sql: str | None = None, ctes: str = ""):
    """Register a query.

    ``out`` lists the result columns with how they are compared: ``d`` date, ``t`` timestamp,
    ``i`` integer, ``s`` text, a digit for decimal places, nothing for as-is.
    ``views`` names the test-table views the SQL reads; ``ctes`` adds further CTEs.
    """
    spec = [(c.partition(":")[0], c.partition(":")[2]) for c in out.split()]

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(spark, sf).select(*[_spark_column(*c) for c in spec])

        QUERIES[name] = run
        if sql is not None:
            head = with_views(*views.split()) if views else ""
            if ctes:
                head = f"{head}, {ctes}" if head else f"WITH {ctes}"
            columns = ", ".join(_sql_column(*c) for c in spec)
            ORACLE[name] = f"{head}\nSELECT {columns} FROM ({sql}) AS result"
        return fn

    return register
