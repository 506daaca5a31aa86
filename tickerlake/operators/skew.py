"""Joining group results back to their rows when one group may hold a large share of them.

Adaptive skew handling splits a hot key only where both join inputs come straight from a shuffle.
A one-row-per-group aggregate does not, so its hot groups are split here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.functions.cleaning import all_true


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which a NULL key is a group like any other, as in a window."""
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    other = groups.withColumnsRenamed(names)
    same = all_true([F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return rows.join(other, same, how).drop(*names.values())


def join_unique(rows: DataFrame, lookup: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Inner join of ``rows`` (a stored table: it is counted first) with ``lookup``, one row per key.

    A key with more rows than a task's fair share is cut into pieces by the hash of ``spread``, a column that tells the key's rows
    apart, and its lookup row is copied once per piece. There are at most as many such keys as shuffle partitions, which bounds the broadcast.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(rows.count() // slices, 1)
    hot = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > share)
        .select(*keys, F.ceil(F.col("_rows") / share).cast("int").alias("_pieces"))
    )
    hot = F.broadcast(hot)
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    cut = join_groups(rows, hot, keys, "left").withColumn("_piece", F.pmod(F.xxhash64(spread), pieces).cast("int")).drop("_pieces")
    copies = (
        join_groups(lookup, hot, keys, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_pieces")
    )
    return join_groups(cut, copies, [*keys, "_piece"]).drop("_piece")
