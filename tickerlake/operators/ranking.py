"""Exact ranks over groups of any size.

``row_number`` over a window keeps a whole group in one task. Here rows are range-partitioned
on (group, order), each slice is numbered on its own and shifted by the size of the slices
before it, so a group holding a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.operators.skew import join_groups
from tickerlake.session import materialise


def running_total(
    df: DataFrame, group: list[str], order: list[Column], out: str, weight: str | None = None, total: str | None = None
) -> DataFrame:
    """Adds ``out``: the sum of ``weight`` (1 if not given) over the group up to and including the row.

    ``order`` must be a total order inside a group. ``total`` optionally adds the group's full sum.
    """
    value = F.col(weight) if weight else F.lit(1).cast("bigint")
    # no number is given, so small inputs are merged into few slices; merging keeps their order
    spread = df.repartitionByRange(*group, *order).withColumn("_slice", F.spark_partition_id())
    # written once: the slice numbers must be the same for both uses below
    spread = materialise(spread, "slices")
    per_slice = spread.groupBy(*group, "_slice").agg(F.sum(value).alias("_sum"))
    # at most one row per slice and group in this window
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    if total:
        offsets = offsets.withColumn(total, F.sum("_sum").over(Window.partitionBy(*group)))
    inside = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = spread.withColumn("_local", F.sum(value).over(inside))
    return (
        join_groups(numbered, offsets.drop("_sum"), [*group, "_slice"])
        .withColumn(out, F.col("_local") + F.col("_before"))
        .drop("_slice", "_local", "_before")
    )


def rank_across(df: DataFrame, group: list[str], order: list[Column], out: str, total: str | None = None) -> DataFrame:
    """``row_number`` per group without holding a group in one task."""
    return running_total(df, group, order, out, total=total)


def value_positions(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Per distinct value: rows below it, rows up to it, rows in the group.

    Ties are counted before the shuffle, so a value shared by most rows costs one row.
    """
    counts = df.groupBy(*group, value).agg(F.count("*").alias("_n"))
    totals = running_total(counts, group, [F.col(value)], "n_up_to", weight="_n", total="n_all")
    return totals.withColumn("n_below", F.col("n_up_to") - F.col("_n")).drop("_n")


def cume_share(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Share of the group's rows with a value at most the row's (``cume_dist``)."""
    positions = value_positions(df, group, value).select(
        *group, value, (F.col("n_up_to") / F.col("n_all")).alias(out)
    )
    return join_groups(df, positions, [*group, value])


def quartile_percentile(df: DataFrame, group: list[str], value: str, key: str) -> DataFrame:
    """``quartile`` (ntile 4) and ``percentile`` (percent_rank) of ``value`` in its group; 1 is best."""
    df = materialise(df, "ranked")
    ranked = rank_across(df, group, [F.col(value).desc_nulls_last(), F.col(key)], "_rn", total="_all")
    size, spare = F.floor(F.col("_all") / 4), F.col("_all") % 4
    # the first `spare` tiles hold one row more
    large = spare * (size + 1)
    tile = F.when(F.col("_rn") <= large, F.floor((F.col("_rn") - 1) / (size + 1))).otherwise(
        spare + F.floor(F.try_divide(F.col("_rn") - 1 - large, size))
    )
    above = F.col("n_all") - F.col("n_up_to")
    ties = value_positions(df, group, value).select(*group, value, above.alias("_above"))
    return (
        join_groups(ranked, ties, [*group, value])
        .withColumn("quartile", (tile + 1).cast("int"))
        .withColumn("percentile", F.coalesce(F.try_divide(F.col("_above"), F.col("_all") - 1), F.lit(0.0)))
        .drop("_rn", "_all", "_above")
    )
