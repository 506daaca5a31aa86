"""Nearest members of a class by size, without comparing all pairs.

The members of a class are folded to size levels and numbered in size order. A probe gets its
position in that order and looks up the few levels on either side by (class, position), so work
grows with probes times ``reach``, however large the class is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.operators.ranking import running_total
from tickerlake.session import materialise


def _smallest_rows(rows: DataFrame, by: list[str], reach: int) -> DataFrame:
    first = F.row_number().over(Window.partitionBy(*by).orderBy("symbol"))
    return rows.select(*by, "symbol").withColumn("_n", first).filter(F.col("_n") <= reach)


def smallest_symbols(rows: DataFrame, by: list[str], reach: int) -> DataFrame:
    """Per group the ``reach`` smallest symbols: no later one can be chosen among equals."""
    kept = _smallest_rows(rows, by, reach)
    return kept.groupBy(*by).agg(F.array_sort(F.collect_list("symbol")).alias("_symbols"))


def nearest_levels(levels: DataFrame, probes: DataFrame, cls: list[str], size: str, reach: int) -> DataFrame:
    """(probe columns, _level_size, _symbols): up to ``reach`` levels at or below and above each probe's size.

    ``levels`` has one row per (class, size). Levels sort before probes of the same size, so a probe's
    position is the number of levels not larger than it.
    """
    keep = [c for c in probes.columns if c not in (*cls, size)]
    symbols_type = levels.schema["_symbols"].dataType
    both = levels.select(
        *cls, size, F.lit(0).alias("_side"), F.lit(1).cast("bigint").alias("_w"), "_symbols",
        *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in keep],
    ).unionByName(
        probes.select(
            *cls, size, F.lit(1).alias("_side"), F.lit(0).cast("bigint").alias("_w"),
            F.lit(None).cast(symbols_type).alias("_symbols"), *keep,
        )
    )
    order = [F.col(size), F.col("_side"), *[F.col(c) for c in keep]]
    placed = running_total(both, cls, order, "_pos", weight="_w")
    numbered = placed.filter("_side = 0").select(*cls, "_pos", F.col(size).alias("_level_size"), "_symbols")
    offsets = F.explode(F.sequence(F.lit(1 - reach), F.lit(reach)))
    wanted = (
        placed.filter("_side = 1")
        .select(*cls, size, *keep, "_pos", offsets.alias("_o"))
        .withColumn("_pos", F.col("_pos") + F.col("_o"))
        .filter("_pos >= 1")
        .drop("_o")
    )
    return wanted.join(numbered, [*cls, "_pos"]).drop("_pos")


def size_distance(a: Column, b: Column) -> Column:
    return F.when(a == b, 0.0).otherwise(F.abs(F.ln(a / b)))


def _pick(candidates: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` nearest candidates per symbol; the row limit is applied before the shuffle."""
    best = F.row_number().over(Window.partitionBy("symbol").orderBy("_distance", "peer_symbol"))
    return candidates.withColumn("rank", best).filter(F.col("rank") <= limit).select("symbol", "peer_symbol", "rank")


def _without(candidates: DataFrame, existing: DataFrame | None) -> DataFrame:
    others = candidates.filter("peer_symbol <> symbol")
    return others if existing is None else others.join(existing, ["symbol", "peer_symbol"], "left_anti")


def _unsized(probes: DataFrame, universe: DataFrame, cls: list[str], reach: int) -> DataFrame:
    """Probes without a size take the first symbols of their class."""
    return (
        probes.join(smallest_symbols(universe, cls, reach), cls)
        .select("symbol", F.explode("_symbols").alias("peer_symbol"), F.lit(0.0).alias("_distance"))
    )


def _in_band(found: DataFrame, size: str, low: float, high: float) -> DataFrame:
    return (
        found.filter(F.col("_level_size").between(F.col(size) * low, F.col(size) * high))
        .withColumn("_distance", size_distance(F.col("_level_size"), F.col(size)))
        .select("symbol", F.explode("_symbols").alias("peer_symbol"), "_distance")
    )


def similar_by_size(
    universe: DataFrame,
    probes: DataFrame,
    cls: list[str],
    size: str,
    limit: int = 10,
    existing: DataFrame | None = None,
    known: int = 0,
    low: float = 0.5,
    high: float = 2.0,
) -> DataFrame:
    """For each probe the ``limit`` nearest members of its class with size in ``low``..``high`` times its own.

    Nearest by absolute log ratio, then symbol. A probe without a size skips the band. ``existing`` edges are
    left out; ``known`` is the most of them a probe can have, so enough candidates are looked up.
    """
    reach = limit + known + 1
    columns = ["symbol", *cls, size]
    sized = universe.select(*columns).filter(F.col(size) >= 0)
    levels = smallest_symbols(sized, [*cls, size], reach)
    banded = probes.select(*columns).filter(F.col(size) >= 0)
    found = _in_band(nearest_levels(levels, banded, cls, size, reach), size, low, high)
    free = _unsized(probes.select(*columns).filter(F.col(size).isNull()), universe, cls, reach)
    return _pick(_without(found.unionByName(free), existing), limit)


#: Width of a step of logarithms, just over that of the band's longer side (ln 1.25), and the step of a rate of 0.
RATE_STEP, NO_RATE = 0.2232, -1_000_000


def similar_funds(
    universe: DataFrame,
    probes: DataFrame,
    cls: list[str],
    limit: int = 10,
    existing: DataFrame | None = None,
    known: int = 0,
) -> DataFrame:
    """Funds of the same class with expense ratio within 20 % and assets within half to double.

    A missing measure skips its band. Nearest by assets, else by expense ratio, then symbol. With both known the
    class is refined by the probes' expense ratios, which are few (rates have fixed precision): a fund is a member of
    each whose band it lies in, so a probe is searched by assets once, and not once for every level of its band.
    """
    reach = limit + known + 1
    er, aum = "expense_ratio", "aum"
    columns = ["symbol", *cls, er, aum]
    u, p = universe.select(*columns), probes.select(*columns)
    has_er, has_aum = F.col(er).isNotNull(), F.col(aum).isNotNull()

    rates = u.filter(has_er & has_aum).select(*cls, F.col(er).alias("_level_er")).distinct()
    probe_rates = p.filter(has_er & has_aum).select(*cls, er).distinct()
    # a band of 20 % spans at most the neighbouring steps of the rate's logarithm, so no class meets all of its rates
    step = F.when(F.col(er) > 0, F.floor(F.ln(er) / RATE_STEP)).otherwise(F.lit(NO_RATE))
    wanted = probe_rates.withColumn("_step", F.explode(F.array(step - 1, step, step + 1)))
    rates = rates.withColumn(er, F.col("_level_er")).withColumn("_step", step).drop(er)
    in_band = wanted.join(rates, [*cls, "_step"]).filter(F.col("_level_er").between(F.col(er) * 0.8, F.col(er) * 1.2)).drop("_step")
    # stored, so that its true size decides whether it is broadcast
    in_band = materialise(in_band, "rate-bands")
    known_both = u.filter(has_er & has_aum).withColumnRenamed(er, "_level_er")
    # ties are cut first, so no level is hot afterwards and its members can be dealt out without a sort of a task's copies
    members = _smallest_rows(known_both, [*cls, "_level_er", aum], reach).join(in_band, [*cls, "_level_er"])
    members = members.select(*cls, er, aum, "symbol").repartition(*cls, er, aum)
    both_levels = smallest_symbols(members, [*cls, er, aum], reach)
    both = _in_band(nearest_levels(both_levels, p.filter(has_er & has_aum), [*cls, er], aum, reach), aum, 0.5, 2.0)

    def one_measure(measure: str, low: float, high: float, rows: Column) -> DataFrame:
        levels = smallest_symbols(u.filter(F.col(measure).isNotNull()), [*cls, measure], reach)
        wanted = p.filter(rows).select("symbol", *cls, measure)
        return _in_band(nearest_levels(levels, wanted, cls, measure, reach), measure, low, high)

    by_aum = one_measure(aum, 0.5, 2.0, ~has_er & has_aum)
    by_er = one_measure(er, 0.8, 1.2, has_er & ~has_aum)
    free = _unsized(p.filter(~has_er & ~has_aum), u, cls, reach)
    found = both.unionByName(by_aum).unionByName(by_er).unionByName(free)
    return _pick(_without(found, existing), limit)
