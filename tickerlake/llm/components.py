"""Connected components of a link table, by contraction: each round hooks every node to its smallest neighbour, follows the
hooks to their roots by doubling, and replaces the links by links between roots. Rounds and doublings grow with the logarithm of
the longest chain. Every round is written to the shared folder, which cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.session import materialise


def _roots(hooks: DataFrame) -> DataFrame:
    """(node, root) from (node, root) where a root may be hooked further."""
    while True:
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        hooks = materialise(hooks.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "hooks")
        if not hooks.where("moved").limit(1).count():
            return hooks.select("node", "root")
        hooks = hooks.select("node", "root")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in a link (a, b) that is not the smallest of its component; root is the smallest."""
    links = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    found = None
    while links.limit(1).count():
        # A node hooks to its smallest neighbour if that is smaller than itself; both ends of a link are considered by the larger one.
        hooks = materialise(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "hooks")
        roots = _roots(hooks)
        if found is None:
            found = roots
        else:
            moved = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            kept = found.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            found = materialise(kept.unionByName(roots), "roots")
        for side in ("a", "b"):
            to = roots.select(F.col("node").alias(side), F.col("root").alias("to"))
            links = links.join(to, side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
        links = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    if found is None:
        return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return found
