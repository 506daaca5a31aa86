"""Joins. Only tables of a fixed or stated size are broadcast; for the rest Spark decides from statistics,
and adaptive skew handling splits hot join keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_scores_profile(scores: DataFrame, profile: DataFrame) -> DataFrame:
    return scores.join(profile, "symbol")


def semi_join_universe(rows: DataFrame, universe: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows whose key is in the universe. The universe grows with the data, so no broadcast is forced."""
    return rows.join(universe.select(key), key, "left_semi")


def filter_in_list(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The ``IN (list)`` filter for lists of any length."""
    return rows.join(wanted.select(key), key, "left_semi")


def anti_join_existing(candidates: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates not present yet."""
    return candidates.join(existing.select(*keys), keys, "left_anti")


def merge_frames(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of frames with one row per key and distinct other columns.

    A union and one aggregate: a single shuffle, where a chain of full joins would shuffle again at every step.
    """
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in keys])


def merge_right_biased(left: DataFrame, right: DataFrame, key: str = "symbol") -> DataFrame:
    """Columns of both sides for keys present in both; the right side wins on shared names."""
    own = [c for c in left.columns if c == key or c not in right.columns]
    return left.select(*own).join(right, key)


def merge_profile_quote(profiles: DataFrame, quotes: DataFrame) -> DataFrame:
    """Profile rows with quote values; a missing or zero cap falls back to the quote's, text defaults filled."""
    q = quotes.select(
        "symbol", F.col("market_cap").alias("_quote_cap"), F.col("price").alias("current_price"),
        "change_percentage", "volume",
    )
    merged = profiles.join(q, "symbol", "left")
    defaults = {"country": "US", "currency": "USD", "company_name": "", "exchange": "", "sector": "", "industry": ""}
    filled = {c: F.coalesce(F.col(c), F.lit(d)) for c, d in defaults.items() if c in profiles.columns}
    cap = F.coalesce(F.nullif(F.col("mkt_cap"), F.lit(0)), F.col("_quote_cap"))
    return merged.withColumns({**filled, "market_cap": cap}).drop("_quote_cap", "mkt_cap")


def peer_group_expand(peers: DataFrame, references: DataFrame) -> DataFrame:
    """(ref, symbol): each reference with itself and its peers, once each; groups of one are dropped.

    Text symbols are trimmed and upper-cased.
    """

    def tidy(name: str, df: DataFrame):
        return F.upper(F.trim(name)) if dict(df.dtypes)[name] == "string" else F.col(name)

    refs = references.select(tidy("symbol", references).alias("ref")).filter("ref IS NOT NULL")
    # both inputs of the semi join come straight from a shuffle, so a hot reference is split adaptively
    edges = (
        peers.select(tidy("symbol", peers).alias("ref"), tidy("peer_symbol", peers).alias("symbol"))
        .filter("symbol IS NOT NULL AND cast(symbol AS string) <> '' AND symbol <> ref")
        .join(refs, "ref", "left_semi")
        .distinct()
    )
    paired = edges.select("ref").distinct().select("ref", F.col("ref").alias("symbol"))
    return edges.unionByName(paired)


def constituents_expand(sector_map: dict[str, str], profile: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """(parent, symbol): members of each sector parent, and of the parents given as lists."""
    spark = profile.sparkSession
    # one row per sector parent
    parents = spark.createDataFrame(list(sector_map.items()), "parent_symbol string, sector string")
    members = profile.join(F.broadcast(parents), "sector").select("parent_symbol", "symbol")
    return members if lists is None else members.unionByName(lists.select("parent_symbol", "symbol"))


def join_by_identifier(data: DataFrame, quotes: DataFrame, key: str = "identifier") -> DataFrame:
    return data.join(quotes, key)
