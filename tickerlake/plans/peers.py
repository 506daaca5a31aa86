"""Peer lists: from vendor dumps, and topped up with similar companies or funds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickerlake.operators.aggregates import peer_count_having
from tickerlake.operators.nested import split_trim_explode
from tickerlake.operators.similarity import similar_by_size, similar_funds
from tickerlake.session import materialise

EQUITY_CLASS = ["sector", "industry", "currency"]
FUND_CLASS = ["currency", "domicile", "asset_class"]


def peers_from_bulk(lists: DataFrame, profile: DataFrame) -> DataFrame:
    """Comma lists to distinct edges of the profile's symbols. Lists are dropped before they are exploded."""
    known = lists.join(profile.select("symbol"), "symbol", "left_semi")
    return split_trim_explode(known, "symbol", "peers", "peer_symbol").distinct()


def _short_of_peers(universe: DataFrame, peers: DataFrame, at_most: int) -> DataFrame:
    few = peer_count_having(peers, at_most).select("symbol")
    return universe.join(few, "symbol", "left_semi")


def peers_boost_equity(profile: DataFrame, peers: DataFrame, at_most: int = 3, limit: int = 10) -> DataFrame:
    """New edges for companies with at most three peers: the nearest by market cap in their class."""
    probes = materialise(_short_of_peers(profile, peers, at_most), "probes")
    mine = peers.join(probes.select("symbol"), "symbol", "left_semi")
    return similar_by_size(profile, probes, EQUITY_CLASS, "mkt_cap", limit, mine, at_most)


def peers_boost_etf(profile: DataFrame, peers: DataFrame, at_most: int = 3, limit: int = 10) -> DataFrame:
    """New edges for funds with at most three peers: similar cost and assets in their class."""
    probes = materialise(_short_of_peers(profile, peers, at_most), "probes")
    mine = peers.join(probes.select("symbol"), "symbol", "left_semi")
    return similar_funds(profile, probes, FUND_CLASS, limit, mine, at_most)
