"""Hot groups: a third or more of all rows share one key."""

import random

import pytest
from pyspark.sql import functions as F

from tickerlake.operators import ranking, similarity, skew, timeseries as ts, topk, upsert
from tickerlake.plans import peers as peer_plans
from tickerlake.session import materialise


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 2 else f"g{i % 7}", i, float(rng.randint(0, 40))) for i in range(3000)]
    # a group without a name is a group too
    rows += [(None, 5000 + i, float(i % 3)) for i in range(25)]
    return rows, materialise(spark.createDataFrame(rows, "g string, id int, v double"), "hot")


def test_rank_across_equals_sort(hot):
    rows, df = hot
    ranked = ranking.rank_across(df, ["g"], [F.col("v").desc(), F.col("id")], "rank", total="n")
    got = {r.id: (r["rank"], r.n) for r in ranked.collect()}
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        assert [got[r[1]] for r in members] == [(i, len(members)) for i in range(1, len(members) + 1)]


def test_rank_across_splits_the_hot_group(hot, spark):
    # small slices are not merged here
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.rank_across(hot[1], ["g"], [F.col("v").desc(), F.col("id")], "rank")
        got = sorted((tuple(r) for r in ranked.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    merged = ranking.rank_across(hot[1], ["g"], [F.col("v").desc(), F.col("id")], "rank")
    assert got == sorted((tuple(r) for r in merged.collect()), key=str)
    source = ranked.inputFiles()
    slices = ranked.sparkSession.read.parquet(*source).filter("g = 'hot'").select("_slice").distinct().count()
    assert slices > 1


def test_cume_share_and_quartiles(hot):
    rows, df = hot
    share = {r.id: r.s for r in ranking.cume_share(df, ["g"], "v", "s").collect()}
    tiles = {r.id: (r.quartile, r.percentile) for r in ranking.quartile_percentile(df, ["g"], "v", "id").collect()}
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        n = len(members)
        for i, r in enumerate(members):
            assert share[r[1]] == sum(o[2] <= r[2] for o in members) / n
            assert tiles[r[1]][1] == pytest.approx(sum(o[2] > r[2] for o in members) / (n - 1))
        sizes = [sum(tiles[r[1]][0] == q for r in members) for q in (1, 2, 3, 4)]
        assert sizes == [n // 4 + (q < n % 4) for q in range(4)]


def test_join_unique_same_rows_when_split(hot):
    _, df = hot
    stats = df.groupBy("g").agg(F.max("v").alias("top"), F.count("*").alias("n"))
    cut = skew.join_unique(df, stats, ["g"], "id").select("g", "id", "v", "top", "n")
    rows, want = hot[0], []
    for g, i, v in rows:
        members = [r[2] for r in rows if r[0] == g]
        want.append((g, i, v, max(members), len(members)))
    assert sorted((tuple(r) for r in cut.collect()), key=lambda r: r[1]) == sorted(want, key=lambda r: r[1])


def test_missing_values_rank_last(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None), ("a", 3, 7.0), ("a", 4, None)], "g string, id int, v double")
    got = {r.id: (r.quartile, r.percentile) for r in ranking.quartile_percentile(df, ["g"], "v", "id").collect()}
    assert got == {3: (1, 0.0), 1: (2, pytest.approx(1 / 3)), 2: (3, pytest.approx(2 / 3)), 4: (4, pytest.approx(2 / 3))}


def test_dedupe_and_topk_limit_before_the_shuffle(hot, spark):
    plan = upsert.dedupe_by_key(hot[1], ["g"], [])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
    plan = topk.top_k(hot[1], ["g"], [F.col("v")], 3)._jdf.queryExecution().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") >= 2


def brute(rows, limit=10, existing=(), only=None):
    import math

    out = set()
    for s, cls, cap in rows:
        if only is not None and s not in only:
            continue
        found = []
        for o, ocls, ocap in rows:
            if o == s or ocls != cls or cls is None or (s, o) in existing:
                continue
            if cap is None:
                found.append((0.0, o))
            elif ocap is not None and cap * 0.5 <= ocap <= cap * 2.0:
                found.append((0.0 if ocap == cap else abs(math.log(ocap / cap)), o))
        out |= {(s, o, i) for i, (_, o) in enumerate(sorted(found)[:limit], 1)}
    return out


def test_similar_by_size_with_a_hot_class_and_ties(spark):
    rng = random.Random(11)
    caps = [None, -5.0, 0.0, 100.0, 100.0, 100.0, *[float(rng.randint(1, 400)) for _ in range(40)]]
    rows = [(i, "hot" if i % 3 else f"c{i % 4}", rng.choice(caps)) for i in range(400)]
    rows += [(1000 + i, "hot", 100.0) for i in range(60)] + [(2000, None, 50.0)]
    df = spark.createDataFrame(rows, "symbol int, cls string, cap double")
    got = {tuple(r) for r in similarity.similar_by_size(df, df, ["cls"], "cap").collect()}
    assert got == brute(rows)


def test_boost_excludes_known_peers(spark):
    rng = random.Random(3)
    base = [(i, "s", "i", "USD", float(rng.randint(50, 90))) for i in range(80)]
    profile = spark.createDataFrame(base, "symbol int, sector string, industry string, currency string, mkt_cap double")
    edges = [(s, (s + k) % 80) for s in range(80) for k in range(1, 2 + s % 5)]
    peers = spark.createDataFrame(edges, "symbol int, peer_symbol int")
    got = {tuple(r) for r in peer_plans.peers_boost_equity(profile, peers).collect()}
    few = {s for s in range(80) if sum(e[0] == s for e in edges) <= 3}
    assert got == brute([(s, "s", cap) for s, _, _, _, cap in base], existing=set(edges), only=few)


def test_trailing_count_across_blocks(spark):
    start = 1_700_000_000 - 1_700_000_000 % 3600
    seconds = sorted(random.Random(2).sample(range(7300), 700))
    calls = spark.createDataFrame([("hot", start + s) for s in seconds], "endpoint string, s bigint")
    calls = calls.select("endpoint", F.timestamp_seconds("s").alias("ts"))
    got = {r.second - start: r.trailing_calls for r in ts.trailing_window_count(calls, "endpoint", "ts", 60, 8).collect()}
    assert got == {s: sum(s - 60 <= o <= s for o in seconds) for s in seconds}


def brute_funds(rows, limit=10):
    import math

    out = set()
    for s, cls, er, aum in rows:
        found = []
        for o, ocls, oer, oaum in rows:
            if o == s or ocls != cls or cls is None:
                continue
            if er is not None and not (oer is not None and er * 0.8 <= oer <= er * 1.2):
                continue
            if aum is not None and not (oaum is not None and aum * 0.5 <= oaum <= aum * 2.0):
                continue
            mine, other = (aum, oaum) if aum is not None else (er, oer)
            found.append((0.0 if mine is None or mine == other else abs(math.log(other / mine)), o))
        out |= {(s, o, i) for i, (_, o) in enumerate(sorted(found)[:limit], 1)}
    return out


def test_similar_funds_searches_a_probe_once(spark, monkeypatch):
    """A class with many rates in a probe's band: levels are looked up once for each probe, not for each rate."""
    rng = random.Random(17)
    sizes = [None, 100.0, 100.0, *[float(rng.randint(50, 300)) for _ in range(40)]]
    rates = [None, 0.0, *[r / 100 for r in range(20, 50)]]
    rows = [(i, "hot" if i % 4 else f"c{i % 3}", rng.choice(rates), rng.choice(sizes)) for i in range(500)]
    rows += [(1000 + i, "hot", 0.3, 100.0) for i in range(40)] + [(2000, None, 0.3, 100.0)]
    df = spark.createDataFrame(rows, "symbol int, cls string, expense_ratio double, aum double")
    searched, real = [], similarity.nearest_levels

    def counted(levels, probes, cls, size, reach):
        searched.append(probes.count())
        return real(levels, probes, cls, size, reach)

    monkeypatch.setattr(similarity, "nearest_levels", counted)
    got = {tuple(r) for r in similarity.similar_funds(df, df, ["cls"]).collect()}
    assert got == brute_funds(rows)
    assert sum(searched) <= len(rows)
