import math
import random

import numpy as np
import pytest

from tickerlake.llm import lemp_negatives
from tickerlake.llm.lemp_negatives import Goal, Rows, Search, coordinate_lists, hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>, score double, lane string, print string"


def brute(rows, positives=5, negatives=10, low=30, high=90, every=100):
    given = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        given[i, label, whole] = None
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, la, va in given:
        if a % every:
            continue
        others = sorted((-dot(va, v), i, label) for i, label, v in given)
        own = [(-s, i) for s, i, label in others if label == la and i != a][:positives]
        for score, p in own:
            fit = [(-s, i) for s, i, label in others if label != la and low * score <= -100 * s <= high * score][:negatives]
            out += [(a, p, rank, i, score, s) for rank, (s, i) in enumerate(fit, 1)]
    return sorted(out, key=str)


def run(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(*r, 1.0, "l", "p") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in hard_negatives(df, **more).collect()), key=str)


def clusters(n, dims=16, centres=12, spread=0.05, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    rows = middle[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dims))
    rows *= rng.lognormal(0, 0.7, n)[:, None]
    return [(i, int(rng.integers(0, 4)), [float(x) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_equals_brute_force(spark, spread, monkeypatch):
    for name, value in (("BUCKET", 64), ("BLOCK", 5), ("PROBE", 40)):
        monkeypatch.setattr(lemp_negatives, name, value)
    rows = clusters(700, spread=spread)
    assert run(spark, rows, every=20) == brute(rows, every=20)


def test_few_rows_a_hot_vector_and_ties(spark, monkeypatch):
    monkeypatch.setattr(lemp_negatives, "BUCKET", 32)
    rng = random.Random(4)
    rows = [(i, i % 3, [0.5, 0.25]) for i in range(150)] + [(200 + i, rng.randrange(3), [rng.choice([0.1, 0.2, 0.4]), rng.choice([0.1, -0.2])]) for i in range(101)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 0.5]), (2, 2, [0.5, 0.5]), (3, 2, [0.25]), (4, 2, []), (5, 3, [0.5, 0.5, 9.0]), (None, 2, [0.5, 0.5]),
            (6, None, [0.5, 0.5]), (7, 2, None), (8, 2, [nan, 0.5]), (9, 2, [inf, 0.5]), (10, 2, [None, 0.5]), (100, 5, [1.0, 0.0]), (200, 1, [0.0, 0.0]), (0, 1, [1.0, 2.5]), (0, 2, [0.5, 0.75])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [float(40_000 + i), float(3 * i), -7.5]) for i in range(40)]
    assert run(spark, rows, every=10) == brute(rows, every=10)


def test_lists_leave_out_only_rows_below_the_bound():
    data = clusters(600, spread=0.02, seed=3)
    whole = np.floor(256 * np.array([v for _, _, v in data])).astype(np.int64)
    rows = Rows(np.arange(600), np.array([label for _, label, _ in data]), np.zeros(600, np.int64), whole)
    anchors = Rows(rows.ids[:30], rows.labels[:30], rows.prints[:30], whole[:30])
    products = whole[:30] @ whole.T
    bound = np.sort(products, axis=1)[:, -5:-4]
    search = Search(anchors, Goal(True, 5), bound.copy(), np.full((30, 1), np.iinfo(np.int64).max - 1))
    anchor, row, score = search.pairs(rows, coordinate_lists(rows.unit))
    found = {(a, r): s for a, r, s in zip(anchor, row, score)}
    wanted = np.argwhere(products >= bound)
    assert all(found[a, r] == products[a, r] for a, r in wanted)
    # On clustered rows the ranges are narrow enough to leave out most rows.
    assert len(found) < 30 * 600 / 4
