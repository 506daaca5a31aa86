import random
from collections import Counter

import numpy as np

from tickerlake.llm import minmax_hash, ngram_join
from tickerlake.llm.minmax_hash import min_max, near_copies
from test_ngram_join import brute, counted, family


def check(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n bigint, key string, node string").repartition(parts)
    found = Counter((d, n, c) for d, n, c, _ in near_copies(df).collect())
    assert found == brute([(i, t) for i, t, *_ in rows], 5, 85, 100)
    return df


def rows_of(texts):
    return [(i, t, 1, "k", "x") for i, t in enumerate(texts)]


def test_families_whose_smallest_is_no_centre(spark):
    rng = random.Random(5)
    texts = family(rng, 60, 200, 8) + family(rng, 40, 60, 2) + family(rng, 30, 12, 1) + [f"u{i} v{i}" for i in range(20)]
    rng.shuffle(texts)
    check(spark, rows_of(texts))


def test_a_family_that_no_task_compares_at_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "DIRECT", 2)
    monkeypatch.setattr(ngram_join, "FAMILY", 8)
    rng = random.Random(9)
    check(spark, rows_of(family(rng, 50, 120, 6) + family(rng, 20, 120, 6)))


def test_hot_copies_and_white_space(spark):
    text = " ".join(f"w{i}" for i in range(40))
    texts = [text] * 300 + [text.replace(" ", "\n"), text.upper(), text + " more", " ".join(text.split()[1:])]
    df = check(spark, rows_of(texts), 7)
    kept = [r for r in near_copies(df).collect() if r["kept"]]
    assert [r["doc_id"] for r in kept] == [0]


def test_values_estimate_the_similarity():
    rng = np.random.default_rng(0)
    union = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    one, other = np.sort(union[:900]), np.sort(union[100:])
    values = min_max(np.concatenate([one, other, one[:0]]), np.array([0, 900, 1800, 1800]))
    assert abs((values[0] == values[1]).mean() - 0.8) < 0.15
    assert values[0, 0] == (one * minmax_hash._ODD[0] + minmax_hash._SHIFT[0]).min()
    assert values[0, minmax_hash.PERMUTATIONS] == (one * minmax_hash._ODD[0] + minmax_hash._SHIFT[0]).max()
    assert not values[2].any()


def test_odd_rows(spark, odd_docs, no_docs):
    rows = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_copies(odd_docs).collect()}
    assert {(1, 16, 1, True), (2, 16, 1, False), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 1, 7, True), (3, 17, 3, True)} <= rows
    assert [r[2:] for r in rows if r[0] is None] == [(None, True)]
    assert near_copies(odd_docs).count() == odd_docs.count()
    assert near_copies(no_docs).count() == 0


def test_ids_missing_or_repeated(frame):
    a, b, c = (" ".join(f"{p}{i}" for i in range(12)) for p in "abc")
    df = frame("doc_id bigint, text string", (1, a), (5, a), (5, b), (7, b), (None, c), (None, c), (None, b + " end"), (9, "z"))
    found = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_copies(df).collect()), key=str)
    assert [f for f in found if f[0] is not None] == [(1, 1, True), (5, 1, False), (5, 1, False), (7, 1, False), (9, 9, True)]
    assert Counter(f for f in found if f[0] is None) == {(None, None, True): 2, (None, 1, False): 1}


def test_a_family_is_compared_around_one_centre(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "DIRECT", 3)
    seen = counted(monkeypatch)
    texts = family(random.Random(29), 250, 200, 6)
    check(spark, rows_of(texts))
    assert sum(seen) < len(texts)
