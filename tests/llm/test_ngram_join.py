import random
import re
from collections import Counter

import numpy as np
import pytest

from tickerlake.llm import ngram_join
from tickerlake.llm.components import components
from tickerlake.llm.ngram_join import similar_sets
from tickerlake.llm.shared_shingles import mostly_shared


def shingles(text, k):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and den * len(x & y) >= num * len(x | y):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    big = (1 << 63) - 1
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), big), big if d is None else d)
    value = lambda v: None if v == big else v
    return Counter((d, len(x), value(least[find(i)])) for i, (d, x) in enumerate(sets))


def family(rng, n, size, edits):
    base = [f"w{rng.randrange(3000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def check(spark, rows, k, num, den, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = Counter(tuple(r) for r in similar_sets(df, k, num, den, **more).collect())
    assert found == brute(rows, k, num, den)


def test_first_pivots_then_mixed_families(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "DIRECT", 3)
    rng = random.Random(13)
    texts = family(rng, 50, 120, 14) + family(rng, 30, 40, 4) + family(rng, 25, 200, 3) + [f"u{i} v{i} w{i}" for i in range(9)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)), 5, 80, 100, sparing=True)


def test_families_with_a_pivot_that_is_no_centre(spark):
    rng = random.Random(3)
    texts = family(rng, 60, 120, 14) + family(rng, 40, 30, 3) + family(rng, 30, 9, 1) + [f"u{i} v{i} w{i}" for i in range(20)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)), 3, 90, 100)
    check(spark, list(enumerate(texts)), 5, 80, 100)


@pytest.mark.parametrize("most", [2048, 24, 5])
def test_large_groups_use_pivots_only(spark, monkeypatch, most):
    monkeypatch.setattr(ngram_join, "DIRECT", 2)
    monkeypatch.setattr(ngram_join, "FAMILY", most)
    rng = random.Random(5)
    texts = family(rng, 80, 60, 10) + family(rng, 20, 200, 10)
    # Truncated copies link with their neighbours in length, not with the smallest document.
    base = [f"t{i}" for i in range(100)]
    texts += [" ".join(base[: 100 - 4 * i]) for i in range(15)]
    # Documents that each lack some lines of one text: many near misses.
    lines = [" ".join(f"l{i}x{j}" for j in range(8)) for i in range(12)]
    texts += ["\n".join(x for x in lines if rng.random() < 0.85) for _ in range(40)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)), 3, 90, 100)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert Counter(tuple(r) for r in similar_sets(odd_docs).collect()) == brute(rows, 3, 90, 100)
    assert similar_sets(no_docs).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (205, 204), (204, 205)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(links, "a bigint, b bigint")).select("node", "root").collect())
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 205: 204}


def test_rows_without_an_id_are_not_one_document(spark):
    """Two rows without an id resemble different documents, which do not resemble each other."""
    text = lambda x, n=40: " ".join(f"{x}{i}" for i in range(n))
    rows = [(1, text("a")), (2, text("b")), (None, text("a", 39)), (None, text("b", 39)), (None, text("c")), (None, text("c", 39)), (None, text("d")), (None, text("d")), (3, None)]
    check(spark, rows, 3, 90, 100)


def test_members_of_earlier_rounds_keep_new_ones(spark):
    """A new member is close to nothing but a member that met the same pivot in an earlier round."""
    text = lambda x: " ".join(f"{x}{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text("a")), (2, text("b")), (3, text("b") + " b40"), (4, text("c"))], "doc_id bigint, text string")
    like = ngram_join.Similarity(3, 90, 100)
    blobs = ngram_join.set_blobs(docs, like)
    pairs = lambda *rows: spark.createDataFrame(rows, "p bigint, x bigint")
    assert ngram_join.close_members(pairs((1, 3)), blobs, like).collect() == []
    kept = ngram_join.close_members(pairs((1, 3), (2, 4)), blobs, like, pairs((1, 2))).collect()
    assert [tuple(r) for r in kept] == [(1, 3)]


def test_only_documents_that_may_be_linked_are_compared(spark, monkeypatch):
    """Documents around one passage share signatures, but most of their shingles stand nowhere else; copies are one set."""
    rng = random.Random(17)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{passage} " + " ".join(f"o{i}x{j}" for j in range(60)) for i in range(40)]
    texts += [*(like := family(rng, 12, 120, 3)), like[0], texts[0]]
    seen, real = [], ngram_join.signature_members
    monkeypatch.setattr(ngram_join, "signature_members", lambda docs, like: seen.extend(r["doc_id"] for r in docs.collect()) or real(docs, like))
    check(spark, list(enumerate(texts)), 5, 80, 100, sparing=True)
    assert seen and set(seen) <= {0, *range(40, 52)}


@pytest.mark.parametrize("chunk, bucket", [(1 << 18, 1 << 21), (50, 20), (1, 5)])
def test_mostly_shared_as_counted(spark, chunk, bucket):
    rng = random.Random(19)
    texts = family(rng, 30, 40, 12) + family(rng, 10, 300, 40) + [f"u{i} v{i} w{i}" for i in range(9)] + ["a b", "a b", "", None, "c", "x y z"]
    rows = list(enumerate(texts)) + [(3, "one id with two texts"), (3, "one id with two texts")]
    sets = [(i, shingles(t, 3)) for i, t in rows]
    count = Counter(s for _, own in sets for s in own)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = mostly_shared(df, ngram_join.Similarity(3, 80, 100), sum(count.values()), chunk, bucket).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(i for i, own in sets if own and 100 * sum(count[s] > 1 for s in own) >= 80 * len(own))


def counted(monkeypatch):
    """Numbers of pairs of sets that are read, one for each call."""
    seen, real = [], ngram_join.check_pairs
    monkeypatch.setattr(ngram_join, "check_pairs", lambda pairs, *more: seen.append(pairs.count()) or real(pairs, *more))
    return seen


def test_a_family_is_compared_around_one_centre(spark, monkeypatch):
    """Members that are not linked with the smallest one meet many pivots; their sets are read once, and again only for links between different centres."""
    monkeypatch.setattr(ngram_join, "DIRECT", 3)
    monkeypatch.setattr(ngram_join, "CELLS", 1000)
    seen = counted(monkeypatch)
    texts = family(random.Random(23), 250, 200, 8)
    check(spark, list(enumerate(texts)), 5, 80, 100, sparing=True)
    assert sum(seen) < 4 * len(texts)


def test_large_sets_with_empty_parts_share_no_signature():
    """Parts that are empty in unrelated sets are no signature while other cuts of the domain have fewer of them."""
    like, rng = ngram_join.Similarity(5, 80, 100), np.random.default_rng(7)
    sets, size = 4000, 60
    x = np.sort(rng.integers(0, 1 << 63, (sets, size)).astype(np.uint64), axis=1).ravel()
    text, sig = like.signatures(x, np.arange(0, sets * size + 1, size))
    _, count = np.unique(sig, return_counts=True)
    assert count.max() < 5
    assert len(set(text)) == sets
