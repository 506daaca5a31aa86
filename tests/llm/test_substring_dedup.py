import hashlib
import random
import re
from collections import Counter

from tickerlake.llm.substring_dedup import deduplicated

BIG = (1 << 63) - 1


def brute(rows, n):
    words = [(BIG if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for j in range(len(w) - n + 1):
            key = tuple(w[j : j + n])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, w in words:
        gone = {j + m for j in range(len(w) - n + 1) if first[tuple(w[j : j + n])] < i for m in range(n)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[None if i == BIG else i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept] += 1
    return out


def found(df, n):
    return Counter(tuple(r) for r in deduplicated(df, n).select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text").collect())


def test_shared_passages(spark):
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(40)}"
    passages = [[word() for _ in range(rng.randrange(5, 40))] for _ in range(12)]
    rows = []
    for i in range(120):
        own = []
        for _ in range(rng.randrange(6)):
            own += rng.choice(passages) if rng.random() < 0.6 else [word() for _ in range(rng.randrange(20))]
        rows.append((i * 3 % 121, (" " if rng.random() < 0.5 else "\n").join(own)))
    rows += [(200 + i, rows[5][1]) for i in range(20)]
    for n in (13, 4, 6):
        assert found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), n) == brute(rows, n)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs, 13) == brute(rows, 13)
    assert found(no_docs, 13) == Counter()


def test_same_words_with_other_white_space(spark):
    """Texts that differ in white space alone are not equal texts, yet all their windows repeat, also in one batch."""
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(words), "\n".join(words), "  ".join(words), " ".join(words) + "\n", " ".join(words), "\n".join(words)]
    rows = [(9 - i, t) for i, t in enumerate(texts)]
    for parts in (1, 3):
        assert found(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).repartition(parts), 13) == brute(rows, 13)


def test_rows_without_an_id(spark):
    """Rows without an id are different documents, linked to different ones, and remove nothing from each other."""
    one, two, own = ([f"{x}{i}" for i in range(40)] for x in "abc")
    rows = [
        (1, " ".join(one)), (2, " ".join(two)), (None, " ".join(one)), (None, "x y " + " ".join(two[5:30])), (None, "z " * 20 + " ".join(one[:20])),
        (None, " ".join(own)), (None, "q " + " ".join(own)), (None, "few words"), (None, None), (None, " ".join(own)),
    ]
    for parts in (1, 4):
        assert found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts), 13) == brute(rows, 13)


def test_several_texts_under_one_id(spark):
    """The first text by digest is the document's; the others lose what others have, and stand for nothing."""
    one, two, new = (" ".join(f"{x}{i}" for i in range(30)) for x in "abn")
    rows = [(1, one), (5, new + " " + one), (5, two), (7, two), (9, new), (None, new), (None, new)]
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    own = min((new + " " + one, two), key=digest)
    other = two if own != two else new + " " + one
    expected = brute([(i, t) for i, t in rows if i != 5 or t == own] + [(None, other)], 13)
    key = (None, len(other.split()))
    for k in [k for k in expected if k[:2] == key]:
        expected[(5, *k[1:])] += 1
        expected[k] -= 1
    for parts in (1, 4):
        assert found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts), 13) == +expected
