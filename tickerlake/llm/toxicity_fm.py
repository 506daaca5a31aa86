"""Toxicity: a factorization machine over hashed terms.

Terms are lower-cased words and their beginnings of four, five and six bytes, so that an inflected insult is met by its stem.
The machine's margin is ``bias + sum(w) + 1/2 * sum_f((sum v_f)^2 - sum v_f^2)`` over the terms present in a text: the
second part learns what pairs of terms add, such as an insult beside a mention of a group, which additive weights miss.

It is fitted by AdaGrad on about ``SAMPLE_ROWS`` labelled rows, twice as many at most, over the terms that differ between the classes there, or
whose texts do where they stand beside some other term; a logistic curve on margins of unseen rows gives scores. The model is a table of fixed size. Results for odd rows: every text is scored whole, however long. NULL
and empty texts have no terms and get the score of the bias. Without labelled rows of both classes every text gets the
share of label 1 (0.5 without rows). Repeated rows get a row and the same score each, rows without doc_id are scored like others. There are no ties to break: a score of the threshold is
predicted 1. An empty table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import id_remainder, table, texts
from tickerlake.llm.quality_nbsvm import distinct_terms, labelled_sample, logistic_fit
from tickerlake.llm.words import U64, Words, mix, slices

#: Labelled rows that the machine is fitted on at most.
SAMPLE_ROWS = 5000
BITS = 20
FACTORS = 6
MIN_TEXTS = 3
#: Chi-square below which a term's difference between the classes may be chance: one term in many thousands exceeds it so.
LEAST_GAIN = 12.0
#: Terms whose pairs are counted at a time.
BLOCK = 1024
STEMS = (4, 5, 6)
THRESHOLD = 0.3


def term_ids(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of all terms, with repeats."""
    h = words.hashes(lower=True)
    text = words.text_of(np.arange(len(h)))
    found = [(text, h)]
    for size in STEMS:
        long = np.flatnonzero(words.ends - words.starts >= size)
        stem = Words(words.data, words.starts[long], words.starts[long] + size, words.offsets, words.text_offsets)
        found.append((text[long], mix(stem.hashes(lower=True) + U64(size))))
    return np.concatenate([t for t, _ in found]), np.concatenate([h for _, h in found]) >> U64(64 - BITS)


@dataclass
class Machine:
    """``index`` maps a hashed term to its row in ``linear`` and ``factors``, or to -1."""

    index: np.ndarray
    linear: np.ndarray
    factors: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, text: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Margins of n texts from their distinct (text, row) entries."""
        out = self.bias + np.bincount(text, self.linear[row], minlength=n)
        for f in range(self.factors.shape[1]):
            v = self.factors[row, f]
            total = np.bincount(text, v, minlength=n)
            out += 0.5 * (total * total - np.bincount(text, v * v, minlength=n))
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -35, 35)))

    def entries(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        text, term = term_ids(words)
        row = self.index[term]
        return distinct_terms(text[row >= 0], row[row >= 0])


def _paired(text: np.ndarray, term: np.ndarray, label: np.ndarray, seen: np.ndarray, limit: float) -> np.ndarray:
    """Terms with a partner beside which label 1 is more frequent than either term alone explains.

    With q the larger of the two terms' shares of label 1, twice the log-likelihood ratio of a pair's texts against q reaches ``limit`` by chance with
    probability exp(-limit / 2) at most, so with a limit of 2 log(terms ** 2) about one pair of all. It is at most 2 hits log(1 / q),
    which leaves out the terms that cannot reach it in any pair, and no others.
    """
    hit = np.bincount(term[label[text] == 1], minlength=len(seen))
    share = (hit + 0.5) / (seen + 1)
    able = np.flatnonzero((seen >= MIN_TEXTS) & (-2 * hit * np.log(share) >= limit))
    row = np.empty(len(label), np.int64)
    row[np.argsort(-label, kind="stable")] = np.arange(len(label))
    pos = int(label.sum())
    place = np.full(len(seen), -1)
    place[able] = np.arange(len(able))
    own = np.flatnonzero(place[term] >= 0)
    own = own[np.argsort(place[term[own]], kind="stable")]
    at, column = row[text[own]], place[term[own]]

    def part(low: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(column, (low, low + BLOCK))
        out = np.zeros((len(label), min(BLOCK, len(able) - low)), np.float32)
        out[at[a:b], column[a:b] - low] = 1
        return out, share[able[low : low + BLOCK]]

    found = np.zeros(len(able), bool)
    for i in range(0, len(able), BLOCK):
        one, p = part(i)
        for j in range(i, len(able), BLOCK):
            other, r = part(j)
            q = np.maximum(p[:, None], r[None, :])
            hits = one[:pos].T @ other[:pos]
            x, y = np.nonzero(-2 * hits * np.log(q) >= limit)
            if not len(x):
                continue
            h, n, q = hits[x, y].astype(float), (one.T @ other)[x, y].astype(float), q[x, y]
            miss = n - h
            ratio = 2 * (h * np.log(h / (n * q)) + miss * np.log(np.maximum(miss, 1) / (n * (1 - q))))
            good = (h > n * q) & (ratio >= limit)
            found[i + x[good]] = True
            found[j + y[good]] = True
    return able[found]


def _choose(text: np.ndarray, term: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Index of the terms that tell something of the label, alone by their chi-square statistic or in a pair."""
    size, n, pos = 1 << BITS, len(label), label.sum()
    seen = np.bincount(term, minlength=size).astype(float)
    hit = np.bincount(term[label[text] == 1], minlength=size)
    spread = seen * (n - seen) * pos * (n - pos)
    gain = np.where((seen >= MIN_TEXTS) & (spread > 0), n * (hit * n - seen * pos) ** 2 / np.maximum(spread, 1), 0)
    often = np.flatnonzero(seen >= MIN_TEXTS)
    limit = 4 * np.log(max(2, len(often)))
    paired = np.concatenate([_paired(text, term, label, seen, limit), _paired(text, term, 1 - label, seen, limit)])
    best = np.union1d(np.flatnonzero(gain >= LEAST_GAIN), paired)
    index = np.full(size, -1, np.int32)
    index[best] = np.arange(len(best))
    return index


def _train(text: np.ndarray, row: np.ndarray, label: np.ndarray, index: np.ndarray, terms: int, epochs: int, rate: float, decay: float, seed: int = 7):
    rng = np.random.default_rng(seed)
    n = len(label)
    share = label.mean()
    machine = Machine(index, np.zeros(terms), rng.normal(0, 0.01, (terms, FACTORS)), float(np.log(share / (1 - share))))
    squares, squares_v, square_b = np.full(terms, 1e-2), np.full((terms, FACTORS), 1e-2), 1e-2
    cut = np.searchsorted(text, np.arange(n + 1))
    weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(n), max(1, n // 64)):
            size = cut[part + 1] - cut[part]
            own = np.repeat(np.arange(len(part)), size)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(cut[part], size)
            r = row[at]
            v = machine.factors[r]
            total = np.zeros((len(part), FACTORS))
            np.add.at(total, own, v)
            margin = machine.bias + np.bincount(own, machine.linear[r], minlength=len(part))
            margin += 0.5 * ((total**2).sum(1) - np.bincount(own, (v * v).sum(1), minlength=len(part)))
            slope = weight[part] * (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - label[part]) / len(part)
            g = np.bincount(r, slope[own], minlength=terms).astype(float)
            gv = np.zeros((terms, FACTORS))
            np.add.at(gv, r, slope[own][:, None] * (total[own] - v))
            seen = np.unique(r)
            g[seen] += decay * machine.linear[seen]
            gv[seen] += decay * machine.factors[seen]
            squares += g * g
            squares_v += gv * gv
            machine.linear -= rate * g / np.sqrt(squares)
            machine.factors -= rate * gv / np.sqrt(squares_v)
            gb = slope.sum()
            square_b += gb * gb
            machine.bias -= rate * gb / np.sqrt(square_b)
    return machine


def fit(sample: list[tuple[str | None, int]], epochs: int = 20, rate: float = 0.1, decay: float = 1e-4) -> Machine:
    """The machine from (text, label) rows."""
    label = np.array([int(x[1]) for x in sample], np.int64)
    n, pos = len(label), int(label.sum())
    if pos in (0, n):
        share = min(max(pos / n if n else 0.5, 1e-3), 1 - 1e-3)
        return Machine(np.full(1 << BITS, -1, np.int32), np.zeros(1), np.zeros((1, FACTORS)), float(np.log(share / (1 - share))))
    text, term = [], []
    for low, _, words in slices(pa.array([x[0] for x in sample], pa.string())):
        t, h = distinct_terms(*term_ids(words))
        text.append((t + low).astype(np.int32))
        term.append(h.astype(np.int32))
    text, term = np.concatenate(text), np.concatenate(term)

    def machine(rows: np.ndarray) -> Machine:
        place = np.full(n, -1)
        place[rows] = np.arange(len(rows))
        own = place[text] >= 0
        t, h = place[text[own]], term[own]
        index = _choose(t, h, label[rows])
        kept = index[h] >= 0
        order = np.argsort(t[kept], kind="stable")
        return _train(t[kept][order], index[h[kept]][order], label[rows], index, max(1, int(index.max()) + 1), epochs, rate, decay)

    margin, fold = np.zeros(n), np.random.default_rng(3).permutation(n) % 2
    for k in (0, 1):
        rows = np.flatnonzero(fold != k)
        if 0 < label[rows].sum() < len(rows):
            half = machine(rows)
            other = (fold[text] == k) & (half.index[term] >= 0)
            margin[fold == k] = half.margin(text[other], half.index[term[other]], n)[fold == k]
    fitted = machine(np.arange(n))
    fitted.slope, fitted.shift = logistic_fit(margin, label)
    return fitted


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for b in batches:
            for low, high, words in slices(b.column("text")):
                value = fitted.score(fitted.margin(*fitted.entries(words), high - low))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(low, high - low), pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    return texts(docs).mapInArrow(run, "doc_id bigint, score double, predicted int")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", 4, 2, SAMPLE_ROWS))
    scored = score(docs, machine)
    return scored.select("doc_id", F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")
