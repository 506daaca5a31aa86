"""Quality classifier: a linear model on n-gram indicators scaled by naive Bayes log-count ratios.

Terms are words, pairs of neighbouring words, and the last three and four bytes of a word, so that marks
on unseen words count too; a pair of equal words is one common term, and so are three. A text's indicators (a term is in it or not) are
scaled by the log ratio of the term's smoothed frequencies in the two classes. A linear hinge-loss
model is then fitted by dual coordinate descent, and a logistic curve on its margins turns them into scores.

The classifier is fitted on at most ``SAMPLE_ROWS`` labelled rows (about that many, twice as many at most, chosen by hash of their key), which bounds
the driver's work. The model is a vector of ``2 ** BITS`` weights. Results for odd rows: every text is scored whole, however long. NULL and empty texts have no terms
and get the score of the intercept. Without labelled rows of both classes every text gets the share of label 1 (0.5 without rows). Repeated rows get a row and the same score each, rows
without doc_id are scored like others. There are no ties to break: a score of the threshold is predicted 1. An empty table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import id_remainder, key_sample, table, texts
from tickerlake.llm.words import U64, Words, mix, slices, window_hashes

#: Labelled rows that a classifier is fitted on at most.
SAMPLE_ROWS = 3000
#: Terms are hashed to this many bits.
BITS = 20
MIN_TEXTS = 3
THRESHOLD = 0.3
_SAME = U64(0x5AFE << 44)
_SAME_TWICE = U64(0x7A11 << 44)


def term_ids(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of all terms, with repeats."""
    h = words.hashes()
    text = words.text_of(np.arange(len(h)))
    found = [(text, h)]
    pair = words.windows(2)
    if len(pair):
        same = h[pair] == h[pair + 1]
        found.append((text[pair], np.where(same, _SAME, window_hashes(h, pair, 2))))
        three = words.windows(3)
        three = three[(h[three] == h[three + 1]) & (h[three] == h[three + 2])]
        found.append((text[three], np.full(len(three), _SAME_TWICE)))
    for size in (3, 4):
        long = np.flatnonzero(words.ends - words.starts > size)
        tail = Words(words.data, words.ends[long] - size, words.ends[long], words.offsets, words.text_offsets)
        found.append((text[long], mix(tail.hashes() + U64(size))))
    return np.concatenate([t for t, _ in found]), np.concatenate([h for _, h in found]) >> U64(64 - BITS)


def distinct_terms(text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((text.astype(np.uint64) << U64(32)) | term.astype(np.uint64))
    return (key >> U64(32)).astype(np.int64), (key & U64(0xFFFFFFFF)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -35, 35)))


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: np.ndarray, epochs: int, seed: int = 1):
    """Linear hinge-loss weights (the last one is the intercept): one dual variable per row is optimised at a time."""
    w, alpha = np.zeros(size + 1), np.zeros(len(y))
    norm = np.array([v @ v + 1 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(y)):
            gradient = y[i] * (w[rows[i]] @ values[i] + w[size]) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                w[rows[i]] += step * y[i] * values[i]
                w[size] += step * y[i]
                alpha[i] = new
                moved = max(moved, abs(step) / cost[i])
        if moved < 1e-3:
            break
    return w


def logistic_fit(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps on smoothed targets."""
    pos, neg = label.sum(), len(label) - label.sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    at = np.array([1.0, 0.0])

    def loss(c: np.ndarray) -> float:
        z = x @ c
        return float(np.sum(np.logaddexp(0, z) - target * z) + 0.01 * c @ c)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -35, 35)))
        gradient = x.T @ (p - target) + 0.02 * at
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.02 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while loss(at - size * step) > loss(at) and size > 1e-6:
            size /= 2
        at = at - size * step
        if abs(size * step).max() < 1e-6:
            break
    return float(max(at[0], 0.0)), float(at[1])


def scale(text: np.ndarray, term: np.ndarray, ratio: np.ndarray, n: int) -> np.ndarray:
    """Ratios of the terms, divided by the length of their text's vector so that long texts do not outweigh short ones."""
    value = ratio[term]
    length = np.sqrt(np.bincount(text, value * value, minlength=n))
    return value / np.maximum(length, 1e-9)[text]


def fit(sample: list[tuple[str | None, int]], epochs: int = 12, cost: float = 1.0, smoothing: float = 1.0) -> tuple[Model, np.ndarray]:
    """The model and the log-count ratios from (text, label) rows."""
    size = 1 << BITS
    label = np.array([int(x[1]) for x in sample], np.int64)
    text, term = [], []
    for low, high, words in slices(pa.array([x[0] for x in sample], pa.string())):
        t, h = distinct_terms(*term_ids(words))
        text.append((t + low).astype(np.int32))
        term.append(h.astype(np.int32))
    text, term = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (text, term))
    n, pos = len(label), int(label.sum())
    if pos in (0, n):
        share = pos / n if n else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(np.zeros(size), 0.0, 0.0, float(np.log(share / (1 - share)))), np.zeros(size)
    common = (np.bincount(term, minlength=size) >= MIN_TEXTS)[term]
    text, term = text[common], term[common]
    p = np.bincount(term[label[text] == 1], minlength=size) + smoothing
    q = np.bincount(term[label[text] == 0], minlength=size) + smoothing
    ratio = np.where(p + q > 2 * smoothing, np.log((p / (pos + 2 * smoothing)) / (q / (n - pos + 2 * smoothing))), 0.0)
    value = scale(text, term, ratio, n)
    used = value != 0
    text, term, value = text[used], term[used], value[used]
    cut = np.searchsorted(text, np.arange(n + 1))
    rows = [term[cut[i] : cut[i + 1]] for i in range(n)]
    values = [value[cut[i] : cut[i + 1]] for i in range(n)]
    y = np.where(label == 1, 1.0, -1.0)
    weight = np.where(label == 1, n / (2 * pos), n / (2 * (n - pos)))
    # Margins of rows that the weights have not seen, for the logistic curve.
    fold, margin = np.random.default_rng(3).permutation(n) % 3, np.zeros(n)
    for k in range(3):
        own = np.flatnonzero(fold != k)
        w = dual_coordinate_descent([rows[i] for i in own], [values[i] for i in own], y[own], size, cost * weight[own], epochs)
        for i in np.flatnonzero(fold == k):
            margin[i] = w[rows[i]] @ values[i] + w[size]
    slope, shift = logistic_fit(margin, label)
    w = dual_coordinate_descent(rows, values, y, size, cost * weight, epochs)
    return Model(w[:size], float(w[size]), slope, shift), ratio


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, divisor: int, held_out: int, rows: int = SAMPLE_ROWS) -> list[tuple[str | None, int]]:
    """At most ``rows`` labelled texts outside the held-out remainder, chosen by hash of their key.

    Only the keys of the chosen rows are joined with the texts, so the driver gets a bounded number of rows.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (id_remainder("doc_id", divisor) != held_out))
    chosen = key_sample(known, rows)
    found = texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    return sorted(((r["text"], r["label"]) for r in found.limit(2 * rows).collect()), key=lambda x: (x[1], x[0] or ""))


def score(docs: DataFrame, model: Model, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every text."""
    shared = docs.sparkSession.sparkContext.broadcast((model, ratio.astype(np.float32), model.weights.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, ratios, weights = shared.value
        for b in batches:
            for low, high, words in slices(b.column("text")):
                text, term = term_ids(words)
                used = ratios[term] != 0
                text, term = distinct_terms(text[used], term[used])
                margin = np.bincount(text, scale(text, term, ratios, high - low) * weights[term], minlength=high - low) + fitted.bias
                value = fitted.score(margin)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(low, high - low), pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    return texts(docs).mapInArrow(run, "doc_id bigint, score double, predicted int")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", 5, 0)
    scored = score(docs, *fit(sample))
    return scored.select("doc_id", F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
