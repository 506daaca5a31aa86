"""Quality rules as a short-circuit cascade.

Each rule rejects a text by one measure. On a bounded sample every rule is run alone: its seconds are its
cost, its share of rejected texts its selectivity. Rules are then ordered by rejections per second, and a text
that one rule rejects is not measured for the later ones. The verdict is "no rule rejects", so it does not depend on the
order; sample and order only decide how much work is done.

Results for odd rows: NULL and empty texts have no words and are rejected by ``few_words``; very long texts are measured whole. Repeated rows and rows with a NULL key get a row each. Rules of equal
gain keep their listed order. An empty table gives no rows. ``cascade`` reads no other columns; ``kept_rows`` gives all columns back as they are.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import give_back, importable, key_sample, table, texts
from tickerlake.llm.words import Words, mix, slices, window_hashes

#: Fixed values of the base measures.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: Rows that the costs are estimated on.
SAMPLE_ROWS = 2000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _marked(words: Words, marks: bytes) -> np.ndarray:
    """Bytes of each text that are among ``marks``."""
    hit = np.zeros(256, np.int64)
    hit[list(marks)] = 1
    total = np.concatenate([[0], np.cumsum(hit[words.data])])
    return np.diff(total[words.text_offsets])


def _repeated(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries in text order: whether an equal one stands before it in its text, and whether one stands anywhere else in it."""
    key = hashes ^ mix(text.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later = np.zeros(len(key), bool)
    later[order[1:][same]] = True
    either = later.copy()
    either[order[:-1][same]] = True
    return later, either


def _n_words(words: Words, active: np.ndarray) -> np.ndarray:
    return words.counts


def _word_chars(words: Words, active: np.ndarray) -> np.ndarray:
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    inside = points[words.ends] - points[words.starts]
    return np.diff(np.concatenate([[0], np.cumsum(inside)])[words.offsets])


def _n_symbols(words: Words, active: np.ndarray) -> np.ndarray:
    return _marked(words, SYMBOLS)


def _n_bangs(words: Words, active: np.ndarray) -> np.ndarray:
    return _marked(words, b"!")


def _lines(words: Words) -> Words:
    """The lines with a word, as spans of the same texts."""
    breaks = np.flatnonzero(words.data == 10)
    edges = words.text_offsets
    starts = np.unique(np.concatenate([edges[:-1], breaks + 1]))
    starts = starts[starts < len(words.data)]
    ends = np.minimum(np.append(breaks, len(words.data))[np.searchsorted(breaks, starts)], edges[np.searchsorted(edges, starts, side="right")])
    full = np.searchsorted(words.starts, starts) < np.searchsorted(words.starts, ends)
    starts, ends = starts[full], ends[full]
    return Words(words.data, starts, ends, np.searchsorted(starts, edges), edges)


def _n_lines(words: Words, active: np.ndarray) -> np.ndarray:
    return _lines(words).counts


def _n_dup_lines(words: Words, active: np.ndarray) -> np.ndarray:
    lines = _lines(words)
    text = lines.text_of(np.arange(len(lines.starts)))
    later, _ = _repeated(text, lines.hashes())
    return np.bincount(text[later], minlength=len(active))


def _n_repeat_words(words: Words, active: np.ndarray) -> np.ndarray:
    first = words.windows(WINDOW)
    text = words.text_of(first)
    first, text = first[active[text]], text[active[text]]
    _, either = _repeated(text, window_hashes(words.hashes(), first, WINDOW))
    ends = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(ends, first[either], 1)
    np.add.at(ends, first[either] + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(ends[:-1]) > 0)])
    return np.diff(covered[words.offsets])


#: A measure returns a value for each text; texts that are not active may get any value.
MEASURES: dict[str, Callable[[Words, np.ndarray], np.ndarray]] = {
    "n_words": _n_words,
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_bangs": _n_bangs,
    "n_lines": _n_lines,
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text when ``test`` of its measures holds; ``sql`` says the same over the measures' names."""

    name: str
    measures: tuple[str, ...]
    test: Callable[..., np.ndarray]
    sql: str


RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 10, "n_words < 10"),
    Rule("repeats", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 20 * n, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 100 * s > 50 * n, "100 * n_symbols > 50 * n_words"),
    Rule("shouting", ("n_words", "n_bangs"), lambda n, b: 100 * b > 50 * n, "100 * n_bangs > 50 * n_words"),
    Rule("same_lines", ("n_lines", "n_dup_lines"), lambda n, d: 100 * d > 50 * n, "100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", ("n_words", "word_chars"), lambda n, c: (c > 40 * n) | (c < n * 3 // 2), "word_chars > 40 * n_words OR word_chars < n_words * 3 // 2"),
)
#: The rules whose rejection is the base failure.
BASE_RULES = ("few_words", "repeats")


class _Measured:
    """Measures of a slice, taken when first asked for and only for the texts still active."""

    def __init__(self, words: Words):
        self.words, self.n = words, len(words.text_offsets) - 1
        self.known: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def get(self, name: str, active: np.ndarray) -> np.ndarray:
        values, done = self.known.get(name, (np.zeros(self.n, np.int64), np.zeros(self.n, bool)))
        todo = active & ~done
        if todo.any():
            values = np.where(todo, MEASURES[name](self.words, todo), values)
            self.known[name] = (values, done | todo)
        return values

    def rejects(self, rule: Rule, active: np.ndarray) -> np.ndarray:
        return active & rule.test(*[self.get(m, active) for m in rule.measures])


def _survivors(words: Words, ordered: list[Rule]) -> tuple[np.ndarray, np.ndarray, _Measured]:
    """Which texts pass all rules, the first rule that rejects each other one, and what was measured."""
    measured = _Measured(words)
    active = np.ones(measured.n, bool)
    by = np.full(measured.n, None, object)
    for rule in ordered:
        if not active.any():
            break
        out = measured.rejects(rule, active)
        by[out] = rule.name
        active &= ~out
    return active, by, measured


def rule_profile(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(rule, seconds, rejected, seen) of every rule alone on a sample of about ``sample_rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, words in slices(b.column("text")):
                rows = []
                for rule in rules:
                    began = time.perf_counter()
                    alone = _Measured(words)
                    out = rule.test(*[alone.get(m, np.ones(alone.n, bool)) for m in rule.measures])
                    rows.append((rule.name, time.perf_counter() - began, int(out.sum()), alone.n))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["rule", "seconds", "rejected", "seen"])

    each = key_sample(texts(docs), sample_rows).select("text").mapInArrow(run, "rule string, seconds double, rejected bigint, seen bigint")
    return each.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"), F.sum("seen").alias("seen"))


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules by rejections per second, most first; as listed where the sample is empty. One row per rule comes to the driver."""
    seen = {r["rule"]: r for r in rule_profile(docs, rules, sample_rows).collect()}
    gain = {x.name: seen[x.name]["rejected"] / max(seen[x.name]["seconds"], 1e-9) if x.name in seen else 0.0 for x in rules}
    return sorted(gain, key=lambda name: -gain[name])


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, order: list[str] | None = None, counts: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, kept, rejected_by (the first rejecting rule in the order used), and the measures named in ``counts`` for every row."""
    by_name = {r.name: r for r in rules}
    ordered = [by_name[name] for name in (order or cascade_order(docs, rules))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high, words in slices(b.column("text")):
                active, by, measured = _survivors(words, ordered)
                more = [pa.array(measured.get(c, np.ones(measured.n, bool))) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(low, high - low), pa.array(active), pa.array(by, pa.string()), *more],
                    ["doc_id", "kept", "rejected_by", *counts],
                )

    schema = ", ".join(["doc_id bigint", "kept boolean", "rejected_by string", *[f"{c} bigint" for c in counts]])
    return texts(docs).mapInArrow(run, schema)


def kept_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES, order: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns, whatever these are called."""
    importable(docs.sparkSession)
    by_name = {r.name: r for r in rules}
    ordered = [by_name[name] for name in (order or cascade_order(docs, rules))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high, words in slices(b.column(b.schema.names.index("text"))):
                yield b.slice(low, high - low).filter(pa.array(_survivors(words, ordered)[0]))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = cascade(table(spark, sf_dir, "documents"), counts=COUNTS)
    return measured.select(
        "doc_id", *COUNTS, F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words").alias("base_failed"), "kept"
    )


OP9_SQL = rf"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n
  FROM (SELECT doc_id, i, w[i:i + {WINDOW - 1}] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words))
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS j FROM windows WHERE n > 1) GROUP BY doc_id
), measured AS (
  SELECT words.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_bangs,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT {", ".join(("doc_id", *COUNTS))}, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT ({" OR ".join(f"({r.sql})" for r in RULES)}) AS kept
FROM measured
"""
