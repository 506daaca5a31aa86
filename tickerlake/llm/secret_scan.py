r"""Secret scans: fixed patterns, and the guess cost of values in credential contexts.

Base spans, leftmost and non-overlapping per kind: ``assign``, ``access`` and ``hex`` (see the patterns). The method adds ``guess``
spans: a value that stands after a name with a credential word in it (``DB_PASSWORD=``, ``secretKey: ``, ``password is``), in the password place of a URL, or after ``Bearer`` / ``Basic`` is
cut into segments of least total guess cost by dynamic programming. A segment is a common word, a date, a repeat, a keyboard
walk, a sequence, or brute force per character class. The value is a secret when the cheapest way to guess it needs at
least ``10 ** MIN_COST`` tries, so that ``password: hunter`` stays and ``password is gT4#kq91z`` goes. Common words are a short fixed list and the
most frequent words of the corpus, ``WORDS`` at most, counted over all documents; a word costs its rank. After "is", a value of letters only is prose.

Spans are (kind, start, end, cost) in code points, end exclusive, by start, then kind, then end. NULL and empty texts have no spans; very long texts and values are
scanned whole, and no pattern goes back over a text. Repeated rows each get a row, rows without doc_id too. Words of equal count are ranked by spelling. An empty table
gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import give_back, importable, table, texts
from tickerlake.session import materialise

KINDS = ("assign", "access", "hex", "guess")
#: Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
#: What may be a name, and what stands between it and its value.
NAMED = re.compile(r"""(?<![\w-])([\w-]++)["']?(\x20+is\x20+|\x20*(?:[:=]|=>)\x20*)["']?(?:(?:Bearer|Basic)\x20+)?["']?""", re.I | re.A)
SCHEME = re.compile(r"""(?<![\w-])(?:Bearer|Basic)\x20+["']?|://[^\s:/@]++:(?=[!-~]{6,}@)""", re.I | re.A)
VALUE = re.compile(r"[!-~]{6,}")
URL_VALUE = re.compile(r"([!-~]{6,})@")
#: A name is a credential's if it holds one of the long words, or one of the short ones as a part of its own.
LONG_NAMES = re.compile(r"password|passwd|passphrase|passcode|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key", re.I)
SHORT_NAMES = frozenset(["pass", "pwd", "auth"])
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Every match of ASSIGN or a context holds one of these in lower case, so texts without any need no trial.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "credential", "key", "auth", "bearer", "basic", "://")
MIN_COST = 10.0

#: Words that guessers try first.
COMMON_WORDS = (
    "password passwd pass secret token key admin administrator root user guest login welcome letmein monkey dragon master hello love iloveyou "
    "sunshine princess football baseball shadow superman batman trustno access hunter ranger harley jordan michael jennifer thomas robert daniel "
    "george charlie andrew joshua matthew michelle computer internet server system test testing example sample demo default change changeme "
    "please enter your here none null true false value string placeholder redacted hidden required optional invalid correct horse battery staple "
    "summer winter spring autumn monday friday the and for with that this from have not you are was but all any can"
).split()
RANK = {w: i + 1 for i, w in enumerate(COMMON_WORDS)}
#: Words of the corpus that are taken as common: at most so many, from so many occurrences on.
WORDS, OCCURRENCES = 20_000, 5
LEET = str.maketrans("013457@$!", "oieastasi")
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "qwertzuiop", "azertyuiop", "1qaz2wsx3edc4rfv5tgb6yhn7ujm")
_NEXT = frozenset(x for r in ROWS for x in (*zip(r, r[1:]), *zip(r[1:], r)))
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:(?:19|20)\d\d|\d\d)")
#: Longest segment of a kind other than brute force and repeats; values may be of any length.
LONGEST = 24


def _class_size(value: str) -> int:
    """Characters a guesser has to choose from, by the classes the value uses."""
    size = 0
    if any("a" <= c <= "z" for c in value):
        size += 6 if all(c in "0123456789abcdef" for c in value if not "A" <= c <= "Z") else 26
    if any("A" <= c <= "Z" for c in value):
        size += 26
    if any("0" <= c <= "9" for c in value):
        size += 10
    return size + (33 if any(not c.isalnum() for c in value) else 0)


def _segments(value: str, lower: str, plain: str, end: int, ranks: dict[str, int]) -> Iterator[tuple[int, float, str]]:
    """(start, log10 of its guesses, kind) of the segments that end before ``end``."""
    for start in range(max(0, end - LONGEST), end - 1):
        piece = plain[start:end]
        rank = ranks.get(piece) or ranks.get(lower[start:end])
        reverse = ranks.get(piece[::-1]) if rank is None else None
        if rank or reverse:
            cost = math.log10(rank or 2 * reverse)
            own = value[start:end]
            if own != own.lower():
                cost += math.log10(2) if own[1:] == own[1:].lower() or own == own.upper() else 1.0
            if piece != lower[start:end]:
                cost += math.log10(2)
            yield start, cost, "word"
        if end - start >= 4 and _DATE.fullmatch(lower, start, end):
            yield start, math.log10(365 * 60) if end - start > 4 else math.log10(120), "date"
    start = end - 1
    while start > 0 and (lower[start - 1], lower[start]) in _NEXT and end - start < LONGEST:
        start -= 1
        if end - start >= 3:
            yield start, math.log10(47 * 4) + 0.5 * math.log10(end - start), "walk"
    start = end - 1
    step = ord(lower[end - 1]) - ord(lower[end - 2]) if end > 1 else 0
    while start > 0 and step in (1, -1) and ord(lower[start]) - ord(lower[start - 1]) == step and end - start < LONGEST:
        start -= 1
        if end - start >= 3:
            yield start, math.log10(26 * 2) + 0.5 * math.log10(end - start), "sequence"


def guess_cost(value: str, ranks: dict[str, int] | None = None) -> float:
    """log10 of the tries that the cheapest segmentation needs. Cost grows with the value's length times a constant.

    Each place keeps two costs, for cuts that end in brute force and for others: brute force goes on without the cost of a new segment.
    """
    ranks = RANK if ranks is None else ranks
    lower = value.lower()
    if len(lower) != len(value):
        lower = value
    plain = lower.translate(LEET)
    per_char = math.log10(max(10, _class_size(value)))
    switch = math.log10(2)
    brute, other = [math.inf] * (len(value) + 1), [math.inf] * (len(value) + 1)
    other[0] = 0.0
    unit_from = {}
    for end in range(1, len(value) + 1):
        brute[end] = per_char + min(brute[end - 1], other[end - 1] + switch)
        for start, cost, _ in _segments(value, lower, plain, end, ranks):
            other[end] = min(other[end], min(brute[start], other[start]) + cost + switch)
        # A repeat of one to eight characters costs its unit and the number of times, however long it is.
        for unit in range(1, min(8, end // 2) + 1):
            if value[end - unit : end] == value[end - 2 * unit : end - unit]:
                first = unit_from.get((unit, end - unit), end - 2 * unit)
                unit_from[unit, end] = first
                other[end] = min(other[end], min(brute[first + unit], other[first + unit]) + math.log10((end - first) // unit) + switch)
    return min(brute[-1], other[-1])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found, lower = [], text.lower()
    if any(h in lower for h in ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def is_credential(name: str) -> bool:
    """Whether a name stands for a credential."""
    return bool(LONG_NAMES.search(name)) or any(p.lower() in SHORT_NAMES for p in _PARTS.findall(name))


def _values(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the values in credential contexts. The search goes on behind a credential's value, and at the value of any other name, which may be a name too."""
    at = 0
    while m := NAMED.search(text, at):
        at = m.end()
        if is_credential(m[1]) and (value := VALUE.match(text, at)):
            prose = m[2].strip().lower() == "is"
            if not (prose and value[0].rstrip("\"',;.!?)]}>").isalpha()):
                yield value.span()
            at = value.end()
    at = 0
    while m := SCHEME.search(text, at):
        at = m.end()
        url = m[0].startswith("://")
        if value := (URL_VALUE if url else VALUE).match(text, at):
            yield value.start(), value.end() - url
            at = value.end()


def guessed_spans(text: str, least: float = MIN_COST, ranks: dict[str, int] | None = None) -> list[tuple[str, int, int, float]]:
    """Values in credential contexts that need at least ``10 ** least`` guesses."""
    found, lower = [], text.lower()
    if not any(h in lower for h in CONTEXT_HINTS):
        return found
    last = 0
    for start, end in sorted(set(_values(text))):
        end = start + len(text[start:end].rstrip("\"',;.)]}>"))
        # inside the value of an earlier name
        if end - start >= 6 and start >= last:
            cost = guess_cost(text[start:end], ranks)
            if cost >= least:
                found.append(("guess", start, end, cost))
                last = end
    return found


def secret_spans(text: str | None, least: float = MIN_COST, ranks: dict[str, int] | None = None) -> list[tuple[str, int, int, float | None]]:
    """All spans by start, then kind as listed."""
    text = text or ""
    found = [(*s, None) for s in base_spans(text)] + guessed_spans(text, least, ranks)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, spans: list[tuple]) -> str:
    """The text with every union of overlapping spans replaced by ``[SECRET]``."""
    out, at, last = [], 0, -1
    for _, start, end, *_ in spans:
        if start >= last:
            out += [text[at:start], "[SECRET]"]
        last = max(last, end)
        at = last
    return "".join([*out, text[at:]]) if spans else text


#: Rows whose texts are Python strings at a time.
ROWS_AT_ONCE = 500
SPANS = "array<struct<kind:string,start:bigint,end:bigint,cost:double>>"


def common_words(docs: DataFrame, most: int = WORDS, least: int = OCCURRENCES) -> dict[str, int]:
    """Ranks of the fixed words and of the most frequent words of letters in all documents, 3 to ``LONGEST`` letters long.

    Occurrences are counted per task before the shuffle; ``most`` words at most come to the driver.
    """
    words = F.explode(F.regexp_extract_all(F.lower(F.col("text")), F.lit(rf"(?<![a-z])[a-z]{{3,{LONGEST}}}(?![a-z])"), F.lit(0)))
    counts = texts(docs).select(words.alias("word")).groupBy("word").count().where(F.col("count") >= least)
    counts = materialise(counts.withColumn("class", F.floor(8 * F.log2("count")).cast("int")), "word-counts")
    # Words by class of frequency, eight classes to a doubling: a few hundred rows. The most frequent classes that hold no more than ``most`` words are taken.
    taken, bound = 0, None
    for row in sorted(counts.groupBy("class").agg(F.count("*").alias("words")).collect(), reverse=True):
        taken += row["words"]
        if taken > most:
            break
        bound = row["class"]
    top = [] if bound is None else counts.where(F.col("class") >= bound).select("word", "count").collect()
    top = sorted(top, key=lambda r: (-r["count"], r["word"]))
    ranks = dict(RANK)
    for row in top:
        ranks.setdefault(row["word"], len(ranks) + 1)
    return ranks


def scan(docs: DataFrame, least: float = MIN_COST, ranks: dict[str, int] | None = None) -> DataFrame:
    """doc_id, spans of every row; ``ranks`` are those of the corpus if not given."""
    ranks = common_words(docs) if ranks is None else ranks
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[dict(zip(("kind", "start", "end", "cost"), s)) for s in secret_spans(t.as_py(), least, ranks)] for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])
        give_back()

    return texts(docs).mapInArrow(run, f"doc_id bigint, spans {SPANS}")


def redacted(docs: DataFrame, least: float = MIN_COST, ranks: dict[str, int] | None = None) -> DataFrame:
    """The rows of ``docs`` with secrets in ``text`` replaced and ``n_chars`` counted anew; other columns and rows as they are."""
    importable(docs.sparkSession)
    ranks = common_words(docs.select(F.lit(0).alias("doc_id"), "text")) if ranks is None else ranks
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(low, ROWS_AT_ONCE)
                at = b.schema.names.index("text")
                text = [None if (x := t.as_py()) is None else redact(x, secret_spans(x, least, ranks)) for t in b.column(at)]
                columns = list(b.columns)
                columns[at] = pa.array(text, b.schema.field(at).type)
                if "n_chars" in b.schema.names:
                    n = b.schema.names.index("n_chars")
                    old = b.column("text").to_pylist()
                    counts = [len(new) if new is not None and new != was else c for new, was, c in zip(text, old, b.column(n).to_pylist())]
                    columns[n] = pa.array(counts, b.schema.field(n).type)
                yield pa.RecordBatch.from_arrays(columns, schema=b.schema)
        give_back()

    return docs.mapInArrow(run, schema)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    written = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    base_written = F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.concat_ws(",", base_written), 256).alias("base_sha256"),
        F.concat_ws(",", written).alias("spans"),
    )
