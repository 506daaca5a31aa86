"""Substring deduplication by level-wise doubling.

A window of ``length`` words can only repeat if the windows of half that length inside it repeat. So the first level looks at windows of
``(length + 1) // 2`` words, and of those only at each ``length``-word window's smallest by hash, the same in every copy (about a quarter
of all positions). The windows repeated at that length alone are extended to twice that length (13 = 2 * 7 - 1 words with the defaults) and compared by
a 128-bit hash; what does not repeat at a level is given up there. A window is removed if its words also start in a document with a smaller doc_id.

Hot windows: a task compares its own documents first. It passes on a window once, for its smallest document; the larger ones are already
decided. So a passage in a third of all documents costs one row for each batch. Equal texts are found by their digest;
all but the smallest are covered whole and take no part in the levels.

Results for odd rows: NULL and empty texts have no words. Very long texts count whole. Repeated rows each get a row; ties do not arise. A NULL doc_id counts as larger than all others;
rows without one remove nothing from each other. Of several texts under one doc_id the first by its digest is the document's; the others are treated like rows without an id, but keep
theirs in the result. An empty table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerlake.llm.common import NO_ID, identified, table, texts
from tickerlake.llm.words import U64, Words, mix, slices, window_hashes
from tickerlake.session import materialise

LENGTH = 13
#: What is known of a row: decided in its batch, to be compared with other batches', or only there to tell them.
DECIDED, OPEN, TOLD = 0, 1, 2


def _anchors(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, the place of each window's smallest half-length window, and all half-length hashes."""
    half = (length + 1) // 2
    first = words.windows(length)
    if not len(first):
        return first, first, np.zeros(0, np.uint64)
    small = window_hashes(hashes, np.arange(len(hashes) - half + 1), half)
    best = first.copy()
    for step in range(1, length - half + 1):
        best = np.where(small[first + step] < small[best], first + step, best)
    return first, best, small


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """(k, a, doc_id, kind) of the half-length windows chosen in each document; k brings together what has to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            found, owner = [], []
            for low, high, words in slices(batch.column("text")):
                _, best, small = _anchors(words, words.hashes(), length)
                place = np.flatnonzero(np.bincount(best, minlength=1)) if len(best) else best
                found.append(small[place])
                owner.append(low + words.text_of(place))
            if not found:
                continue
            # Of equal texts in the batch only the smallest takes part: equal byte for byte, as copied_texts, which covers the others, compares them.
            one, other = np.frombuffer(b"".join(hashlib.md5(t.as_buffer()).digest() for t in batch.column("text")), U64).reshape(-1, 2).T
            order = np.lexsort((ids, other, one))
            taken = np.ones(len(ids), bool)
            taken[order[1:]] = (one[order][1:] != one[order][:-1]) | (other[order][1:] != other[order][:-1])
            a, row = np.concatenate(found), np.concatenate(owner)
            a, row = a[taken[row]], row[taken[row]]
            doc = ids[row]
            order = np.lexsort((doc, a))
            a, doc = a[order], doc[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])
            a, doc = a[new], doc[new]
            start = np.ones(len(a), bool)
            start[1:] = a[1:] != a[:-1]
            shared = np.bincount(np.cumsum(start) - 1, minlength=0)[np.cumsum(start) - 1] > 1 if len(a) else start
            tell = start & shared
            k = np.concatenate([np.where(shared, mix(a ^ mix(doc.astype(np.uint64))), a), a[tell]])
            kind = np.concatenate([np.where(shared, DECIDED, OPEN), np.full(tell.sum(), TOLD)]).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [_signed(k), _signed(np.concatenate([a, a[tell]])), pa.array(np.concatenate([doc, doc[tell]])), pa.array(kind)], ["k", "a", "doc_id", "kind"]
            )

    return docs.mapInArrow(run, "k bigint, a bigint, doc_id bigint, kind tinyint")


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, z): texts compressed, as they are shuffled twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [press.compress((t.as_py() or "").encode()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(z, pa.binary())], ["doc_id", "z"])

    return docs.mapInArrow(run, "doc_id bigint, z binary")


def _unpacked(column: pa.Array, size: int = 1 << 22) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words) of compressed texts, some MB at a time."""
    open_z = zstandard.ZstdDecompressor()
    low, held, total = 0, [], 0
    for i in range(len(column) + 1):
        if held and (i == len(column) or total >= size):
            at = low
            for a, b, words in slices(pa.array(held, pa.large_binary()).cast(pa.large_string())):
                yield at + a, at + b, words
            low, held, total = i, [], 0
        if i < len(column):
            held.append(open_z.decompress(column[i].as_py()))
            total += len(held[-1])


def window_rows(candidates: DataFrame, length: int, nameless: int) -> DataFrame:
    """(k1, k2, doc_id, pos, more, late) from (doc_id, z, anchors): windows whose anchor repeats.

    A late row holds the places of a document's windows that a smaller document of the batch has, as int32 in ``more``. The other rows have a window's key
    to compare and its first place in the document, with further places in ``more``: a window that one text repeats is one row.
    """

    names = ["k1", "k2", "doc_id", "pos", "more", "late"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            lists = batch.column("anchors")
            keys1, keys2, docs, places = [], [], [], []
            for low, high, words in _unpacked(batch.column("z")):
                h = words.hashes()
                first, best, small = _anchors(words, h, length)
                if not len(first):
                    continue
                text = words.text_of(first)
                own = lists.slice(low, high - low)
                wanted = own.flatten().to_numpy().view(np.uint64)
                of = np.repeat(np.arange(high - low), own.value_lengths().to_numpy())
                wanted = np.sort(wanted ^ mix(of.astype(np.uint64) + U64(1)))
                probe = small[best] ^ mix(text.astype(np.uint64) + U64(1))
                at = np.minimum(np.searchsorted(wanted, probe), len(wanted) - 1)
                hit = wanted[at] == probe
                f = first[hit]
                keys1.append(window_hashes(h, f, length))
                keys2.append(window_hashes(words.hashes(base=1), f, length, base=1))
                docs.append(ids[low:high][text[hit]])
                places.append((f - words.offsets[text[hit]]).astype(np.int32))
            if not keys1:
                continue
            k1, k2, doc, pos = (np.concatenate(x) for x in (keys1, keys2, docs, places))
            order = np.lexsort((doc, k2, k1))
            k1, k2, doc, pos = k1[order], k2[order], doc[order], pos[order]
            start = np.ones(len(k1), bool)
            start[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            least = doc[start][np.cumsum(start) - 1] if len(doc) else doc
            late = (doc > least) & (least < nameless)
            open_ = ~late
            # Open rows of one window are of its smallest document, or of all documents without an id.
            start[1:] |= open_[1:] & (doc[1:] != doc[:-1])
            own, first_place = pos[open_], start[open_]
            edge = np.append(np.flatnonzero(first_place), len(own))
            more = np.full(len(edge) - 1, None, object)
            for i in np.flatnonzero(np.diff(edge) > 1):
                more[i] = own[edge[i] + 1 : edge[i + 1]].tobytes()
            yield pa.RecordBatch.from_arrays(
                [_signed(k1[start]), _signed(k2[start]), pa.array(doc[start]), pa.array(own[first_place]), pa.array(more, pa.binary()), pa.array(np.zeros(len(more), bool))],
                names,
            )
            if late.any():
                order = np.argsort(doc[late], kind="stable")
                d, p = doc[late][order], pos[late][order]
                edge = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1], [True]]))
                n = len(edge) - 1
                runs = [p[a:b].tobytes() for a, b in zip(edge, edge[1:])]
                own = d[edge[:-1]]
                key = mix(own.astype(np.uint64) + U64(0xD0C))
                yield pa.RecordBatch.from_arrays(
                    [_signed(key), _signed(mix(key)), pa.array(own), pa.array(np.zeros(n, np.int32)), pa.array(runs, pa.binary()), pa.array(np.ones(n, bool))], names
                )

    return candidates.select("doc_id", "z", "anchors").mapInArrow(run, "k1 bigint, k2 bigint, doc_id bigint, pos int, more binary, late boolean")


def repeated_windows(docs: DataFrame, copies: DataFrame, length: int = LENGTH, nameless: int = NO_ID) -> DataFrame:
    """(doc_id, places, more): first words of the windows that also start in a smaller document, singly and as packed int32."""
    level = anchor_rows(docs, length).withColumn("n", F.count("*").over(Window.partitionBy("k")))
    level = level.where((F.col("kind") == DECIDED) | ((F.col("kind") == OPEN) & (F.col("n") > 1))).select("doc_id", "a")
    level = level.join(copies, "doc_id", "left_anti").groupBy("doc_id").agg(F.collect_list("a").alias("anchors"))
    candidates = packed(docs).join(materialise(level, "half-windows"), "doc_id")
    rows = window_rows(candidates, length, nameless).withColumn("least", F.min("doc_id").over(Window.partitionBy("k1", "k2")))
    rows = rows.where(F.col("late") | ((F.col("doc_id") > F.col("least")) & (F.col("least") < nameless)))
    rows = rows.groupBy("doc_id").agg(F.collect_list(F.when(~F.col("late"), F.col("pos"))).alias("places"), F.collect_list("more").alias("more"))
    return materialise(rows, "windows")


def copied_texts(docs: DataFrame, nameless: int = NO_ID) -> DataFrame:
    """doc_id of the documents whose whole text stands in a document with a smaller one."""
    prints = materialise(docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("print")), "prints")
    first = prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where((F.col("first") < F.col("last")) & (F.col("first") < nameless)).select("print", "first")
    return materialise(prints.join(materialise(first, "first-copies"), "print").where("doc_id > first").select("doc_id").distinct(), "copies")


def _kept_bytes(words: Words, kept: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by single spaces."""
    which = np.flatnonzero(kept)
    size = (words.ends - words.starts)[which] + 1
    edge = np.concatenate([[0], np.cumsum(size)])
    out = np.full(edge[-1], 32, np.uint8)
    source = np.arange(edge[-1]) + np.repeat(words.starts[which] - edge[:-1], size)
    inside = np.ones(edge[-1], bool)
    inside[edge[1:] - 1] = False
    out[inside] = words.data[source[inside]]
    raw, cut = out.tobytes(), edge[np.searchsorted(which, words.offsets)].tolist()
    return [raw[a : b - 1] if b > a else b"" for a, b in zip(cut, cut[1:])]


def _deduplicated(rows: DataFrame, length: int, with_text: bool, with_print: bool) -> DataFrame:
    """The result for rows (doc_id, text) with one text for each doc_id, and the text's digest ``print`` if asked for."""
    given, nameless = identified(rows)
    copies = copied_texts(given, nameless)
    found = repeated_windows(given, copies, length, nameless)
    marks = found.join(copies.withColumn("copy", F.lit(True)), "doc_id", "full")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, more, copy = (batch.column(c) for c in ("places", "more", "copy"))
            for low, high, words in _unpacked(batch.column("z")):
                cover = np.zeros(len(words.starts) + 1, np.int64)
                n = words.counts
                for i in range(low, high):
                    at = words.offsets[i - low]
                    if copy[i].as_py():
                        if n[i - low] >= length:
                            cover[at] += 1
                            cover[at + n[i - low]] -= 1
                        continue
                    if not places[i].is_valid:
                        continue
                    own = np.unique(np.concatenate([places[i].values.to_numpy(), *[np.frombuffer(x.as_buffer(), np.int32) for x in more[i].values]]))
                    np.add.at(cover, at + own, 1)
                    np.add.at(cover, at + own + length, -1)
                kept = np.cumsum(cover[:-1]) == 0
                gone = np.diff(np.concatenate([[0], np.cumsum(~kept)])[words.offsets])
                raw = _kept_bytes(words, kept)
                columns = [batch.column("doc_id").slice(low, high - low), pa.array(n), pa.array(gone), pa.array([hashlib.sha256(x).hexdigest() for x in raw])]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_print:
                    data, edge = words.data.tobytes(), words.text_offsets.tolist()
                    columns.append(pa.array([hashlib.md5(data[a:b]).hexdigest() for a, b in zip(edge, edge[1:])]))
                    names.append("print")
                if with_text:
                    columns.append(pa.array([x.decode() for x in raw], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", print string" * with_print + ", kept_text string" * with_text
    out = packed(given).join(marks, "doc_id", "left").select("doc_id", "z", "places", "more", "copy").mapInArrow(run, schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") < nameless, F.col("doc_id")))


def deduplicated(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text of every row."""
    rows = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    prints = rows.where(F.col("doc_id").isNotNull()).select("doc_id", F.md5(F.col("text").cast("binary")).alias("print"))
    several = prints.groupBy("doc_id").agg(F.min("print").alias("own"), F.max("print").alias("last")).where("own < last").select("doc_id", "own")
    several = materialise(several, "several-texts")
    if not several.limit(1).count():
        return _deduplicated(rows, length, with_text, False)
    marked = rows.withColumn("print", F.md5(F.col("text").cast("binary"))).join(several, "doc_id", "left")
    marked = materialise(marked.withColumn("other", F.coalesce(F.col("print") != F.col("own"), F.lit(False))), "marked-texts")
    found = materialise(_deduplicated(marked.select(F.when(~F.col("other"), F.col("doc_id")).alias("doc_id"), "text"), length, with_text, True), "deduplicated")
    # Rows without an id and the other texts get the result of their text under the id they came with.
    of_text = found.where(F.col("doc_id").isNull()).dropDuplicates(["print"]).drop("doc_id")
    back = marked.where(F.col("doc_id").isNull() | F.col("other")).select("doc_id", "print").join(of_text, "print")
    return found.where(F.col("doc_id").isNotNull()).unionByName(back).drop("print")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"), with_text=False)


OP2_SQL = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {LENGTH - 1}], ' ')) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - {LENGTH - 2})) AS i FROM words)
), judged AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first FROM windows
), covered AS (
  SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + {LENGTH})) AS j FROM judged WHERE first < doc_id) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE (
    SELECT coalesce(list(x ORDER BY j), []) FROM (SELECT unnest(w) AS x, generate_subscripts(w, 1) AS j) WHERE NOT list_contains(gone, j)
  ) END, ' ')) AS kept_sha256
FROM words LEFT JOIN covered USING (doc_id)
"""
