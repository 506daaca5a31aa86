"""Documents that can be linked at all: those of whose shingles enough stand in other documents, too.

If den * |x & y| >= num * |x | y|, then den * (shingles of x that another set has) >= num * |x|. Most documents of a corpus are far from that, and without them
all later steps of a similarity join have less to do; no link is lost.

Some texts at a time, a chunk, are cut into shingles. What is found twice in a chunk is known to be shared there, and leaves it once. Every bucket of the shingles' hashes gets a row from each chunk
and answers with the owners of those that another chunk has as well; the chunk's answers are added up. A shingle is compared by the bits that choose its bucket and 32 more, and ids by their rows, so
chance agreement and repeated ids may keep a document too many, never one too few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tickerlake.llm.common import give_back
from tickerlake.llm.words import U64, slices

#: Documents of a chunk at most, and shingles with which it ends.
DOCS, CHUNK = 60_000, 1 << 18
#: Shingles of a bucket, about.
BUCKET = 1 << 21
#: The owner of a shingle that its chunk knows to be shared.
KNOWN = 0xFFFF


def _chunks(batches: Iterator[pa.RecordBatch], like, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """doc_ids, shingles (document by document) and set sizes of each chunk."""
    held, docs, shingles = [], 0, 0
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for low, high, words in slices(batch.column("text")):
            x, edge = like.sets(words)
            for i in range(0, high - low, DOCS):
                j = min(i + DOCS, high - low)
                if shingles >= most or docs + j - i > DOCS:
                    yield tuple(np.concatenate(c) for c in zip(*held))
                    held, docs, shingles = [], 0, 0
                held.append((ids[low + i : low + j], x[edge[i] : edge[j]], np.diff(edge[i : j + 1])))
                docs, shingles = docs + j - i, shingles + int(edge[j] - edge[i])
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _binary(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """The values between two edges as bytes, for each two."""
    offsets = np.ascontiguousarray(edge * values.itemsize, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def mostly_shared(docs: DataFrame, like, total: int, chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """doc_id of the rows (doc_id, text) with a set that may be linked with that of another row; ``total`` is the number of all shingles."""
    # Some more buckets than tasks, so that tasks get equal shares.
    buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // bucket)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (ids, x, size) in enumerate(_chunks(batches, like, chunk)):
            order = np.argsort(x)
            x, owner = x[order], np.repeat(np.arange(len(ids)), size)[order]
            edges = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
            once = np.diff(np.append(edges, len(x))) == 1
            alone = np.zeros(len(x), bool)
            alone[edges[once]] = True
            here = np.bincount(owner[~alone], minlength=len(ids))
            x, owner = x[edges], np.where(once, owner[edges], KNOWN).astype(np.uint16)
            edge = np.searchsorted((x >> U64(32)) * U64(buckets) >> U64(32), np.arange(buckets + 1, dtype=np.uint64))
            about = [b""] * buckets
            about[number % buckets] = np.array([ids, size, here], np.int64).tobytes()
            columns = [pa.array(np.arange(buckets)), pa.array(np.full(buckets, (task << 32) + number)), _binary(x.astype(np.uint32), edge), _binary(owner, edge), pa.array(about, pa.binary())]
            rows = pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "shingles", "owners", "about"])
            yield rows.filter(pa.array((np.diff(edge) > 0) | (np.arange(buckets) == number % buckets)))
        give_back()

    def answer(rows: pa.Table) -> pa.Table:
        x, owner = _joined(rows["shingles"], np.uint32), _joined(rows["owners"], np.uint16)
        place = np.sort((x.astype(U64) << U64(32)) | np.arange(len(x), dtype=np.uint64))
        same = np.flatnonzero(place[1:] >> U64(32) == place[:-1] >> U64(32))
        found = np.zeros(len(x), bool)
        for at in (same, same + 1):
            found[(place[at] & U64(0xFFFFFFFF)).astype(np.int64)] = True
        found &= owner != KNOWN
        edge = np.concatenate([[0], np.cumsum(pc.binary_length(rows["owners"]).to_numpy() // 2)])
        owners = _binary(owner[found], np.concatenate([[0], np.cumsum(found)])[edge])
        out = pa.table({"chunk": rows["chunk"], "owners": owners, "about": rows["about"]})
        return out.filter(pc.or_(pc.greater(pc.binary_length(out["owners"]), 0), pc.greater(pc.binary_length(out["about"]), 0)))

    def enough(rows: pa.Table) -> pa.Table:
        ids, size, here = _joined(rows["about"], np.int64).reshape(3, -1)
        shared = here + np.bincount(_joined(rows["owners"], np.uint16), minlength=len(ids))
        return pa.table({"doc_id": ids[(size > 0) & (like.den * shared >= like.num * size)]})

    dealt = docs.mapInArrow(deal, "bucket bigint, chunk bigint, shingles binary, owners binary, about binary")
    answers = dealt.groupBy("bucket").applyInArrow(answer, "chunk bigint, owners binary, about binary")
    return answers.groupBy("chunk").applyInArrow(enough, "doc_id bigint")
