"""Near-duplicate documents by min-max hashing.

A permutation of the shingle domain gives a set two values, the smallest and the largest permuted shingle. Each of them is equal in two sets with the
probability of their Jaccard similarity, so half as many permutations as values are evaluated, and since the two ends move apart the estimate from them varies
less than that from as many minima. Minima and maxima are banded: ``BANDS`` bands of ``ROWS`` values, each a key; sets with a key in common are candidates. At the
similarity asked for (0.85) two sets have no key in common with a probability of (1 - 0.85 ** 4) ** 20 = 4e-7, and less above it.

Equal sets are one node. The sets of a small bucket (of one key) are compared with each other, those of a larger one with its smallest document, the pivot. A pivot's members that
are not linked with it may be linked with each other; that follows from the shingles in which they differ from the pivot, which one task compares without writing out pairs
(``ngram_join.group_links``). So every two sets with a key in common are confirmed on their full sets or already connected, and no bucket gives rise to all its pairs.

Results for odd rows: NULL, empty and wordless texts have n_shingles 0, their own id as component_id and kept true. Texts with fewer words than a shingle are one
shingle, however long a text is all of it counts. Repeated rows come back as often as they are given. Rows of one doc_id are one document: they share a
component, whatever their texts. Rows without doc_id are the same document only if their texts are; they come after all others, their doc_id is NULL, so is
component_id if no document with an id is in the component, and the first of them is kept. Ties do not arise: ids order everything. Other columns than doc_id and text
are not read, so their names cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import identified, table, texts
from tickerlake.llm.components import components
from tickerlake.llm.ngram_join import Similarity, group_links, group_members
from tickerlake.llm.words import U64, mix, slices
from tickerlake.session import materialise

#: Permutations; each gives a minimum and a maximum.
PERMUTATIONS = 40
#: Values of a band.
ROWS = 4
BANDS = 2 * PERMUTATIONS // ROWS
_SET = "doc_id bigint, n bigint, a bigint, b bigint, bands array<bigint>"
_ODD = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | U64(1)
_SHIFT = mix(np.arange(1001, PERMUTATIONS + 1001, dtype=np.uint64))


def min_max(x: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """A row for each of the sets x[edge[i]:edge[i + 1]]: minima under all permutations, then maxima; 0 for an empty set."""
    full = np.flatnonzero(np.diff(edge))
    out = np.zeros((len(edge) - 1, 2 * PERMUTATIONS), np.uint64)
    if len(full):
        for p in range(PERMUTATIONS):
            moved = x * _ODD[p] + _SHIFT[p]
            out[full, p] = np.minimum.reduceat(moved, edge[full])
            out[full, PERMUTATIONS + p] = np.maximum.reduceat(moved, edge[full])
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """The key of each band of every row of ``values``."""
    bands = mix(values).reshape(len(values), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2])
    for row in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + bands[:, :, row])
    return key


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def signed_sets(docs: DataFrame, like: Similarity) -> DataFrame:
    """doc_id, set size n and 128-bit digest (a, b) of every row; of the smallest document of each set in a slice of a batch also the band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for low, high, words in slices(batch.column("text")):
                x, edge = like.sets(words)
                digests = []
                for salt in (11, 12):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(x ^ mix(U64(salt) + np.zeros(1, np.uint64))))])
                    digests.append(mix(total[edge[1:]] - total[edge[:-1]]))
                own = ids[low:high]
                order = np.lexsort((own, digests[1], digests[0]))
                new = np.ones(len(own), bool)
                new[1:] = (digests[0][order][1:] != digests[0][order][:-1]) | (digests[1][order][1:] != digests[1][order][:-1])
                first = np.zeros(len(own), bool)
                first[order] = new
                first &= np.diff(edge) > 0
                size = np.diff(edge)
                chosen = np.concatenate([np.zeros(1, np.int64), np.cumsum(size[first])])
                keys = band_keys(min_max(x[np.repeat(first, size)], chosen))
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(first, BANDS, 0))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low), pa.array(size), _signed(digests[0]), _signed(digests[1]),
                        pa.ListArray.from_arrays(offsets, _signed(keys.ravel())),
                    ],
                    ["doc_id", "n", "a", "b", "bands"],
                )

    return docs.mapInArrow(run, _SET)


def bucket_members(sets: DataFrame) -> DataFrame:
    """(key, p, size, doc_id) of the buckets with several nodes; p is the smallest. Extremes and counts are combined before the shuffle, the members joined back, so Spark splits a hot bucket."""
    rows = sets.select(F.col("node").alias("doc_id"), F.explode("bands").alias("key"))
    return group_members(rows)


def near_copies(docs: DataFrame, shingle: int = 5, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text)."""
    like = Similarity(shingle, num, den)
    given, nameless = identified(texts(docs))
    rows = materialise(signed_sets(given, like), "minmax-sets")
    nodes = materialise(rows.where("n > 0").groupBy("n", "a", "b").agg(F.min("doc_id").alias("node")), "minmax-nodes")
    placed = materialise(rows.join(nodes, ["n", "a", "b"], "left").select("doc_id", "n", "node", F.when(F.col("doc_id") == F.col("node"), F.col("bands")).alias("bands")), "minmax-placed")
    # Texts of one document: their sets are connected, whatever they are.
    ids = placed.where("node IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("p"), F.max("node").alias("x"))
    same = materialise(ids.where("p < x").select("p", "x"), "minmax-same-id")
    members = bucket_members(placed.where("size(bands) > 0").select("node", "bands").distinct())
    links = group_links(members, nodes, given, like, sparing=True).unionByName(same)
    roots = components(links.select(F.col("p").alias("a"), F.col("x").alias("b")))
    own = F.coalesce("root", "node", "doc_id")
    return placed.join(roots, "node", "left").select(
        F.when(F.col("doc_id") < nameless, F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(own < nameless, own).alias("component_id"), (F.col("doc_id") == own).alias("kept"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


def components_sql(shingle: int, num: int, den: int) -> str:
    """DuckDB SQL for the components of ``documents``: texts are compared once each, through their common shingles."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH RECURSIVE words AS (
  SELECT text, min(doc_id) AS node, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM documents GROUP BY text
), sets AS (
  SELECT node, text, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {shingle} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {shingle - 2}), lambda i: array_to_string(w[i:i + {shingle - 1}], ' '))) END AS s FROM words
), shingles AS (
  SELECT node, len(s) AS n, md5(unnest(s)) AS h FROM sets
), pairs AS (
  SELECT x.node AS a, y.node AS b FROM shingles x JOIN shingles y ON x.h = y.h AND x.node < y.node AND {den} * y.n >= {num} * x.n AND {den} * x.n >= {num} * y.n
  GROUP BY x.node, y.node, x.n, y.n HAVING {den} * count(*) >= {num} * (x.n + y.n - count(*))
), edges AS MATERIALIZED (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT node AS start, node FROM sets UNION SELECT reach.start, edges.b FROM reach JOIN edges ON reach.node = edges.a
), roots AS (
  SELECT start AS node, min(node) AS root FROM reach GROUP BY start
)
SELECT d.doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN len(s) = 0 THEN d.doc_id ELSE root END AS component_id
FROM documents d JOIN sets ON d.text IS NOT DISTINCT FROM sets.text JOIN roots USING (node)"""


OP13_SQL = f"SELECT *, doc_id = component_id AS kept FROM ({components_sql(5, 85, 100)})"
