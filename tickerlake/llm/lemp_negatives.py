"""Hard negatives by LEMP-style coordinate pruning.

Rows are ordered by the length of their vectors and packed into buckets of ``BUCKET`` rows, longest first. A bucket holds a list per coordinate: its rows in the
order of that coordinate of their unit vectors. Anchors are packed into blocks of ``BLOCK``. A block meets every bucket whose longest vector can still reach what one of its anchors
asks for; in the bucket, a score of at least t needs a cosine of at least t / (anchor's length * longest length), which leaves each coordinate of a row a range around the
anchor's own. The ranges of the anchor's ``FOCUS`` largest coordinates are looked up in the lists; where a list leaves few rows, these are intersected with the
other ranges and verified one by one, else the bucket's rows are verified at once. Verified means the exact integer inner product.

What an anchor asks for starts at its k-th best score among a bounded sample of rows (``PROBE``) and rises while its block goes through the buckets of a task. Nothing is
approximate: a bound only leaves out rows that cannot be among the best k.

Blocks and buckets meet by lanes: a bucket lies in one of as many lanes as there are shuffle partitions, a block is copied into each lane. So the rows are moved once, the anchors
once per lane, and no task or driver holds more than a lane's share; the best k of a block come out of a lane once.

Results for odd rows: rows with a NULL id, label, vector or component, or a component that is not finite, take no part. Components become floor(256 * x); their
inner products must fit 64 bits. Vectors may be of any length and of different lengths: missing components count as 0, an empty vector scores 0 with all. Equal rows (id, label and
vector) are one. Rows that share an id but are not equal are rows of their own, none of them an "other" row of another. Ties go to the smaller id. Other columns are not read, so
their names cannot clash. An empty table gives no rows, as does an anchor without positives, or a positive with a score below 0, whose window is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerlake.llm.common import importable, key_sample, table
from tickerlake.session import materialise

BUCKET, BLOCK = 1024, 256
#: Coordinates of an anchor that are looked up.
FOCUS = 5
#: About as many rows are the sample for the first bounds, twice as many at most.
PROBE = 1024
#: A coordinate list that leaves at most this share of a bucket is worth following.
FEW = 0.125
_SLACK = 1e-6
_NONE = np.iinfo(np.int64).max

_PACK = "pack bigint, longest double, ids binary, labels binary, prints binary, sizes array<int>, vectors binary, lists binary, goals binary"


@dataclass
class Goal:
    """Which rows an anchor looks for: of its own label or of others, and how many of them."""

    same_label: bool
    k: int
    windows: int = 1


class Rows:
    """Some rows as arrays; vectors are padded with zeros to the longest."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, prints: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.prints, self.vectors = ids, labels, prints, vectors
        self.lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        self.unit = vectors / np.maximum(self.lengths, 1e-300)[:, None]

    def __len__(self) -> int:
        return len(self.ids)

    @classmethod
    def of(cls, pack: dict) -> Rows:
        sizes = np.array(pack["sizes"], np.int64)
        ids, labels, prints = (np.frombuffer(pack[c], np.int64) for c in ("ids", "labels", "prints"))
        return cls(ids, labels, prints, padded(np.frombuffer(pack["vectors"], np.int64), sizes))


def padded(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``; no partial sum exceeds ``bound``."""
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = min(a.shape[1], b.shape[1])
    return a[:, :width], b[:, :width]


def coordinate_lists(unit: np.ndarray) -> np.ndarray:
    """A row per coordinate: the vectors in ascending order of it."""
    return np.argsort(unit, axis=0, kind="stable").T.astype(np.uint16)


class Search:
    """The best rows found so far for the anchors of one block.

    ``low`` and ``high`` bound the scores of each anchor and window (a column each), ``floor`` is what a row must reach by now.
    """

    def __init__(self, anchors: Rows, goal: Goal, low: np.ndarray, high: np.ndarray):
        self.anchors, self.goal, self.low, self.high = anchors, goal, low, high
        self.floor = low.copy()
        self.found = [np.zeros(0, np.int64) for _ in range(4)]  # anchor * windows + window, score, id, print
        size = np.abs(anchors.unit)
        self.focus = np.argsort(-size, axis=1, kind="stable")[:, :FOCUS]
        self.angle = np.arccos(np.clip(np.take_along_axis(anchors.unit, self.focus, 1), -1, 1))

    def asked(self) -> np.ndarray:
        """The least score that is still of use to each anchor; beyond all scores if no window is open."""
        floor = np.where(self.low <= self.high, self.floor, _NONE)
        return floor.min(axis=1, initial=_NONE)

    def need(self) -> float:
        """Length that a row must have to be of use to any anchor."""
        asked, length = self.asked(), self.anchors.lengths
        need = np.where(asked <= 0, 0.0, np.where(length > 0, asked / np.maximum(length, 1e-300), np.inf))
        return float(np.where(asked == _NONE, np.inf, need).min(initial=np.inf))

    def pairs(self, rows: Rows, lists: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all rows that reach what their anchor asks for."""
        asked, lengths = self.asked(), self.anchors.lengths
        longest = float(rows.lengths.max(initial=0.0))
        bound = float(lengths.max(initial=0.0)) * longest + 1
        open_ = asked != _NONE
        cosine = np.where(asked > 0, asked / np.maximum(lengths * longest, 1e-300), -1.0)
        open_ &= cosine <= 1 + _SLACK
        a, b = same_width(self.anchors.vectors, rows.vectors)
        few = np.zeros(len(self.anchors), bool)
        out = []
        width = a.shape[1]
        if lists is not None and width:
            within = np.arccos(np.clip(cosine, -1, 1))[:, None] + _SLACK
            least = np.cos(np.minimum(np.pi, self.angle + within)) - _SLACK
            most = np.cos(np.maximum(0, self.angle - within)) + _SLACK
            # All lists in one ascending array: coordinate f lies around 4 * f.
            ordered = np.take_along_axis(rows.unit.T, lists.astype(np.int64), 1) + 4.0 * np.arange(len(lists))[:, None]
            usable = (self.focus < len(lists)) & (cosine > 0)[:, None]
            f = np.minimum(self.focus, len(lists) - 1)
            first = np.searchsorted(ordered.ravel(), least + 4.0 * f)
            last = np.searchsorted(ordered.ravel(), most + 4.0 * f, side="right")
            span = np.where(usable, np.maximum(last - first, 0), len(rows) + 1)
            best = span.argmin(axis=1)
            few = open_ & (span.min(axis=1) <= FEW * len(rows))
            for i in np.flatnonzero(few):
                j = best[i]
                row = lists.ravel()[first[i, j] : last[i, j]].astype(np.int64)
                for other in range(self.focus.shape[1]):
                    if other != j and usable[i, other]:
                        value = rows.unit[row, f[i, other]]
                        row = row[(value >= least[i, other]) & (value <= most[i, other])]
                out.append((np.full(len(row), i), row, products(a[i : i + 1], b[row], bound)[0]))
        many = np.flatnonzero(open_ & ~few)
        if len(many):
            score = products(a[many], b, bound)
            at, row = np.nonzero(score >= asked[many][:, None])
            out.append((many[at], row, score[at, row]))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(c) for c in zip(*out))

    def meet(self, rows: Rows, lists: np.ndarray | None = None) -> None:
        anchor, row, score = self.pairs(rows, lists)
        same = self.anchors.labels[anchor] == rows.labels[row]
        fit = (same & (self.anchors.ids[anchor] != rows.ids[row])) if self.goal.same_label else ~same
        anchor, row, score = anchor[fit], row[fit], score[fit]
        for window in range(self.goal.windows):
            inside = (score >= self.floor[anchor, window]) & (score <= self.high[anchor, window])
            new = (anchor[inside] * self.goal.windows + window, score[inside], rows.ids[row[inside]], rows.prints[row[inside]])
            self.found = [np.concatenate(c) for c in zip(self.found, new)]
        key, score, ids, prints = self.found
        order = np.lexsort((prints, ids, -score, key))
        key = key[order]
        start = np.searchsorted(key, key)
        place = np.arange(len(key)) - start
        kept = order[place < self.goal.k]
        full = place == self.goal.k - 1
        self.found = [c[kept] for c in self.found]
        self.floor.ravel()[key[full]] = np.maximum(self.floor.ravel()[key[full]], score[order][full])


def prepared(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """vec_id, label, print, length and vector (whole numbers) of the rows that take part."""
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(256 * x))
    fine = F.forall(F.col(vector).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), F.when(fine, whole).alias("vector"))
    given = given.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return given.select("vec_id", "label", F.xxhash64("label", "vector").alias("print"), length.alias("length"), "vector")


def packed(rows: DataFrame, size: int, goal: Goal, lists: bool) -> DataFrame:
    """Packs of up to ``size`` rows in descending order of length. Equal rows come together and are taken once.

    A column ``goals``, if there, holds a row's windows as (low, high) pairs.
    """
    wanted = "goals" in rows.columns
    ordered = rows.repartitionByRange(F.col("length").desc(), "vec_id", "print").sortWithinPartitions(F.col("length").desc(), "vec_id", "print")

    def pack(number: int, part: pa.RecordBatch) -> pa.RecordBatch:
        sizes = part.column("vector").value_lengths().to_numpy().astype(np.int64)
        values = part.column("vector").flatten().to_numpy().astype(np.int64)
        given = Rows(*(part.column(c).to_numpy() for c in ("vec_id", "label", "print")), padded(values, sizes))
        goals = part.column("goals").flatten().to_numpy().astype(np.int64).tobytes() if wanted else b""
        columns = [
            number, float(given.lengths.max()), *(part.column(c).to_numpy().astype(np.int64).tobytes() for c in ("vec_id", "label", "print")),
            sizes.tolist(), values.tobytes(), coordinate_lists(given.unit).tobytes() if lists else b"", goals,
        ]
        names = ["pack", "longest", "ids", "labels", "prints", "sizes", "vectors", "lists", "goals"]
        kinds = [pa.int64(), pa.float64(), *[pa.binary()] * 3, pa.list_(pa.int32()), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, prints = batch.column("vec_id").to_numpy(), batch.column("print").to_numpy()
            if not len(ids):
                continue
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1])
            new[0] = last != (ids[0], prints[0])
            last = (ids[-1], prints[-1])
            more = pa.Table.from_batches([batch.filter(pa.array(new))])
            held = more if held is None else pa.concat_tables([held, more])
            while held.num_rows >= size:
                yield pack(number, held.slice(0, size).combine_chunks().to_batches()[0])
                held, number = held.slice(size), number + 1
        if held is not None and held.num_rows:
            yield pack(number, held.combine_chunks().to_batches()[0])

    return ordered.mapInArrow(run, _PACK)


def sample_rows(rows: DataFrame) -> Rows | None:
    """The bounded sample on which the first bounds rest."""
    taken = key_sample(rows, PROBE, "vec_id").select("vec_id", "label", "print", "vector").dropDuplicates(["vec_id", "print"]).collect()
    if not taken:
        return None
    sizes = np.array([len(r["vector"]) for r in taken], np.int64)
    values = np.array([x for r in taken for x in r["vector"]], np.int64)
    return Rows(*(np.array([r[c] for r in taken], np.int64) for c in ("vec_id", "label", "print")), padded(values, sizes))


def _search(pack: dict, goal: Goal) -> Search:
    anchors = Rows.of(pack)
    if goal.same_label:
        low = np.full((len(anchors), 1), np.iinfo(np.int64).min)
        return Search(anchors, goal, low, np.full((len(anchors), 1), _NONE - 1))
    windows = np.frombuffer(pack["goals"], np.int64).reshape(len(anchors), goal.windows, 2)
    return Search(anchors, goal, windows[:, :, 0].copy(), windows[:, :, 1].copy())


def with_floors(blocks: DataFrame, goal: Goal, sample: Rows | None) -> DataFrame:
    """Adds to each block its anchors' floors after the sample, and the length that a bucket needs to be of use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors, needs = [], []
            for pack in batch.to_pylist():
                search = _search(pack, goal)
                if sample is not None:
                    search.meet(sample)
                floors.append(search.floor.tobytes())
                needs.append(search.need() * (1 - _SLACK))
            columns = [*batch.columns, pa.array(floors, pa.binary()), pa.array(needs, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "floors", "need"])

    return blocks.mapInArrow(run, f"{_PACK}, floors binary, need double")


def best_rows(blocks: DataFrame, buckets: DataFrame, goal: Goal, sample: Rows | None) -> DataFrame:
    """anchor_id, anchor_print, place (of the window), score, vec_id, print: the best ``k`` rows of each anchor and window, in every lane."""
    lanes = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = materialise(with_floors(blocks, goal, sample), "lemp-asked")
    copies = asked.select(*[F.col(c).alias(f"a_{c}") for c in asked.columns], F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    lying = buckets.withColumn("lane", F.pmod(F.xxhash64("pack"), F.lit(lanes)).cast("int"))
    # Sorted by lane and merged, so that the buckets of a lane follow each other for one block, longest first.
    lying = lying.repartition(lanes, "lane").sortWithinPartitions("lane", F.col("longest").desc())
    met = copies.repartition(lanes, "lane").hint("merge").join(lying, "lane").where("longest >= a_need")
    names = ["pack", "longest", "ids", "labels", "prints", "sizes", "vectors", "lists", "goals"]

    def results(search: Search) -> pa.RecordBatch:
        key, score, ids, prints = search.found
        anchor, window = key // goal.windows, key % goal.windows
        columns = [search.anchors.ids[anchor], search.anchors.prints[anchor], window, score, ids, prints]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "anchor_print", "place", "score", "vec_id", "print"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, current = None, None
        kept, rows, lists = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column("a_pack")[i].as_py(), batch.column("lane")[i].as_py()
                if key != current:
                    if search is not None:
                        yield results(search)
                    search, current = _search({c: batch.column(f"a_{c}")[i].as_py() for c in names}, goal), key
                    search.floor = np.frombuffer(batch.column("a_floors")[i].as_py(), np.int64).reshape(search.low.shape).copy()
                bucket = batch.column("pack")[i].as_py()
                if bucket != kept:
                    rows, kept = Rows.of({c: batch.column(c)[i].as_py() for c in names}), bucket
                    lists = np.frombuffer(batch.column("lists")[i].as_py(), np.uint16).reshape(-1, len(rows))
                if batch.column("longest")[i].as_py() >= search.need() * (1 - _SLACK):
                    search.meet(rows, lists)
        if search is not None:
            yield results(search)

    return met.mapInArrow(run, "anchor_id bigint, anchor_print bigint, place bigint, score bigint, vec_id bigint, print bigint")


def best_k(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "print")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, every: int = 100,
    key: str = "vec_id", label: str = "label", vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id ``every`` divides; their positives the best ``positives`` other rows of the label; the negatives of each the best ``negatives`` rows of other
    labels with ``low`` to ``high`` hundredths of the positive's score.
    """
    importable(rows.sparkSession)
    given = materialise(prepared(rows, key, label, vector), "lemp-rows")
    buckets = materialise(packed(given, BUCKET, Goal(True, positives), True), "lemp-buckets")
    anchors = given.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "print"])
    sample = sample_rows(given)
    own = Goal(True, positives)
    found = best_rows(materialise(packed(anchors, BLOCK, own, False), "lemp-blocks"), buckets, own, sample)
    chosen = best_k(found, ["anchor_id", "anchor_print"], positives).select(
        "anchor_id", "anchor_print", (F.col("rank") - 1).cast("bigint").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    chosen = materialise(with_windows(chosen, low, high), "lemp-positives")
    # Missing positives have an empty window.
    slots = [F.max(F.when(F.col("place") == i, F.struct("least", "most"))) for i in range(positives)]
    goals = F.array(*[x for s in slots for x in (F.coalesce(s["least"], F.lit(1)), F.coalesce(s["most"], F.lit(0)))])
    asking = chosen.groupBy("anchor_id", "anchor_print").agg(goals.alias("goals"))
    asking = anchors.join(asking.withColumnsRenamed({"anchor_id": "vec_id", "anchor_print": "print"}), ["vec_id", "print"])
    other = Goal(False, negatives, positives)
    found = best_rows(materialise(packed(asking, BLOCK, other, False), "lemp-blocks"), buckets, other, sample)
    ranked = best_k(found, ["anchor_id", "anchor_print", "place"], negatives)
    return ranked.join(chosen, ["anchor_id", "anchor_print", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def with_windows(chosen: DataFrame, low: int, high: int) -> DataFrame:
    """Adds least and most, the smallest and largest whole score in the window, in integer arithmetic."""
    score = F.col("positive_score")
    least = F.expr(f"-((-positive_score * {low}) div 100)")
    least = F.when(score >= 0, F.expr(f"(positive_score * {low} + 99) div 100")).otherwise(least)
    most = F.when(score >= 0, F.expr(f"(positive_score * {high}) div 100")).otherwise(F.expr(f"-((-positive_score * {high} + 99) div 100)"))
    return chosen.withColumns({"least": least, "most": most})


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"))


OP12_SQL = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM given a JOIN given r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""
