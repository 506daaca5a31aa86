"""CSV records that may hold line breaks inside quotes, read by many tasks, with every file's columns matched by name.

A line starts a record if an even number of quotes stands before it in the file. That number is a prefix sum: quotes are counted per file block and the counts of the blocks added up (a
row per block), so each task knows whether its block begins inside quotes. A second pass puts the lines of a block together as they are read, and writes the records once.
Only the lines of records that cross into another block are brought together from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerlake.functions import cleaning as cl
from tickerlake.functions.naming import camel_to_snake
from tickerlake.session import materialise

#: Lines of a record. A longer one has a quote that is never closed; its lines are records of their own.
LONGEST = 1000

_PIECES = "at bigint, record bigint, line bigint, text string, part boolean"


@contextmanager
def same_blocks(spark: SparkSession) -> Iterator[None]:
    """Files are cut into the same blocks in every read, also if executors come or go in between."""
    name = "spark.sql.files.minPartitionNum"
    given = spark.conf.get(name, None)
    if given is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(name)


def _quotes_before(lines: DataFrame) -> DataFrame:
    """(at, file, block, open): a number for each block, and whether it begins inside quotes. A row per block."""
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("_odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = (F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2).cast("boolean")
    return materialise(blocks.select(F.monotonically_increasing_id().alias("at"), "file", "block", opened.alias("open")), "file-blocks")


def block_pieces(lines: DataFrame, longest: int) -> DataFrame:
    """Rows (at, record, line, text, part) from the lines (at, block, open, text) of the blocks: whole records, and the lines of those that may cross into another block.

    ``record`` is the place in the file of the record's first line, ascending from record to record: its block's start plus the lines of the block before it, each of which has a
    byte at least. It is NULL for lines that continue a record of an earlier block. A record of more than ``longest`` lines comes line by line, like one that crosses.
    """

    def batch_of(at: int, records, lines, texts, part: bool) -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.array(np.full(n, at)), pa.array(records, pa.int64()), pa.array(lines, pa.int64()), texts, pa.array(np.full(n, part))]
        return pa.RecordBatch.from_arrays(columns, ["at", "record", "line", "text", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the block, its next line, whether that line is inside quotes, and the open record's first line and lines held so far
        at, line, inside, first, held = None, 0, False, None, []

        def let_go(block: int) -> Iterator[pa.RecordBatch]:
            if held:
                texts = pa.concat_arrays(held)
                start = line - len(texts)
                yield batch_of(at, [None if first is None else block + first] * len(texts), np.arange(start, line), texts, True)
                held.clear()

        block_at = 0
        for batch in batches:
            numbers = batch.column("at").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)]])
            for low, high in zip(edges[:-1], edges[1:]):
                if low == high:
                    continue
                if numbers[low] != at:
                    yield from let_go(block_at)
                    at, line, first = int(numbers[low]), 0, None
                    inside, block_at = batch.column("open")[low].as_py(), batch.column("block")[low].as_py()
                texts = batch.column("text").slice(low, high - low)
                odd = pc.count_substring(texts, '"').to_numpy(zero_copy_only=False) % 2
                seen = np.cumsum(odd) - odd + inside
                starts = np.flatnonzero(seen % 2 == 0)
                inside = bool((seen[-1] + odd[-1]) % 2)
                # lines before the first start go on with the open record
                head = int(starts[0]) if len(starts) else len(texts)
                if head:
                    held.append(texts.slice(0, head))
                    line += head
                if first is None or sum(map(len, held)) > longest:
                    yield from let_go(block_at)
                if not len(starts):
                    continue
                if held:
                    whole = pa.concat_arrays(held)
                    held.clear()
                    if line - first > longest:  # some of its lines have gone already
                        yield batch_of(at, [block_at + first] * len(whole), np.arange(line - len(whole), line), whole, True)
                    else:
                        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole), "\n")
                        yield batch_of(at, [block_at + first], [first], joined, False)
                ends = np.append(starts[1:], len(texts))
                closed = len(starts) - inside
                long = np.flatnonzero((ends - starts)[:closed] > longest)
                if closed:
                    offsets = np.append(starts[:closed], ends[closed - 1])
                    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts), "\n")
                    number = line + starts[:closed] - head
                    if len(long):
                        kept = np.ones(closed, bool)
                        kept[long] = False
                        joined, number = joined.filter(pa.array(kept)), number[kept]
                    yield batch_of(at, block_at + number, number, joined, False)
                for i in long:
                    a, n = line + int(starts[i]) - head, int(ends[i] - starts[i])
                    yield batch_of(at, [block_at + a] * n, np.arange(a, a + n), texts.slice(int(starts[i]), n), True)
                if inside:
                    first = line + int(starts[-1]) - head
                    held.append(texts.slice(int(starts[-1])))
                else:
                    first = line + len(texts) - head
                line += len(texts) - head
        yield from let_go(block_at)

    return lines.select("at", "block", "open", "text").mapInArrow(run, _PIECES)


def csv_records(spark: SparkSession, path: str | list[str], longest: int = LONGEST) -> DataFrame:
    """(file, record, text): the records of all files, line breaks inside quotes kept as a line feed; ``record`` ascends in a file."""
    with same_blocks(spark):
        lines = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))
        blocks = _quotes_before(lines)
        # a row per block; one that the first read did not have is an error
        known = lines.join(F.broadcast(blocks), ["file", "block"], "left").withColumn("at", F.coalesce("at", F.raise_error(F.lit("a file changed while it was read")).cast("bigint")))
        pieces = materialise(block_pieces(known, longest), "record-pieces")
    parts = pieces.filter("part").join(F.broadcast(blocks), "at").select("file", "block", "line", "record", "text")
    # the record that is open where a block begins started in the last earlier block with an own open one: a row per block in this window
    open_ends = parts.groupBy("file", "block").agg(F.max("record").alias("_last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = open_ends.select("file", "block", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    parts = parts.join(F.broadcast(before), ["file", "block"]).withColumn("record", F.coalesce("record", "_before")).drop("_before")
    parts = materialise(parts, "crossing-lines")
    sizes = materialise(parts.groupBy("file", "record").agg((F.count("*") <= longest).alias("closed")), "record-sizes")
    sized = parts.join(sizes, ["file", "record"])
    joined = sized.filter("closed").groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "line", "text"))).alias("_l"))
    crossing = joined.select("file", "record", F.array_join(F.transform("_l", lambda x: x["text"]), "\n").alias("text"))
    lost = sized.filter("NOT closed").select("file", "record", "text")
    whole = pieces.filter("NOT part").join(F.broadcast(blocks), "at").select("file", "record", "text")
    return whole.unionByName(crossing).unionByName(lost)


def scan_csv_records(spark: SparkSession, path: str | list[str], schema: str, longest: int = LONGEST) -> DataFrame:
    """Rows of all CSV files of a path in the declared columns and types, and ``source_file``.

    Columns are found by each file's own header, as written or in snake case, whatever their order; a column that a file lacks is NULL, one that is not declared is left out. A cell that
    does not fit its type is NULL. Blank lines are no records.
    """
    wanted = spark.createDataFrame([], schema).schema
    # stored parts, put together at each use
    records = csv_records(spark, path, longest).filter(F.trim("text") != "")
    first = records.groupBy("file").agg(F.min_by("text", "record").alias("header"), F.min("record").alias("_first"))
    options = {"quote": '"', "escape": '"', "maxColumns": "20480"}
    # one pass over the headers, a row per file: how many cells a record can have
    width = first.agg(F.max(F.length("header") - F.length(F.replace("header", F.lit(","), F.lit(""))))).first()[0]
    cells = ", ".join(f"c{i} string" for i in range((width or 0) + 1))
    names = [f"c{i}" for i in range((width or 0) + 1)]

    def parsed(c: str) -> Column:
        # a one-element explode keeps the record from being parsed once per column
        return F.from_csv(F.col(c), F.lit(cells), options)

    def key(c: Column) -> Column:
        return F.lower(F.regexp_replace(cl.strip(c), "[_ \ufeff]", ""))

    heads = first.select("file", "_first", parsed("header").alias("_h")).select("file", "_first", F.array(*[key(F.col(f"_h.{n}")) for n in names]).alias("_names"))
    heads = materialise(heads, "csv-headers")
    rows = records.join(heads, "file").filter(F.col("record") > F.col("_first"))
    split = rows.select("file", "_names", F.explode(F.array(parsed("text"))).alias("_r")).select(
        "file", "_names", F.array(*[F.col(f"_r.{n}") for n in names]).alias("_cells"))

    def column(name: str, kind: str) -> Column:
        at = F.array_position("_names", camel_to_snake(name).replace("_", "").lower())
        cell = F.when(at > 0, F.try_element_at("_cells", at.cast("int")))
        return (cell if kind == "string" else cl.safe_cast(cell, kind)).alias(name)

    return split.select(*[column(f.name, f.dataType.simpleString()) for f in wanted], F.element_at(F.split("file", "/"), -1).alias("source_file"))
