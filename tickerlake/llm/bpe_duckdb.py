"""Byte-level BPE encoding and decoding by DuckDB inside each Spark task.

A text is cut by the tokenizer's pattern, equal texts of a run once. The distinct pieces of a run of texts become rows
(piece, position, token), one per byte.
A recursive query joins neighbouring tokens with the merge table and contracts each piece's leftmost pair of minimum rank until no
pair is left. Decoding joins the token rows of a run with the vocabulary and concatenates the bytes in order; the tokens' lengths cut the texts apart.

The merge table holds every split of a token into two tokens. A piece that is a token itself is that token, as in the
tiktoken library; special tokens are not treated specially. Where every token is what its own bytes contract to by pairs of no higher rank (``in_merge_order``, as in any vocabulary
whose ranks are the order of merges), a contraction cannot create a pair of lower rank once all lower ranks are used up. Pieces over ``LONG_PIECE`` bytes are then contracted step by
step in a table that keeps the current tokens only, all pairs of the minimum rank at a time, which gives the same tokens. With another vocabulary they go through the recursive query like
all others.

Results for odd rows: NULL and empty texts have no tokens and decode to no bytes. Very long texts are coded whole, alone in their run. Repeated rows each get a row. A row without doc_id
is coded like others. Ties in rank go to the leftmost pair. An empty table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import give_back, table, texts

#: Text that is coded at a time; if sparing of memory, two runs to an Arrow batch under ``small_batches``.
RUN_BYTES, SPARING_RUN_BYTES = 1 << 21, 9 << 17
#: Pieces whose tokens a worker remembers; with more of them it forgets, before the next run, those met once only, or all if too many are left.
CACHE = 200_000
LONG_PIECE = 64
#: Short pieces of one query: its result holds every step.
QUERY_PIECES, SPARING_PIECES = 1 << 15, 1 << 13

#: A row knows its right neighbour (position and token). ``found`` orders pairs by rank, then position; a short piece has few positions.
_CONTRACT = """
WITH RECURSIVE state(piece, step, pos, id, next, next_id) AS (
  SELECT piece, 0, pos, id, lead(pos) OVER w, lead(id) OVER w FROM piece_bytes WINDOW w AS (PARTITION BY piece ORDER BY pos)
  UNION ALL
  SELECT s.piece, s.step + 1, s.pos, CASE WHEN s.pos = b.pos THEN b.rank ELSE s.id END,
    CASE WHEN s.pos = b.pos THEN b.after ELSE s.next END,
    CASE WHEN s.pos = b.pos THEN b.after_id WHEN s.next = b.pos THEN b.rank ELSE s.next_id END
  FROM state s JOIN (
    SELECT l.piece, l.pos, l.rank, l.next, r.next AS after, r.next_id AS after_id
    FROM (
      SELECT piece, found // 65536 AS rank, found % 65536 AS pos, next
      FROM (
        SELECT p.piece, min(m.rank::BIGINT * 65536 + p.pos) AS found, arg_min(p.next, m.rank::BIGINT * 65536 + p.pos) AS next
        FROM state p JOIN merges m ON m.a = p.id AND m.b = p.next_id GROUP BY p.piece
      )
    ) l JOIN state r ON r.piece = l.piece AND r.pos = l.next
  ) b ON b.piece = s.piece
  WHERE s.pos <> b.next
)
SELECT s.piece, s.id FROM state s JOIN (SELECT piece, max(step) AS last FROM state GROUP BY piece) f ON f.piece = s.piece AND f.last = s.step
ORDER BY s.piece, s.pos
"""

_STEP = """
CREATE OR REPLACE TEMP TABLE contracted AS
WITH pairs AS (
  SELECT piece, pos, id, lead(id) OVER w AS next_id, row_number() OVER w AS n FROM long_state WINDOW w AS (PARTITION BY piece ORDER BY pos)
), ranked AS (
  SELECT p.piece, p.pos, p.id, p.n, m.rank, min(m.rank) OVER (PARTITION BY p.piece) AS least
  FROM pairs p LEFT JOIN merges m ON m.a = p.id AND m.b = p.next_id
), hits AS (
  SELECT piece, n, n - row_number() OVER (PARTITION BY piece ORDER BY n) AS run FROM ranked WHERE rank = least
), chosen AS (
  SELECT piece, n FROM (SELECT piece, n, row_number() OVER (PARTITION BY piece, run ORDER BY n) AS k FROM hits) WHERE k % 2 = 1
)
SELECT r.piece, r.pos, CASE WHEN c.n IS NULL THEN r.id ELSE r.least END AS id
FROM ranked r LEFT JOIN chosen c ON c.piece = r.piece AND c.n = r.n LEFT JOIN chosen d ON d.piece = r.piece AND d.n = r.n - 1
WHERE d.n IS NULL
"""

#: The database has one thread, so the aggregate takes the rows in the order they are given.
_DECODE = """
SELECT string_agg(bytes, '') FROM (SELECT v.bytes FROM token_rows t JOIN vocabulary v ON v.id = t.id ORDER BY t.pos)
"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def in_merge_order(path: str) -> bool:
    """Whether the bytes of every token contract to it by pairs of no higher rank."""
    ranks = read_ranks(path)
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            least, at = min((ranks.get(a + b, rank + 1), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if least > rank:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return True


def _cut(group: np.ndarray, ids: np.ndarray, n: int) -> list[bytes]:
    """The ids (int32) of each of n groups, from rows in group order."""
    raw, edge = ids.astype(np.int32).tobytes(), (4 * np.searchsorted(group, np.arange(n + 1))).tolist()
    return [raw[a:b] for a, b in zip(edge, edge[1:])]


class Numbers(dict):
    """Numbers strings in the order in which they are first asked for."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


class Remembered:
    """Token ids of the pieces met so far, by their numbers."""

    def __init__(self) -> None:
        self.numbers = Numbers()
        self.start = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.seen = np.zeros(0, np.int64)

    def met(self, pieces: np.ndarray) -> None:
        """Count the runs' pieces."""
        self.seen = np.bincount(pieces, minlength=len(self.numbers)) + np.pad(self.seen, (0, len(self.numbers) - len(self.seen)))

    def frequent(self, most: int) -> Remembered:
        """Only the pieces met more than once, if they are no more than ``most``."""
        kept, out = np.flatnonzero(self.seen > 1), Remembered()
        if len(kept) <= most:
            strings = list(self.numbers)
            for i in kept.tolist():
                out.numbers[strings[i]] = len(out.numbers)
            out.ids, out.start = self.tokens(kept)
            out.seen = np.zeros(len(kept), np.int64)
        return out

    def fresh(self) -> list[str]:
        """Numbered pieces whose tokens are not known yet."""
        return list(islice(self.numbers, len(self.start) - 1, None))

    def add(self, tokens: list[bytes]) -> None:
        """Tokens (int32) of the fresh pieces, in their order."""
        size = np.array([len(t) // 4 for t in tokens], np.int64)
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(size)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(tokens), np.int32)])

    def tokens(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of the pieces one after the other, and where each piece's begin."""
        first, size = self.start[pieces], self.start[pieces + 1] - self.start[pieces]
        edge = np.concatenate([[0], np.cumsum(size)])
        return self.ids[np.repeat(first - edge[:-1], size) + np.arange(edge[-1])], edge


class Tokenizer:
    """Encodes and decodes with tables in an in-memory DuckDB database of the task's process; if ``sparing``, with less memory and more time."""

    def __init__(self, path: str, pattern: str, sparing: bool = False):
        self.sparing = sparing
        self.split = regex.compile(pattern)
        self.ranks = read_ranks(path)
        self.byte_ids = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.known = Remembered()
        self.db = duckdb.connect(":memory:")
        self._run("SET threads = 1")
        self._run("SET memory_limit = '200MB'")
        if sparing:
            # Else the database keeps the freed memory of a query.
            self._run("SET allocator_bulk_deallocation_flush_threshold = '1MB'")
        self._run(f"SET temp_directory = '{os.path.join(tempfile.gettempdir(), f'duckdb-{os.getpid()}')}'")
        tokens = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "bytes": pa.array([t.decode("latin-1") for t in self.ranks])})
        self.size = np.zeros(max(self.ranks.values(), default=0) + 1, np.int64)
        self.size[list(self.ranks.values())] = [len(t) for t in self.ranks]
        splits = [
            (self.ranks[t[:i]], self.ranks[t[i:]], rank) for t, rank in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        self.ordered = in_merge_order(path)
        pairs = pa.table({n: pa.array(x, pa.int32()) for n, x in zip(("a", "b", "rank"), zip(*splits) if splits else ((), (), ()))})
        self.db.register("pairs", pairs)
        self.db.register("tokens", tokens)
        self._run("CREATE TABLE merges AS SELECT * FROM pairs")
        self._run("CREATE TABLE vocabulary AS SELECT * FROM tokens")
        self.db.unregister("pairs")
        self.db.unregister("tokens")

    def _run(self, sql: str) -> list[tuple]:
        return self.db.execute(sql).fetchall()

    def _bytes(self, pieces: list[bytes]) -> pa.Table:
        size = np.array([len(p) for p in pieces], np.int64)
        first = np.cumsum(size) - size
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        if (ids < 0).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        return pa.table(
            {
                "piece": np.repeat(np.arange(len(pieces), dtype=np.int32), size),
                "pos": (np.arange(len(ids)) - np.repeat(first, size)).astype(np.int32),
                "id": ids,
            }
        )

    def _contract(self, pieces: list[bytes]) -> list[bytes]:
        """Tokens (int32) of short pieces by the recursive query."""
        self.db.register("piece_bytes", self._bytes(pieces))
        found = self.db.execute(_CONTRACT).fetchnumpy()
        self.db.unregister("piece_bytes")
        return _cut(found["piece"], found["id"], len(pieces))

    def _contract_long(self, pieces: list[bytes]) -> list[bytes]:
        """Tokens (int32) of long pieces, a statement for each step, so that only the current tokens are kept."""
        self.db.register("piece_bytes", self._bytes(pieces))
        self._run("CREATE OR REPLACE TEMP TABLE long_state AS SELECT * FROM piece_bytes")
        self.db.unregister("piece_bytes")
        left = self._run("SELECT count(*) FROM long_state")[0][0]
        while True:
            self._run(_STEP)
            now = self._run("SELECT count(*) FROM contracted")[0][0]
            self._run("CREATE OR REPLACE TEMP TABLE long_state AS SELECT * FROM contracted")
            if now == left:
                break
            left = now
        found = self.db.execute("SELECT piece, id FROM long_state ORDER BY piece, pos").fetchnumpy()
        return _cut(found["piece"], found["id"], len(pieces))

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Token ids (int32) of distinct pieces."""
        out: list[bytes] = [b""] * len(pieces)
        short, long = [], []
        for i, piece in enumerate(pieces):
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            else:
                (short if len(raw) <= LONG_PIECE or not self.ordered else long).append((i, raw))
        most = SPARING_PIECES if self.sparing else QUERY_PIECES
        groups = [(short[at : at + most], self._contract) for at in range(0, len(short), most)]
        for group, contract in [*groups, *([(long, self._contract_long)] if long else [])]:
            for (i, _), ids in zip(group, contract([raw for _, raw in group])):
                out[i] = ids
        return out

    def encode(self, values: list[str]) -> list[np.ndarray]:
        """Token ids of each text; equal texts share one array."""
        if len(self.known.numbers) > CACHE:
            self.known = self.known.frequent(CACHE // 2)
        place = Numbers()
        own = [place[v] for v in values]
        number = self.known.numbers.__getitem__
        cut = [np.fromiter(map(number, self.split.findall(v)), np.int64) for v in place]
        self.known.add(self._pieces(self.known.fresh()))
        pieces = np.concatenate(cut) if cut else np.zeros(0, np.int64)
        self.known.met(pieces)
        ids, edge = self.known.tokens(pieces)
        at = edge[np.cumsum([0] + [len(c) for c in cut])].tolist()
        texts = [ids[a:b] for a, b in zip(at, at[1:])]
        return [texts[i] for i in own]

    def decode(self, runs: list[np.ndarray]) -> list[bytes]:
        """Bytes of each run of token ids; a run that is the same array again is decoded once."""
        place: dict[int, int] = {}
        own = [place.setdefault(id(r), len(place)) for r in runs]
        if len(place) < len(runs):
            first = dict(zip(reversed(own), reversed(runs)))
            out = self.decode([first[i] for i in range(len(place))])
            return [out[i] for i in own]
        ids = np.concatenate(runs).astype(np.int32) if runs else np.zeros(0, np.int32)
        if not len(ids):
            return [b""] * len(runs)
        self.db.register("token_rows", pa.table({"pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
        whole = self._run(_DECODE)[0][0].encode("latin-1")
        self.db.unregister("token_rows")
        ends = np.concatenate([[0], np.cumsum(self.size[ids])])[np.cumsum([0] + [len(r) for r in runs])].tolist()
        return [whole[a:b] for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str, sparing: bool = False) -> Tokenizer:
    """One per worker process, kept for later tasks."""
    return Tokenizer(path, pattern, sparing)


def _runs(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Cut a column of texts into runs of about ``size`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low, done = 0, 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield low, high
        low, done = high, int(ends[high - 1])


def code_batches(batches: Iterator[pa.RecordBatch], coder: Tokenizer) -> Iterator[pa.RecordBatch]:
    """doc_id, ids and decoded bytes of every row. Free memory goes back to the system at the end, with a sparing tokenizer after each run."""
    for b in batches:
        for low, high in _runs(b.column("text"), SPARING_RUN_BYTES if coder.sparing else RUN_BYTES):
            ids = coder.encode(b.column("text").slice(low, high - low).fill_null("").to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = pa.array(np.concatenate(ids) if len(ids) else np.zeros(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(low, high - low), pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(coder.decode(ids), pa.binary())],
                ["doc_id", "ids", "decoded"],
            )
            if coder.sparing:
                del ids, offsets, flat
                give_back()
    give_back()


def encode_decode(docs: DataFrame, path: str | None = None, pattern: str | None = None, sparing: bool = False) -> DataFrame:
    """doc_id, ids array<int>, decoded binary of every row. ``path`` must name the vocabulary file on every executor; ``sparing`` is for executors that little memory is left of."""
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return code_batches(batches, tokenizer(path, pattern, sparing))

    return texts(docs).mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
