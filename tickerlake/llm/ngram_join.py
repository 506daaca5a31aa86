"""Jaccard join of the documents' shingle sets by PartEnum signatures.

Sets are put into bands of almost equal size, ``[l, l * den / num]``. Linked sets lie in one band or in neighbouring ones, and in such an instance
differ in at most k shingles. The shingle domain is cut into more than k parts by hash, so linked sets agree on a part:
the hash of a set's shingles in a part is a signature, and linked sets share one. (This is PartEnum with subsets of one second-level part, the
choice with fewest signatures.) Parts empty in a set would all agree, so ``spare`` parts are added and empty
ones are left out. Linked sets that agree on empty parts only have more of those than spare ones, both, and get signatures of another cut of the domain as well, and of the last cut (``CUTS``) the empty
parts', too. Sets without enough shingles of other documents have no link and get no signatures (``shared_shingles``).

Documents with a common signature are paired if they are few. In a larger group they meet only the smallest of them, the pivot, and the pairs are
checked on the whole sets. A pivot's members make a family. (Pairs and members that counts of the shingles' first bytes rule out, which bound the difference from below, go before the sets are
read.) Where a member x is not linked with pivot p, links with other members may be left, and
|x ^ y| = |x ^ p| + |y ^ p| - 2 |(x ^ p) & (y ^ p)| gives them from the differences alone, in one task for a family of bounded size. If x and y are
linked, they share one of the first k + 1 shingles in which each differs from p (in a fixed order), because their differences from p differ in at most k;
so a larger family is cut by these shingles, and a part that is still too large gets a pivot of its own. No link between different components is lost,
and no pair is written out but with a pivot or within a group of ``DIRECT``.

Results for odd rows: equal sets are one node. NULL, empty and wordless texts have an empty set and no link; very long texts count whole. Repeated rows get a row each. A NULL doc_id is
larger than all others and comes back as NULL; rows without one are the same document only if their texts are. Ties do not arise: ids order everything. An empty table gives no
rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerlake.llm.common import give_back, identified, release_shuffles, table, texts
from tickerlake.llm.components import components
from tickerlake.llm.shared_shingles import mostly_shared
from tickerlake.llm.words import U64, Words, mix, slices, window_hashes
from tickerlake.session import materialise

#: Groups of this size or less are compared whole.
DIRECT = 16
#: Members and bytes of differences of a family that one task compares, and the cells of the matrices it holds for that.
FAMILY, FAMILY_BYTES, CELLS = 1 << 14, 1 << 26, 1 << 20
#: Pairs of sketches that one task compares are at most the square of this.
SKETCHED = 2048
#: Ways to cut the shingle domain into parts, for sets with too many empty parts in the ones before.
CUTS = 4
#: Pairs whose differences a task holds.
PAIRS_AT_ONCE = 256
_KEY = "doc_id bigint, n bigint, a bigint, b bigint"


class Similarity:
    """Sets link when den * intersection >= num * union."""

    def __init__(self, shingle: int, num: int, den: int):
        self.shingle, self.num, self.den = shingle, num, den
        self.top = np.array([self.den // self.num], np.int64)

    def tops(self, most: int) -> np.ndarray:
        """Largest size of each band, past the band of ``most``."""
        if self.top[-1] < most or len(self.top) < 2 or self.top[-2] < most:
            top = self.top.tolist()
            while len(top) < 2 or top[-2] < most:
                top.append((top[-1] + 1) * self.den // self.num)
            self.top = np.array(top, np.int64)
        return self.top

    def differ(self, total: np.ndarray | int) -> np.ndarray | int:
        """Most shingles in which linked sets of this total size differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    def linked(self, both: int, m: int, n: int) -> bool:
        return self.den * both >= self.num * (m + n - both) and both > 0

    def sets(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of the texts, sorted within each text, and the offsets of the texts."""
        h = words.hashes(lower=True)
        first = words.windows(self.shingle)
        x, text = window_hashes(h, first, self.shingle), words.text_of(first)
        counts = words.counts
        small = np.flatnonzero((counts > 0) & (counts < self.shingle))
        if len(small):
            whole = window_hashes(h, words.offsets[small], counts[small]) ^ mix(counts[small].astype(np.uint64))
            place = np.searchsorted(text, small)
            x, text = np.insert(x, place, whole), np.insert(text, place, small)
        edge = np.searchsorted(text, np.arange(len(counts) + 1))
        for i in range(len(counts)):
            x[edge[i] : edge[i + 1]].sort()
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (text[1:] != text[:-1])
        kept = np.concatenate([[0], np.cumsum(new)])
        return x[new], kept[edge]

    def signatures(self, x: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, signature) of all sets in the instances of their own band and the next."""
        size = np.diff(edge)
        most = int(size.max(initial=0))
        if not most:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        top = self.tops(most)
        band = np.searchsorted(top, size)
        text_of = np.repeat(np.arange(len(size)), size)
        texts_out, found = [], []
        for step in (0, 1):
            j = np.minimum(band + step, len(top) - 1)
            k = self.differ(2 * top[j])
            spare = np.where(k == 0, 0, 1 + k // 16)
            own = size > 0
            if step:  # the next band matters only to sets that can reach it
                own &= size * self.den // self.num > top[band]
            for cut in range(CUTS):
                parts = np.where(own, k + 1 + spare, 0)
                base = np.concatenate([[0], np.cumsum(parts)])
                values, holder = x[own[text_of]], text_of[own[text_of]]
                seed = mix(j.astype(np.uint64) + U64(0x51ED + (cut << 40)))
                part = (mix(values ^ seed[holder]) >> U64(11)) % parts[holder].astype(np.uint64)
                slot = base[holder] + part.astype(np.int64)
                spread = mix(values + U64(0xA5A5))
                low = np.bincount(slot, (spread & U64(0xFFFFFFFF)).astype(np.float64), base[-1]).astype(np.uint64)
                high = np.bincount(slot, (spread >> U64(32)).astype(np.float64), base[-1]).astype(np.uint64)
                full = np.bincount(slot, minlength=base[-1]) > 0
                text = np.repeat(np.arange(len(size)), parts)
                bare = np.bincount(text[~full], minlength=len(size)) > spare
                emit = full | bare[text] if cut == CUTS - 1 else full
                number = (np.arange(base[-1]) - base[text]).astype(np.uint64)
                sig = mix(low + mix(high + mix(number + seed[text])))
                texts_out.append(text[emit])
                found.append(sig[emit])
                own = own & bare
                if not own.any():
                    break
        return np.concatenate(texts_out), np.concatenate(found)


def _fingerprints(x: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each set."""
    out = []
    for salt in (1, 2):
        total = np.concatenate([[U64(0)], np.cumsum(mix(x + U64(salt * 0x9E37)))])
        out.append(mix(total[edge[1:]] - total[edge[:-1]] + U64(salt)))
    return out[0], out[1]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def set_keys(docs: DataFrame, like: Similarity) -> DataFrame:
    """doc_id, set size n and a 128-bit key (a, b) of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in slices(batch.column("text")):
                x, edge = like.sets(words)
                a, b = _fingerprints(x, edge)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), pa.array(np.diff(edge)), _signed(a), _signed(b)], ["doc_id", "n", "a", "b"])
        give_back()

    return docs.mapInArrow(run, _KEY)


def signature_rows(docs: DataFrame, like: Similarity, later: bool) -> DataFrame:
    """(key, doc_id, n): for each signature in a slice of a batch its smallest document and how many have it; or, if ``later``, the other ones.

    Of equal sets in a slice only the smallest document's takes part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for low, high, words in slices(batch.column("text")):
                x, edge = like.sets(words)
                own = ids[low:high]
                a, _ = _fingerprints(x, edge)
                order = np.lexsort((own, a))
                taken = np.zeros(len(own), bool)
                taken[order] = np.concatenate([[True], a[order][1:] != a[order][:-1]])
                text, sig = like.signatures(x, edge)
                sig, doc = sig[taken[text]], own[text[taken[text]]]
                order = np.argsort(doc, kind="stable")
                order = order[np.argsort(sig[order], kind="stable")]
                first = np.concatenate([[True], sig[order][1:] != sig[order][:-1]]) if len(sig) else np.zeros(0, bool)
                count = np.diff(np.append(np.flatnonzero(first), len(sig)))
                # Rows leave in the order of the documents, which compresses well.
                least = np.sort(order[first])
                n = np.zeros(len(sig), np.int64)
                n[order[first]] = count
                if later:
                    least = np.setdiff1d(np.arange(len(sig)), least, assume_unique=True)
                yield pa.RecordBatch.from_arrays([_signed(sig[least]), pa.array(doc[least]), pa.array(n[least])], ["key", "doc_id", "n"])
        give_back()

    return docs.mapInArrow(run, "key bigint, doc_id bigint, n bigint")


def signature_members(docs: DataFrame, like: Similarity) -> DataFrame:
    """(key, p, size, doc_id): the members of the groups with a common signature.

    All signatures are shuffled once, a row for each slice of a batch, so that a signature of a third of all documents makes few rows. The other documents of
    a slice are few, and join the groups afterwards.
    """
    group = Window.partitionBy("key")
    rows = signature_rows(docs, like, False).withColumns({"p": F.min("doc_id").over(group), "size": F.sum("n").over(group)})
    first = materialise(rows.where("size > 1").select("key", "p", "size", "doc_id", "n"), "first-members")
    groups = first.where("n > 1").select("key", "p", "size").distinct()
    later = signature_rows(docs, like, True).select("key", "doc_id").join(groups, "key").select("key", "p", "size", "doc_id")
    return materialise(first.select("key", "p", "size", "doc_id").unionByName(later), "members")


def set_blobs(docs: DataFrame, like: Similarity) -> DataFrame:
    """(doc_id, shingles, sketch): the sorted 64-bit shingles of every row as bytes, and how many begin with each byte (255 at most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in slices(batch.column("text")):
                x, edge = like.sets(words)
                own = [x[edge[i] : edge[i + 1]] for i in range(high - low)]
                sketch = [np.minimum(np.bincount(v >> U64(56), minlength=256), 255).astype(np.uint8).tobytes() for v in own]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array([v.tobytes() for v in own], pa.binary()), pa.array(sketch, pa.binary())], ["doc_id", "shingles", "sketch"]
                )
        give_back()

    return docs.mapInArrow(run, "doc_id bigint, shingles binary, sketch binary")


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 256).astype(np.int16)


def close_pairs(pairs: DataFrame, blobs: DataFrame, like: Similarity) -> DataFrame:
    """The pairs whose sketches do not rule a link out: sets differ in at least as many shingles as their sketches do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.abs(_sketches(batch.column("mine")) - _sketches(batch.column("theirs"))).sum(1, dtype=np.int64)
            total = batch.column("n_x").to_numpy() + batch.column("n_p").to_numpy()
            yield batch.select(["p", "x"]).filter(pa.array(apart <= like.differ(total)))
        give_back()

    n = (F.length("shingles") / 8).cast("bigint")
    mine = blobs.select(F.col("doc_id").alias("x"), F.col("sketch").alias("mine"), n.alias("n_x"))
    theirs = blobs.select(F.col("doc_id").alias("p"), F.col("sketch").alias("theirs"), n.alias("n_p"))
    return pairs.join(mine, "x").join(theirs, "p").mapInArrow(run, "p bigint, x bigint")


def close_members(star: DataFrame, blobs: DataFrame, like: Similarity, met: DataFrame | None = None, places: DataFrame | None = None) -> DataFrame:
    """The pairs (p, x) of a pivot whose member may be linked with the pivot or with another member, by their sketches; all of too large a family.

    All, too, of the pivots p in ``met``, which have members from earlier rounds that are not in ``star``. With ``places`` (x, c, root), only links between different c and root count.
    """
    if met is not None:
        known = materialise(met.select("p").distinct(), "known-pivots")
        fresh = close_members(star.join(known, "p", "left_anti"), blobs, like, places=places)
        return fresh.unionByName(star.join(known, "p", "left_semi").select("p", "x"))

    def run(rows: pa.Table) -> pa.Table:
        sketch, n, c, root = _sketches(rows["sketch"]), *(rows[name].to_numpy() for name in ("n", "c", "root"))
        keep = np.zeros(len(n), bool)
        # Members of the largest part with one root have links that count to the other members only, which find them.
        _, part, size = np.unique(root, return_inverse=True, return_counts=True)
        minor = np.flatnonzero(part != size.argmax())
        for low in range(0, len(minor), 16):
            own = minor[low : low + 16]
            for start in range(0, len(n), SKETCHED):
                some = slice(start, start + SKETCHED)
                apart = np.abs(sketch[own, None, :] - sketch[None, some, :]).sum(2, dtype=np.int32)
                close = (apart <= like.differ(n[own, None] + n[None, some])) & (c[own, None] != c[None, some]) & (root[own, None] != root[None, some])
                keep[own] |= close.any(1)
                keep[some] |= close.any(0)
        return rows.select(["p", "x"]).filter(pa.array(keep))

    placed = star.select("p", "x").unionByName(star.select("p", F.col("p").alias("x")).distinct())
    placed = placed.join(places, "x") if places is not None else placed.withColumns({"c": F.col("x"), "root": F.col("x")})
    sizes = placed.groupBy("p", "root").agg(F.count("*").alias("m")).groupBy("p").agg(F.sum("m").alias("m"), F.max("m").alias("most"))
    sizes = materialise(sizes.select("p", (F.col("m") * (F.col("m") - F.col("most")) <= min(FAMILY, SKETCHED) ** 2).alias("fits")), "family-sizes")
    mine = blobs.select(F.col("doc_id").alias("x"), "sketch", (F.length("shingles") / 8).cast("bigint").alias("n"))
    near = placed.join(sizes.where("fits"), "p").join(mine, "x").select("p", "x", "c", "root", "n", "sketch").groupBy("p").applyInArrow(run, "p bigint, x bigint").where("p <> x")
    return near.unionByName(star.join(sizes.where("NOT fits"), "p").select("p", "x"))


def group_members(rows: DataFrame) -> DataFrame:
    """(key, p, size, doc_id) from rows (key, doc_id). Groups of one vanish; extremes and counts are combined before the shuffle."""
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("p"), F.max("doc_id").alias("last"), F.count("*").alias("size"))
    groups = materialise(groups.where("p < last").select("key", "p", "size"), "groups")
    return materialise(rows.join(groups, "key"), "members")


def group_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (p, x) to check: those of small groups, and those of the others' pivots. Of members with places (c, root) those pairs of small groups are left out that agree in one of them."""
    star = members.where(F.col("size") > DIRECT).where("doc_id <> p").select("p", F.col("doc_id").alias("x"))
    own = F.struct("doc_id", *[c for c in ("c", "root") if c in members.columns])
    whole = members.where(F.col("size") <= DIRECT).groupBy("key").agg(F.collect_set(own).alias("all"))

    def meets(p):
        pair = p["doc_id"] < F.col("x.doc_id")
        return pair & (p["c"] != F.col("x.c")) & (p["root"] != F.col("x.root")) if "c" in members.columns else pair

    pairs = whole.select("all", F.explode("all").alias("x")).select("x", F.explode(F.filter("all", meets)).alias("p"))
    return pairs.select(F.col("p.doc_id").alias("p"), F.col("x.doc_id").alias("x")).distinct(), star.distinct()


def comparable(pairs: DataFrame, nodes: DataFrame, like: Similarity) -> DataFrame:
    """The pairs of nodes whose sizes alone do not rule a link out."""
    sized = pairs.join(nodes.select(F.col("node").alias("x"), F.col("n").alias("n_x")), "x").join(nodes.select(F.col("node").alias("p"), F.col("n").alias("n_p")), "p")
    return sized.where(like.den * F.least("n_x", "n_p") >= like.num * F.greatest("n_x", "n_p")).select("p", "x")


def check_pairs(pairs: DataFrame, blobs: DataFrame, like: Similarity, differences: bool) -> DataFrame:
    """p, x, linked, n (of x) of the pairs, and the shingles in which x differs from p: those x adds, then those it lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, PAIRS_AT_ONCE):
                batch = whole.slice(low, PAIRS_AT_ONCE)
                linked, sizes, found = [], [], []
                for mine, theirs in zip(batch.column("mine"), batch.column("theirs")):
                    x, p = (np.frombuffer(v.as_buffer(), np.uint64) for v in (mine, theirs))
                    at = np.minimum(np.searchsorted(p, x), max(0, len(p) - 1))
                    inside = p[at] == x if len(p) else np.zeros(len(x), bool)
                    linked.append(like.linked(int(inside.sum()), len(x), len(p)))
                    sizes.append(len(x))
                    if differences:
                        lacks = np.ones(len(p), bool)
                        lacks[at[inside]] = False
                        found.append(np.concatenate([x[~inside], mix(p[lacks])]).tobytes())
                columns = [batch.column("p"), batch.column("x"), pa.array(linked, pa.bool_()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found if differences else [None] * len(linked), pa.binary())], ["p", "x", "linked", "n", "differs"])
        give_back()

    mine = blobs.select(F.col("doc_id").alias("x"), F.col("shingles").alias("mine"))
    theirs = blobs.select(F.col("doc_id").alias("p"), F.col("shingles").alias("theirs"))
    joined = pairs.join(mine, "x").join(theirs, "p").select("p", "x", "mine", "theirs")
    return joined.mapInArrow(run, "p bigint, x bigint, linked boolean, n bigint, differs binary")


def family_links(members: DataFrame, like: Similarity) -> DataFrame:
    """(p, x): links that connect the members of each family (p, key) as their pairs' similarity does.

    The members' differences from the pivot are a 0/1 matrix, taken some columns at a time; its product with itself counts what two members share.
    """

    def run(rows: pa.Table) -> pa.Table:
        ids, n = rows["x"].to_numpy(), rows["n"].to_numpy()
        loose = np.flatnonzero(~rows["linked"].to_numpy(zero_copy_only=False))
        raw = [np.frombuffer(v.as_buffer(), np.uint64) for v in rows["differs"]]
        size = np.array([len(v) for v in raw])
        shingle, column = np.unique(np.concatenate(raw), return_inverse=True)
        owner = np.repeat(np.arange(len(raw)), size)
        count = np.bincount(column, minlength=len(shingle))
        asked = np.zeros(len(shingle), bool)
        asked[column[np.isin(owner, loose)]] = True
        taken = ((count > 1) & asked)[column]
        owner, column = owner[taken], column[taken]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        # Columns of few members are counted pair by pair, the others as products of matrices.
        often = (count.astype(np.int64) ** 2 * 64 > len(loose) * len(ids))[column]
        places, common_column = np.unique(column[often], return_inverse=True)
        common_owner, (owner, column) = owner[often], (owner[~often], column[~often])
        edge = np.searchsorted(column, column, side="left"), np.searchsorted(column, column, side="right")
        order = np.argsort(owner, kind="stable")
        row_edge = np.searchsorted(owner[order], np.arange(len(ids) + 1))
        root, step = np.arange(len(ids)), max(1, CELLS // len(ids))
        for top in range(0, len(loose), step):
            block = loose[top : top + step]
            both = np.zeros((len(block), len(ids)), np.float32)
            for low in range(0, len(places), step):
                a, b = np.searchsorted(common_column, (low, low + step))
                part = np.zeros((len(ids), min(step, len(places) - low)), np.float32)
                part[common_owner[a:b], common_column[a:b] - low] = 1
                both += part[block] @ part.T
            for i, member in enumerate(block):
                entry = order[row_edge[member] : row_edge[member + 1]]
                if len(entry):
                    first, more = edge[0][entry], edge[1][entry] - edge[0][entry]
                    at = np.arange(more.sum()) + np.repeat(first - np.cumsum(more) + more, more)
                    both[i] += np.bincount(owner[at], minlength=len(ids))
            apart = size[block][:, None] + size[None, :] - 2 * both.astype(np.int64)
            total = n[block][:, None] + n[None, :]
            common = (total - apart) // 2
            one, other = np.nonzero((like.den * common >= like.num * (total - common)) & (common > 0))
            one, other = root[block[one]], root[other]
            while len(one := one[(differ := one != other)]):  # each member comes to the first one that links reach
                other = other[differ]
                hook = np.arange(len(ids))
                np.minimum.at(hook, np.maximum(one, other), np.minimum(one, other))
                while (hook != (further := hook[hook])).any():
                    hook = further
                root, one, other = hook[root], hook[one], hook[other]
        own = root != np.arange(len(ids))
        return pa.table({"p": pa.array(ids[root[own]], pa.int64()), "x": pa.array(ids[own], pa.int64())})

    return members.select("p", "key", "x", "linked", "n", "differs").groupBy("p", "key").applyInArrow(run, "p bigint, x bigint")


def family_parts(members: DataFrame, like: Similarity) -> DataFrame:
    """The members of families, once for each of the first k + 1 shingles in which they differ from the pivot, with that as new key."""
    names = ["p", "x", "linked", "n", "differs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (p, n, differs) in enumerate(zip(batch.column("p").to_pylist(), batch.column("n").to_pylist(), batch.column("differs"))):
                head = np.frombuffer(differs.as_buffer(), np.uint64)[: int(like.differ(n + n * like.den // like.num)) + 1]
                keys = mix(head ^ mix(np.array([p], np.int64).view(np.uint64)))
                again = pa.array(np.full(len(keys), i))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(again) for c in names], _signed(keys)], [*names, "key"])

    return members.select(*names).mapInArrow(run, "p bigint, x bigint, linked boolean, n bigint, differs binary, key bigint")


def _split(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of the families that have a member not linked to the pivot: those that fit one task, and the others."""
    sizes = members.groupBy("p", "key").agg(F.count("*").alias("m"), F.sum(F.length("differs")).alias("bytes"), F.bool_and("linked").alias("all")).where("m > 1 AND NOT all")
    sizes = materialise(sizes.select("p", "key", ((F.col("m") <= FAMILY) & (F.col("bytes") <= FAMILY_BYTES)).alias("fits")), "families")
    own = members.join(sizes, ["p", "key"])
    return own.where("fits"), own.where("NOT fits")


def centre_links(members: DataFrame, blobs: DataFrame, like: Similarity) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (p, x) of the documents of one centre, the groups that are left, and the places (x, c, root) of their members.

    A document's centre c is the pivot of most of its groups, so a family that meets in many groups is compared once. Groups whose documents have one centre, or are connected already, are done;
    in the others only documents with different centres and roots are left to compare.
    """
    spark = members.sparkSession
    shared = members.groupBy(F.col("doc_id").alias("x"), "p").agg(F.count("*").alias("groups"))
    own = materialise(shared.groupBy("x").agg(F.min_by("p", F.struct(-F.col("groups"), F.col("p"))).alias("c")), "centres")
    star = materialise(close_members(own.where("x <> c").select(F.col("c").alias("p"), "x"), blobs, like), "centre-members")
    release_shuffles(spark)
    found = materialise(check_pairs(star, blobs, like, True), "centre-differences")
    release_shuffles(spark)
    links, rows = differing_links(found.withColumn("key", F.lit(0).cast("bigint")), like)
    links = materialise(links.unionByName(found.where("linked").select("p", "x")), "centre-links")
    roots = components(links.select(F.col("p").alias("a"), F.col("x").alias("b")))
    places = own.join(roots.withColumnRenamed("node", "x"), "x", "left").select("x", "c", F.coalesce("root", "x").alias("root"))
    groups = members.select("key", "p", "size", "doc_id")
    if rows is not None:
        # Of a family that is cut further all members are compared.
        again = group_members(rows)
        groups = groups.unionByName(again.select("key", "p", "size", "doc_id"))
        places = places.join(again.select(F.col("doc_id").alias("x")).distinct().withColumn("cut", F.lit(True)), "x", "left").select("x", F.when(F.col("cut"), F.col("x")).otherwise(F.col("c")).alias("c"), "root")
    places = materialise(places, "places")
    placed = groups.join(places, F.col("doc_id") == F.col("x"))
    mixed = placed.groupBy("key").agg(F.min("c").alias("c"), F.max("c").alias("c2"), F.min("root").alias("root"), F.max("root").alias("root2")).where("c < c2 AND root < root2").select("key")
    left = materialise(placed.join(materialise(mixed, "mixed-groups"), "key").select("key", "p", "size", "doc_id", "c", "root"), "mixed-members")
    release_shuffles(spark)
    return links, left, places


def differing_links(family: DataFrame, like: Similarity) -> tuple[DataFrame, DataFrame | None]:
    """Links (p, x) in the families (p, key) of rows as ``check_pairs`` gives them, and the rows (key, doc_id) of groups that no task can compare, if there are any."""
    fits, large = _split(family)
    links = materialise(family_links(fits, like), "family-links")
    parts = materialise(family_parts(large, like), "family-parts")
    if not parts.limit(1).count():
        return links, None
    fits, large = _split(parts)
    links = links.unionByName(materialise(family_links(fits, like), "family-links"))
    rows = materialise(large.select("key", F.col("x").alias("doc_id")), "next-groups")
    return links, rows if rows.limit(1).count() else None


def group_links(members: DataFrame, nodes: DataFrame, given: DataFrame, like: Similarity, sparing: bool = False) -> DataFrame:
    """Links (p, x) that connect the documents of all groups (key, p, size, doc_id) as the similarity of their pairs does.

    ``p`` is the smallest document of the group; ``nodes`` has a row (n, node) for each different set, ``given`` the texts (doc_id, text).
    ``sparing`` first compares the documents with one centre each (``centre_links``), which leaves fewer pairs of sets to shuffle for a few more steps.
    """
    spark = given.sparkSession
    links, checked, blobs, places = None, None, None, None
    if sparing:
        members = members.join(nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
        ids = materialise(members.select("doc_id").distinct(), "pair-ids")
        blobs = materialise(set_blobs(given.join(ids, "doc_id", "left_semi"), like), "set-blobs")
        links, members, places = centre_links(members, blobs, like)
        if not members.limit(1).count():
            return links
    while True:
        small, star = group_pairs(members)
        # A pivot's pairs stay whole: a member of another size than the pivot's may be linked with other members.
        small = materialise(comparable(small, nodes, like), "pairs")
        star = star.join(nodes.select(F.col("node").alias("x")), "x", "left_semi")
        star = materialise(star if checked is None else star.join(checked.select("p", "x"), ["p", "x"], "left_anti"), "star-pairs")
        if blobs is None:
            ids = materialise(small.unionByName(star).select(F.explode(F.array("p", "x")).alias("doc_id")).distinct(), "pair-ids")
            blobs = materialise(set_blobs(given.join(ids, "doc_id", "left_semi"), like), "set-blobs")
        small = materialise(close_pairs(small, blobs, like), "close-pairs")
        star = materialise(close_members(star, blobs, like, checked, places), "close-members")
        places = None
        release_shuffles(spark)
        found = materialise(check_pairs(small, blobs, like, False).where("linked").select("p", "x"), "found")
        links = found if links is None else links.unionByName(found)
        release_shuffles(spark)
        now = materialise(check_pairs(star, blobs, like, True), "checked")
        links = links.unionByName(now.where("linked").select("p", "x"))
        # All members so far of the pivots that met new ones.
        checked = now if checked is None else checked.unionByName(now)
        family = checked.join(materialise(now.select("p").distinct(), "met"), "p", "left_semi").withColumn("key", F.lit(0).cast("bigint"))
        more, rows = differing_links(family, like)
        links = links.unionByName(more)
        if rows is None:
            return links
        members = group_members(rows)


def candidates(given: DataFrame, keys: DataFrame, nodes: DataFrame, like: Similarity) -> DataFrame:
    """The rows (doc_id, text) that links between different sets may have: the smallest document of each set with enough shingles that other documents have, too."""
    total = keys.agg(F.sum("n")).first()[0] or 0
    ids = mostly_shared(given, like, total).join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    ids = materialise(ids, "candidate-ids")
    release_shuffles(given.sparkSession)
    near = materialise(given.join(ids, "doc_id", "left_semi"), "candidates")
    release_shuffles(given.sparkSession)
    return near


def similar_sets(docs: DataFrame, shingle: int = 3, num: int = 90, den: int = 100, sparing: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; the smallest doc_id that links of Jaccard similarity num / den or more reach. ``sparing`` is that of ``group_links``."""
    like = Similarity(shingle, num, den)
    given, nameless = identified(texts(docs))
    keys = materialise(set_keys(given, like), "set-keys")
    nodes = materialise(keys.where("n > 0").groupBy("n", "a", "b").agg(F.min("doc_id").alias("node")), "nodes")
    near = candidates(given, keys, nodes, like)
    members = signature_members(near, like)
    release_shuffles(docs.sparkSession)
    links = group_links(members, nodes, near, like, sparing)
    roots = components(links.select(F.col("p").alias("a"), F.col("x").alias("b")))
    named = keys.join(nodes, ["n", "a", "b"], "left")
    named = named.join(roots, "node", "left")
    own = F.coalesce("root", "node", "doc_id")
    return named.select(
        F.when(F.col("doc_id") < nameless, F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), F.when(own < nameless, own).alias("component_id")
    )


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"))
