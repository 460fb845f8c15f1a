"""N-gram Jaccard join: documents whose sets of word shingles have a Jaccard similarity of 0.8 or more.

The join, ``linked_documents``, intersects every pair that the trees leave and counts each document's links. Components
alone, ``near_duplicates``, need fewer: pairs that are already connected are left out there. Both are exact up to equal
64-bit hashes of different shingles.

1. ``shingle_rows`` turns each text into its set of shingle hashes, and keeps of it the size, a digest, a signature (a
   bitmap of four bits or more for each shingle) and the prefix keys: with all shingles in one global order, take the
   first a - ceil(0.8 a) + l(a) of a set of size a, where l(a) = 1 + a // 16. Two linked sets have l(a) or l(b) of these
   in common, whichever is less. The order puts frequent shingles last. How frequent one is comes from a table of counts
   of fixed size over the whole corpus; any order gives the same links.
2. Equal sets are one node from here on.
3. Nodes with a common key form a cell around the smallest of them. A node stays in its cells if so many of its keys are
   shared as a link needs (a partner has at least 0.8 a shingles); chance meetings on a few keys end here. A pair of linked
   nodes shares a cell.
4. A cell is joined by a signature tree: its nodes hold the OR of the bitmaps below them and ranges of set sizes, and a
   dual traversal leaves out pairs of nodes whose sizes are too far apart or whose common bits are too few for the
   overlap that a link needs. First on signatures alone, to see which documents have any possible partner; then on the
   whole sets of those, where every surviving pair is intersected (for components alone: unless its documents are
   already connected). A pair of several cells counts in the smallest of them.
5. Cells of more than CHUNK nodes are joined in chunks of that size, each together with the node in their middle. Then
   pairs of chunks are joined (for components alone: what is still unconnected between them), in the same two steps.
6. Components of the links, by alternating stars.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.components import components
from tidemark.llm.shared import partitions, ship, written

SHINGLE = 5
CELL_BITS = 22  # counts in the table of shingle frequencies
BLOCK = 1 << 16  # counts in one row of it
WAITING = 2_000_000  # shingles that are counted at a time
CHUNK = 2_000
LEAF, FAN = 16, 8
WANTED_BITS = 8 << 20  # of the bitmap that tells which texts are read again; a false hit costs time only
MIX = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xFF51AFD7ED558CCD)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * SPREAD
    return h ^ (h >> np.uint64(29))


def shingle_hashes(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles of the texts in order, and how many each text has, repeats included.

    A text with fewer words than ``size`` has one, its whole sequence; one without words has none.
    """
    found, counts = w.words(texts)
    numbers, distinct = w.coded(found)
    known = np.array([xxhash.xxh3_64_intdigest(x) for x in distinct.to_pylist()], dtype=np.uint64)
    hashed = known[numbers] if len(numbers) else known
    ends = np.cumsum(counts)
    begins = ends - counts
    width = np.minimum(counts, size)
    n = np.where(counts > 0, counts - width + 1, 0)
    starts = np.repeat(begins - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    widths = np.repeat(width, n)
    h = widths.astype(np.uint64)
    for i in range(size):
        if len(counts) and counts[counts > 0].min(initial=size) >= size:
            h = mixed(h * MIX + hashed[starts + i])
        else:
            inside = widths > i
            h[inside] = mixed(h[inside] * MIX + hashed[starts[inside] + i])
    return h, n


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, in order."""
    h, n = shingle_hashes(texts, size)
    for part in np.split(h, np.cumsum(n)[:-1]) if len(n) else []:
        yield np.unique(part)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Bitmap of at least four bits a shingle; a bit's place is the hash modulo the width, a power of two."""
    bits = 1 << max(8, int(4 * len(hashes) - 1).bit_length())
    out = np.zeros(bits, dtype=np.uint8)
    out[(hashes & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def frequency_levels(docs: DataFrame, size: int) -> np.ndarray:
    """Of each cell of the hash space: 0 for a usual number of shingles, then one more for each doubling of it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, waiting, size_of_waiting = np.zeros(1 << CELL_BITS, dtype=np.int64), [], 0
        for batch in w.slices(batches, "text"):
            h, _ = shingle_hashes(batch["text"], size)
            waiting.append((h >> np.uint64(64 - CELL_BITS)).astype(np.int32))
            size_of_waiting += len(h)
            if size_of_waiting > WAITING:
                cells += np.bincount(np.concatenate(waiting), minlength=len(cells))
                waiting, size_of_waiting = [], 0
        if waiting:
            cells += np.bincount(np.concatenate(waiting), minlength=len(cells))
        blocks = [zlib.compress(b.tobytes(), 1) for b in cells.reshape(-1, BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array(blocks)], ["block", "part"])

    def total(block: pa.Table) -> pa.Table:
        cells = sum(np.frombuffer(zlib.decompress(x.as_py()), np.int64) for x in block["part"])
        level = np.ceil(2 * np.log2(1 + cells)).astype(np.uint8)
        return pa.table({"block": block["block"][:1], "level": [zlib.compress(level.tobytes())], "n": [int(cells.sum())]})

    counts = docs.select("text").mapInArrow(count, "block int, part binary")
    rows = counts.groupBy("block").applyInArrow(total, "block int, level binary, n long").collect()  # one a block
    out = np.zeros(1 << CELL_BITS, dtype=np.uint8)
    for row in rows:
        out[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(zlib.decompress(row.level), np.uint8)
    usual = 2 * np.log2(16 + 4 * sum(row.n for row in rows) / len(out))
    return np.ceil(np.maximum(0, out - usual) / 2).astype(np.uint8)


def shared_keys(sizes):
    """Common prefix keys that two sets need for a link, if the smaller one has this size."""
    return 1 + sizes // 16


def prefix(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the global order: by level, then by hash."""
    level = levels[(hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64)
    order = np.argsort((level << np.uint64(58)) | (hashes >> np.uint64(6)), kind="stable")
    n = len(hashes)
    return hashes[order[: n - (4 * n + 4) // 5 + shared_keys(n)]]


ROWS = "doc_id long, n long, digest binary, keys binary, frequent binary, signature binary"


def shingle_rows(docs: DataFrame, size: int) -> DataFrame:
    levels = docs.sparkSession.sparkContext.broadcast(frequency_levels(docs, size))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = levels.value
        for batch in w.slices(batches, "text"):
            out: list[list] = [[] for _ in range(5)]
            for h in _sets(batch["text"], size):
                keys = prefix(h, level_of) if len(h) else h
                often = level_of[(keys >> np.uint64(64 - CELL_BITS)).astype(np.int64)] > 0
                values = (len(h), _digest(h), keys[~often].tobytes(), keys[often].tobytes(), signature(h).tobytes())
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), *[pa.binary()] * 4]
            arrays = [batch["doc_id"], *[pa.array(v, t) for v, t in zip(out, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "digest", "keys", "frequent", "signature"])

    return docs.mapInArrow(rows, ROWS)


def _cells(reps: DataFrame) -> DataFrame:
    """Distinct (cell, node): nodes that share a key belong to the cell of the smallest of them, if they share enough.

    Usual keys travel packed, in rows of a hash bucket, and are sorted there. Frequent ones, of which one may occur in a
    third of all sets, go the plain way: smallest node by key, combined before the shuffle, and a join that Spark can
    split.
    """
    spark = reps.sparkSession
    buckets = partitions(spark, 4)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch["node"].to_numpy()
            keys = [np.frombuffer(k.as_py(), np.uint64) for k in batch["keys"]]
            key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            node = np.repeat(np.arange(len(nodes), dtype=np.int32), [len(k) for k in keys])
            bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            key, node = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)[order], node[order]
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = [b for b in range(buckets) if edges[b] < edges[b + 1]]
            part = [slice(edges[b], edges[b + 1]) for b in full]
            uniq = [np.unique(node[s], return_inverse=True) for s in part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(full, pa.int32()),
                    pa.array([key[s].tobytes() for s in part], pa.binary()),
                    pa.array([u[1].astype(np.int32).tobytes() for u in uniq], pa.binary()),
                    pa.array([nodes[u[0]].tobytes() for u in uniq], pa.binary()),
                ],
                ["bucket", "keys", "places", "nodes"],
            )

    def meet(bucket: pa.Table) -> pa.Table:
        # a usual key that differs in its upper bits only costs a needless cell, never a link
        keys = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in bucket["keys"]])
        nodes = np.concatenate(
            [
                np.frombuffer(n.as_py(), np.int64)[np.frombuffer(p.as_py(), np.int32)]
                for p, n in zip(bucket["places"], bucket["nodes"], strict=True)
            ]
        )
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        length = np.diff(np.append(first, len(keys)))
        cell, shared = np.repeat(nodes[first], length), np.repeat(length > 1, length)
        pairs, n = np.unique(np.stack([cell[shared], nodes[shared]]), axis=1, return_counts=True)
        return pa.table({"cell": pairs[0], "node": pairs[1], "keys": n})

    packed = (
        reps.select("node", "keys")
        .mapInArrow(deal, "bucket int, keys binary, places binary, nodes binary")
        .groupBy("bucket")
        .applyInArrow(meet, "cell long, node long, keys long")
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.frombuffer(k.as_py(), np.int64) for k in batch["frequent"]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys) if keys else [], pa.int64()),
                    pa.array(np.repeat(batch["node"].to_numpy(), [len(k) for k in keys]), pa.int64()),
                ],
                ["key", "node"],
            )

    often = reps.where(F.octet_length("frequent") > 0).select("node", "frequent").mapInArrow(unpack, "key long, node long")
    often = written(often, "frequent-keys")
    middle = written(
        often.groupBy("key").agg(F.min("node").alias("cell"), F.count("*").alias("n")).where("n > 1").drop("n"), "middles"
    )
    hot = often.join(middle, "key").select("cell", "node", F.lit(1).cast("long").alias("keys"))
    met = packed.union(hot).groupBy("cell", "node").agg(F.sum("keys").alias("keys"))
    met = written(met, "meetings")
    enough = met.groupBy("node").agg(F.sum("keys").alias("keys")).join(reps.select("node", "n"), "node")
    enough = enough.where(F.col("keys") >= shared_keys_of((4 * F.col("n") + 4) / 5)).select("node")
    cells = written(met.select("cell", "node").join(enough, "node"), "members")
    several = cells.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1").select("cell")
    return written(cells.join(several, "cell").select("cell", "node"), "cells")


def shared_keys_of(size: Column) -> Column:
    return 1 + F.floor(F.floor(size) / 16)


# --- trees -----------------------------------------------------------------------------------------------------------


def fold(maps: np.ndarray) -> np.ndarray:
    """Bitmaps of half the width."""
    half = maps.shape[1] // 2
    return maps[:, :half] | maps[:, half:]


class Tree:
    """Levels of nodes over documents sorted by set size; a node covers a range of the level below."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, maps: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        self.ids, self.sizes, self.maps = ids[order], sizes[order], maps[order]
        self.excess = self.sizes - np.bitwise_count(self.maps).sum(axis=1, dtype=np.int64)  # shingles on a taken bit
        self.levels = [self._over(np.arange(0, len(ids), LEAF), self.maps, self.sizes, self.sizes, self.excess)]
        while len(self.levels[-1][0]) > 1:
            _, maps, low, high, excess = self.levels[-1]
            self.levels.append(self._over(np.arange(0, len(maps), FAN), maps, low, high, excess))

    @staticmethod
    def _over(at, maps, low, high, excess):
        return (
            at,
            np.bitwise_or.reduceat(maps, at, axis=0),
            np.minimum.reduceat(low, at),
            np.maximum.reduceat(high, at),
            np.maximum.reduceat(excess, at),
        )

    def below(self, level: int, node: int) -> range:
        at, below = self.levels[level][0], len(self.levels[level - 1][0]) if level else len(self.ids)
        return range(at[node], at[node + 1] if node + 1 < len(at) else below)


def _possible(map_a, low_a, high_a, excess_a, map_b, low_b, high_b, excess_b):
    """Whether sets of these sizes and bitmaps can reach the overlap: 100 common >= 80 union, so 9 common >= 4 (a + b)."""
    common = np.bitwise_count(map_a & map_b).sum(axis=-1, dtype=np.int64) + np.minimum(excess_a, excess_b)
    return (5 * high_b >= 4 * low_a) & (5 * high_a >= 4 * low_b) & (9 * common >= 4 * (low_a + low_b))


def traverse(a: Tree, b: Tree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of documents in a and b, pair by pair of leaves that may hold a link; of a tree with itself, each once."""
    same = a is b
    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        if la < 0 and lb < 0:
            yield np.array(a.below(0, i)), np.array(b.below(0, j))
            continue
        # open the higher node, or both of a tree with itself
        lefts = a.below(la, i) if la >= lb and la > 0 else [i]
        rights = b.below(lb, j) if lb >= la and lb > 0 else [j]
        next_a = la - 1 if la >= lb and la > 0 else la
        next_b = lb - 1 if lb >= la and lb > 0 else lb
        if la == 0 and lb == 0:
            yield np.array(a.below(0, i)), np.array(b.below(0, j))
            continue
        right = np.array(rights)
        _, maps, low, high, excess = b.levels[next_b]
        for x in lefts:
            _, ma, loa, hia, exa = a.levels[next_a]
            fits = _possible(ma[x], loa[x], hia[x], exa[x], maps[right], low[right], high[right], excess[right])
            if same:
                fits &= right >= x
            stack.extend((next_a, x, next_b, int(y)) for y in right[fits])


def trees_to_join(ids: np.ndarray, sizes: np.ndarray, maps: list[np.ndarray]) -> Iterator[tuple[Tree, Tree]]:
    """Pairs of trees that may hold links: documents of one width of bitmap, and those of the next width, folded."""
    widths = np.array([len(m) for m in maps])
    by_width = {int(x): np.flatnonzero(widths == x) for x in np.unique(widths)}
    for width, at in by_width.items():
        own = np.stack([maps[i] for i in at])
        tree = Tree(ids[at], sizes[at], own)
        yield tree, tree
        if (wider := by_width.get(2 * width)) is not None:
            yield tree, Tree(ids[wider], sizes[wider], fold(np.stack([maps[i] for i in wider])))


class Groups:
    """Which documents of a cell are known to be connected."""

    def __init__(self, known: np.ndarray):
        self.of = np.unique(known, return_inverse=True)[1]

    def join(self, x: int, y: int) -> None:
        self.of[self.of == self.of[y]] = self.of[x]


def pairs_of(a: Tree, b: Tree, sides: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each pair of leaves: the documents of both and the matrix of pairs that may be linked."""
    for left, right in traverse(a, b):
        fits = _possible(
            a.maps[left][:, None], a.sizes[left][:, None], a.sizes[left][:, None], a.excess[left][:, None],
            b.maps[right][None], b.sizes[right][None], b.sizes[right][None], b.excess[right][None],
        )
        x, y = a.ids[left], b.ids[right]
        other = (sides[x][:, None] != sides[y][None]) | (sides[x][:, None] < 0)
        if a is b:
            other &= left[:, None] < right[None]
        yield x, y, fits & other


def hopeful(sizes: np.ndarray, maps: list[np.ndarray], known: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Which documents may be linked to one that they are not yet connected with."""
    out = np.zeros(len(sizes), dtype=bool)
    for a, b in trees_to_join(np.arange(len(sizes)), sizes, maps):
        for x, y, fits in pairs_of(a, b, sides):
            if out[x].all() and out[y].all():
                continue
            fits &= known[x][:, None] != known[y][None]
            out[x] |= fits.any(axis=1)
            out[y] |= fits.any(axis=0)
    return out


def links_of(sets: list[np.ndarray], known: np.ndarray, sides: np.ndarray, middle: int) -> list[tuple[int, int]]:
    """Links that connect the documents of a cell as far as they are connected at all.

    The document in the middle (-1: none) is compared first, which connects most of a family in one go.
    """
    sizes, groups, out = np.array([len(s) for s in sets]), Groups(known), []

    def linked(x: int, y: int) -> None:
        common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        if 9 * common >= 4 * (sizes[x] + sizes[y]):
            groups.join(x, y)
            out.append((x, y))

    if middle >= 0:
        for y in np.flatnonzero((5 * sizes >= 4 * sizes[middle]) & (4 * sizes <= 5 * sizes[middle])):
            if groups.of[y] != groups.of[middle]:
                linked(middle, y)
    for a, b in trees_to_join(np.arange(len(sets)), sizes, [signature(s) for s in sets]):
        for x, y, fits in pairs_of(a, b, sides):
            for i, j in zip(*np.nonzero(fits & (groups.of[x][:, None] != groups.of[y][None])), strict=True):
                if groups.of[x[i]] != groups.of[y[j]]:
                    linked(int(x[i]), int(y[j]))
    return out


class Packed:
    """Sets of 64-bit numbers, flat, to compare one with many."""

    def __init__(self, sets: list[np.ndarray]):
        self.lengths = np.array([len(x) for x in sets], dtype=np.int64)
        self.ends = np.cumsum(self.lengths)
        numbers, codes = np.unique(np.concatenate(sets), return_inverse=True)
        self.codes, self.marks = codes, np.zeros(len(numbers), dtype=bool)

    def of(self, x: int) -> np.ndarray:
        return self.codes[self.ends[x] - self.lengths[x] : self.ends[x]]

    def common(self, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
        """Of each of ``xs`` and each of ``ys``, how many numbers they have in common."""
        codes = np.concatenate([self.of(y) for y in ys])
        edges = np.concatenate([[0], np.cumsum(self.lengths[ys])])
        out = np.zeros((len(xs), len(ys)), dtype=np.int64)
        for i, x in enumerate(xs):
            self.marks[self.of(x)] = True
            out[i] = np.diff(np.concatenate([[0], np.cumsum(self.marks[codes])])[edges])
            self.marks[self.of(x)] = False
        return out


def all_links(
    sets: list[np.ndarray], sides: np.ndarray, cells: list[np.ndarray], cell: int, rows: np.ndarray
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect the documents of a cell, and how many rows each document is linked with, by all its links.

    ``cells`` has all cells of each document. A pair counts in the smallest that it shares. ``rows`` is how many rows a
    document stands for.
    """
    whole, below = Packed(sets), Packed([c[c < cell] for c in cells])
    sizes, groups = whole.lengths, Groups(np.arange(len(sets)))
    found, out = np.zeros(len(sets), dtype=np.int64), []
    for a, b in trees_to_join(np.arange(len(sets)), sizes, [signature(s) for s in sets]):
        for x, y, fits in pairs_of(a, b, sides):
            left, right = np.flatnonzero(fits.any(axis=1)), np.flatnonzero(fits.any(axis=0))
            if not len(left):
                continue
            x, y, fits = x[left], y[right], fits[np.ix_(left, right)]
            linked = fits & (9 * whole.common(x, y) >= 4 * (sizes[x][:, None] + sizes[y][None]))
            for i, j in zip(*np.nonzero(linked & (groups.of[x][:, None] != groups.of[y][None])), strict=True):
                if groups.of[x[i]] != groups.of[y[j]]:
                    groups.join(int(x[i]), int(y[j]))
                    out.append((int(x[i]), int(y[j])))
            linked &= below.common(x, y) == 0
            found[x] += linked @ rows[y]
            found[y] += rows[x] @ linked  # each pair once: of a leaf with itself only a triangle is left
    return out, found


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after the other, from rows sorted by cell."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not len(table):
            continue
        part = table["part"].to_numpy()
        edges = np.flatnonzero(part[1:] != part[:-1]) + 1
        for start, stop in zip([0, *edges[:-1]], edges, strict=False):
            yield table.slice(start, stop - start)
        rest = table.slice(edges[-1] if len(edges) else 0)
    if rest is not None and len(rest):
        yield rest


MEMBERS = "part long, cell long, node long, known long, side int"


def join_cells(
    members: DataFrame, reps: DataFrame, docs: DataFrame, size: int, homes: DataFrame | None = None
) -> DataFrame:
    """Links (a, b) found among the members of each part, given what is known to be connected already.

    With ``homes`` (node, cells, rows) every link is counted: the links here are those that connect the same documents
    (n is 0), and rows (a, a, n) say that the documents linked with a have n rows.
    """

    every = homes is not None

    def arrays(cell: pa.Table):
        return cell["node"].to_numpy(), cell["known"].to_numpy(), cell["side"].to_numpy()

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _by_cell(batches):
            _, known, sides = arrays(cell)
            maps = [np.frombuffer(x.as_py(), np.uint64) for x in cell["signature"]]
            keep = hopeful(cell["n"].to_numpy(), maps, known, sides)
            if keep.any():
                yield from cell.filter(pa.array(keep)).drop_columns(["n", "signature"]).to_batches()

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _by_cell(batches):
            node, known, sides = arrays(cell)
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in cell["hashes"]]
            middle = np.flatnonzero(node == cell["cell"][0].as_py())
            if not every:
                found = links_of(sets, known, sides, int(middle[0]) if len(middle) and (sides < 0).all() else -1)
                n = np.zeros(0, np.int64)
            else:
                own = [np.sort(np.array(x.as_py(), np.int64)) for x in cell["cells"]]
                found, n = all_links(sets, sides, own, cell["cell"][0].as_py(), cell["rows"].to_numpy())
            counted = np.flatnonzero(n)
            a = np.concatenate([node[[x for x, _ in found]], node[counted]])
            b = np.concatenate([node[[y for _, y in found]], node[counted]])
            n = np.concatenate([np.zeros(len(found), np.int64), n[counted]])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"])

    signed = members.hint("merge").join(reps.select("node", "n", "signature"), "node")
    signed = signed.select(*[x.split()[0] for x in MEMBERS.split(", ")], "n", "signature")
    left = signed.repartition("part").sortWithinPartitions("part").mapInArrow(filtered, MEMBERS)
    left = written(left, "hopeful")
    names = reps.select("node", "doc_id", "digest")
    wanted = written(left.select("node").distinct().join(names, "node"), "wanted")
    # the sets are dealt out by digest once; the few columns of the members come to them
    more = ["cells", "rows"] if every else []
    named = wanted.select("node", "digest")
    named = named.join(homes, "node") if every else named
    named = left.join(named, "node").hint("merge")
    whole = named.join(shingle_sets(docs, wanted, size), "digest").select(*left.columns, *more, "hashes")
    links = whole.repartition("part").sortWithinPartitions("part").mapInArrow(exact, "a long, b long, n long")
    return written(links, "links")


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The whole sets (digest, hashes) of the wanted nodes, made again from their texts.

    A bitmap of fixed size over the wanted ids keeps most other texts from being split.
    """

    def place(df: DataFrame) -> DataFrame:
        return df.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(WANTED_BITS)))

    marks = (
        place(wanted)
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("marks"))
    )  # at most WANTED_BITS / 32768 rows of 4 KB

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in w.slices(batches, "text"):
            sets = list(_sets(batch["text"], size))
            arrays = [batch["doc_id"], pa.array(map(_digest, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "digest", "hashes"])

    position = F.bitmap_bit_position("place")
    marked = place(docs).withColumn("bucket", F.bitmap_bucket_number("place")).join(F.broadcast(marks), "bucket")
    marked = marked.withColumn("position", position).where(
        "(cast(conv(hex(substring(marks, cast(position div 8 as int) + 1, 1)), 16, 10) as int)"
        " >> cast(position % 8 as int)) & 1 = 1"
    )
    again = marked.select("doc_id", "text").mapInArrow(rows, "doc_id long, digest binary, hashes binary")
    found = again.join(wanted.hint("merge").withColumnRenamed("doc_id", "id"), "digest").where(F.col("doc_id").eqNullSafe(F.col("id")))
    return found.select("digest", "hashes").dropDuplicates(["digest"])


def _chunked(cells: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Members of the first round, and the members (cell, node, chunk, chunks) of cells with more than one chunk."""
    large = cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
    large = written(large.select("cell", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), "large-cells")
    split = cells.join(large, "cell").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    middles = large.select("cell", F.col("cell").alias("node"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    parts = (
        cells.join(large, "cell", "left_anti").select("cell", "node", F.lit(0).alias("chunk"))
        .union(split.where("node <> cell").select("cell", "node", "chunk"))
        .union(middles)
    )
    first = parts.select(
        F.xxhash64("cell", "chunk").alias("part"), "cell", "node", F.col("node").alias("known"), F.lit(-1).alias("side")
    )
    return first, split


def _between_chunks(split: DataFrame, known: DataFrame) -> DataFrame:
    """Members of pairs of chunks of one cell, without those that are already connected with the whole other chunk."""
    split = split.join(known.withColumnRenamed("component", "known"), "node", "left")
    split = written(split.withColumn("known", F.coalesce("known", "node")), "split-cells")
    chunks = written(
        split.groupBy("cell", "chunk").agg(F.min("known").alias("low"), F.max("known").alias("high")), "chunks"
    ).withColumnRenamed("chunk", "other")
    # a cell has few chunks, and each of its documents meets each of them
    met = split.join(chunks, "cell").where("chunk <> other and not (low = high and low = known)")
    return met.select(
        F.xxhash64("cell", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("part"),
        "cell", "node", "known", (F.col("chunk") > F.col("other")).cast("int").alias("side"),
    )


def _all_between_chunks(split: DataFrame) -> DataFrame:
    """Members of all pairs of chunks of one cell. The node in the middle has met all chunks and has no part in them."""
    split = split.where("node <> cell").select("cell", "node", "chunk", "chunks")
    met = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("chunk <> other")
    return met.select(
        F.xxhash64("cell", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("part"),
        "cell", "node", F.col("node").alias("known"), (F.col("chunk") > F.col("other")).cast("int").alias("side"),
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, chunk: int = CHUNK
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable by links, itself included).

    Null texts are empty; documents without words are linked with nothing, not even with each other. A null id is never
    the smallest. Rows repeated with one id are documents of their own. An empty table gives an empty result.
    """
    return _linked(docs, id_col, text_col, size, chunk, False).drop("n_links")


def linked_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, chunk: int = CHUNK
) -> DataFrame:
    """``near_duplicates`` with n_links: how many other rows have a similarity of 0.8 or more, copies included.

    Every link is intersected and counted. A row without words has none.
    """
    return _linked(docs, id_col, text_col, size, chunk, True)


def _linked(docs: DataFrame, id_col: str, text_col: str, size: int, chunk: int, every: bool) -> DataFrame:
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(shingle_rows(docs, size).withColumn("row", F.monotonically_increasing_id()), "shingles")
    classes = rows.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("rows")
    )
    classes = written(classes, "classes")
    reps = rows.join(classes.hint("merge").select(F.col("node").alias("row")), "row").withColumnRenamed("row", "node")
    reps = written(reps.select("node", "doc_id", "n", "digest", "keys", "frequent", "signature"), "nodes")

    cells = _cells(reps)
    first, split = _chunked(cells, chunk)
    homes = None
    if every:
        homes = cells.groupBy("node").agg(F.collect_list("cell").alias("cells")).join(classes.select("node", "rows"), "node")
    links = join_cells(first, reps, docs, size, homes)
    if not split.isEmpty():
        between = _all_between_chunks(split) if every else _between_chunks(split, components(links))
        links = links.union(join_cells(between, reps, docs, size, homes))
    graph = written(components(links), "components")
    smallest = written(
        graph.join(classes, "node").groupBy("component").agg(F.min("least").alias("component_id")), "smallest"
    )
    labels = classes.join(graph, "node", "left").join(smallest, "component", "left")
    counted = links.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    labels = labels.join(counted, "node", "left")
    n_links = F.col("rows") - 1 + F.coalesce("n", F.lit(0))
    component = F.coalesce("component_id", "least").alias("component_id")
    labels = written(labels.select("digest", component, n_links.alias("n_links")), "labels")
    bare = rows.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    linked = bare.where("n_shingles > 0").join(labels, "digest").select("doc_id", "n_shingles", "component_id", "n_links")
    alone = bare.where("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "n_links": F.lit(0).cast("long")})
    alone = alone.select("doc_id", "n_shingles", "component_id", "n_links")
    return linked.union(alone)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that are linked to a smaller id, with all their columns as they are.

    Of each component the document with the smallest id stays. Rows that share an id stay or go together: they stay if
    one of them does. Rows without an id go only if they are all linked to rows with one.
    """
    found = near_duplicates(docs, id_col, text_col)
    stays = F.max(F.col("component_id").eqNullSafe(F.col("doc_id")).cast("int"))
    gone = written(found.groupBy("doc_id").agg(stays.alias("stays")).where("stays = 0").select("doc_id"), "linked")
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(every.alias("row"), F.col(id_col).cast("long").alias("own_id"))
    return rows.join(gone, F.col("own_id").eqNullSafe(F.col("doc_id")), "left_anti").select("row.*")
