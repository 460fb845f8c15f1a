"""Exact top-k search by inner product with block-at-a-time pruning.

A vector's components are its terms. Candidates are ordered by id and dealt into shards of consecutive ids, a shard
into blocks; a block has a forward index (its vectors as rows) and, for each term, its largest and smallest weight.
The sum over a query's terms of its weight times that extreme bounds every score in the block. Queries travel in groups.
Each query first scores the block of its highest bound, whole; then blocks are taken in descending order of the highest
bound of the group, and scored whole for the queries whose own bound still reaches their k-th best score.
Shards and groups are tables of packed arrays. Spark pairs their partitions, so a task reads some shards and some groups
where they lie: neither is copied by a shuffle or sent through the driver. A task's queries keep their best k from one
of its shards to the next, and the best k of all tasks are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import partitions, ship, written

BLOCK = 128
SHARD = 16_384
QUERIES = 2_048  # in one group
WIDTHS = (np.int16, np.int32, np.int64)
EXACT = ((np.float32, 1 << 24), (np.float64, 1 << 53))  # whole numbers below this are exact
LEAST, LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max  # score and id of a place that no candidate has


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null for a vector that is null or has a null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floors = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.when(fine, floors)


def packed(rows: DataFrame, most: int) -> DataFrame:
    """Rows (id, v) of a partition as packed rows of at most ``most`` vectors: ids, values, ends.

    Values take 16 bits each, or 32 or 64 where one of the row needs them; the others take 64. Vectors are gathered over
    the batches that Spark sends, whatever their size, so only the last row of a partition holds fewer.
    """

    def flush(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, lengths, values = (np.concatenate(c) for c in zip(*parts, strict=True))
        extremes = values.min(initial=0), values.max(initial=0)
        narrow = next(kind for kind in WIDTHS if all(np.iinfo(kind).min <= x <= np.iinfo(kind).max for x in extremes))
        columns = [c.tobytes() for c in (ids, values.astype(narrow), np.cumsum(lengths))]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], ["ids", "values", "ends"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, most - n)
                start += part.num_rows
                n += part.num_rows
                lengths = pc.list_value_length(part["v"]).to_numpy(zero_copy_only=False).astype(np.int64)
                values = part["v"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                held.append((part["id"].to_numpy(zero_copy_only=False).astype(np.int64), lengths, values))
                if n == most:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)

    return rows.select("id", "v").mapInArrow(pack, "ids binary, values binary, ends binary")


def unpacked(ids: bytes, values: bytes, ends: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors as rows; a vector shorter than the longest has 0 where it has nothing."""
    lengths = np.diff(np.frombuffer(ends, np.int64), prepend=0)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    width = len(values) // max(1, int(lengths.sum())) or 8
    out[np.arange(out.shape[1])[None] < lengths[:, None]] = np.frombuffer(values, f"i{width}")
    return np.frombuffer(ids, np.int64), out


def _reach(rows: np.ndarray) -> float:
    """The length of the longest row, rounded up."""
    return float(np.sqrt(np.square(rows.astype(np.float64)).sum(axis=1).max(initial=0))) * (1 + 1e-9)


def _kind(reach: float) -> type:
    """The cheapest type for inner products of whole numbers: no part of one exceeds the product of the two lengths."""
    return next((kind for kind, most in EXACT if reach < most), np.int64)


class Shard(NamedTuple):
    """Vectors in order of their ids; where blocks start, with their largest and smallest weights."""

    ids: np.ndarray
    vectors: np.ndarray
    block: int
    starts: np.ndarray
    high: np.ndarray
    low: np.ndarray
    reach: float


def shard_of(ids: np.ndarray, vectors: np.ndarray, block: int = BLOCK) -> Shard:
    order = np.argsort(ids, kind="stable")
    ids, vectors, starts = ids[order], vectors[order], np.arange(0, len(ids), block)
    high, low = np.maximum.reduceat(vectors, starts), np.minimum.reduceat(vectors, starts)
    return Shard(ids, vectors, block, starts, high, low, _reach(vectors))


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, exact in the type that ``_kind`` names."""
    return queries @ vectors.T


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each block, as a row, and query: a number that no score exceeds."""
    reach = _reach(queries) * (_reach(high) + _reach(low))
    if reach >= LAST:  # the sums may not fit 64 bits, though scores do
        return np.full((len(high), len(queries)), LAST)
    queries, high, low = (m.astype(_kind(reach)) for m in (queries, high, low))
    return _products(high, np.maximum(queries, 0)) + _products(low, np.minimum(queries, 0))


def take(names: np.ndarray, scores: np.ndarray, place: np.ndarray, ids: np.ndarray, found: np.ndarray) -> None:
    """Take candidates (place of the query, id, score) into the k best of each query: higher scores, then smaller ids."""
    asks, k = np.unique(place), names.shape[1]
    place = np.concatenate([np.repeat(asks, k), place])
    ids, found = np.concatenate([names[asks].ravel(), ids]), np.concatenate([scores[asks].ravel(), found])
    order = np.lexsort((ids, ~found, place))
    starts = np.flatnonzero(np.diff(place[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
    best = order[rank < k]
    names[asks], scores[asks] = ids[best].reshape(-1, k), found[best].reshape(-1, k)


def search_shard(query_ids: np.ndarray, queries: np.ndarray, shard: Shard, names: np.ndarray, scores: np.ndarray) -> None:
    """Take the candidates of a shard into ``names`` and ``scores``: the k best of each query so far, by rank."""
    width = min(queries.shape[1], shard.vectors.shape[1])  # a component that one side lacks adds nothing
    queries, vectors = queries[:, :width], shard.vectors[:, :width]
    bounds = _bounds(queries, shard.high[:, :width], shard.low[:, :width])
    kind = _kind(_reach(queries) * shard.reach)
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    kth, last = scores[:, -1].copy(), names[:, -1].copy()
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def score(b: int, asks: np.ndarray) -> None:
        """Score block ``b`` for those queries and keep what may be among their best."""
        rows = slice(shard.starts[b], shard.starts[b] + shard.block)
        found = _products(queries if len(asks) == len(queries) else queries[asks], vectors[rows])
        least = kth[asks].astype(kind)
        some = np.flatnonzero(found.max(axis=1) >= least)
        at, row = np.nonzero(found[some] >= least[some, None])
        place, ids, found = asks[some[at]], shard.ids[rows][row], found[some[at], row].astype(np.int64)
        # an equal score wins by its smaller id
        better = (ids != query_ids[place]) & ((found > kth[place]) | (ids < last[place]))
        waiting.append((place[better], ids[better], found[better]))

    def settle(least: int) -> None:
        """Take what was kept, if there is so much of it: a few at a time cost more than stale k-th scores."""
        if sum(len(place) for place, _, _ in waiting) >= least:
            take(names, scores, *(np.concatenate(c) for c in zip(*waiting, strict=True)))
            waiting.clear()
            kth[:], last[:] = scores[:, -1], names[:, -1]

    def reached(b: int) -> np.ndarray:
        """Whose bound of the block reaches the k-th score; one that equals it needs a smaller id."""
        level = kth.astype(bounds.dtype)
        return (bounds[b] > level) | ((bounds[b] == level) & (shard.ids[shard.starts[b]] < last))

    first = bounds.argmax(axis=0)
    for b in np.unique(first):
        if len(asks := np.flatnonzero((first == b) & reached(b))):
            score(b, asks)
    settle(1)
    for b in np.argsort(-bounds.max(axis=1), kind="stable"):
        if len(asks := np.flatnonzero((first != b) & reached(b))):
            score(b, asks)
            settle(4 * len(queries))
    settle(1)


def nothing_yet(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full((n, k), LAST), np.full((n, k), LEAST)


def listed(names: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the query, vector id and score, of places that a candidate has."""
    place, rank = np.nonzero((names != LAST) | (scores != LEAST))
    return place, names[place, rank], scores[place, rank]


def best_of_shard(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the query, vector id and score of the k best candidates of each query."""
    best = nothing_yet(len(query_ids), k)
    search_shard(query_ids, queries, shard_of(ids, vectors, block), *best)
    return listed(*best)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
    vector_col: str = "embedding", shard: int = SHARD,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best candidates of each query, ties to the smaller vec_id.

    Candidates are all rows with another id than the query's. Vectors that are null or hold a null or non-finite
    component, and rows without an id, take no part. A vector shorter than another counts as 0 where it has nothing.
    Rows repeated with one id are candidates each; as queries they give one answer, that of the first by its vector.
    Products of components, and scores, must fit 64 bits. Without queries or candidates the result is empty.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), whole(F.col(vector_col), scale).alias("v"), is_query.alias("asks")
    ).where("id is not null and v is not null")
    rows = written(rows, "vectors")
    # packed in order of their ids, so that a shard and its blocks are ranges of ids
    in_order = rows.repartitionByRange(partitions(rows.sparkSession), "id").sortWithinPartitions("id")
    shards = written(packed(in_order, shard), "shards")
    asked = rows.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    groups = written(packed(asked, QUERIES), "queries")
    groups = groups.select(*[F.col(c).alias(f"query_{c}") for c in groups.columns])
    # the hint keeps either side from being broadcast; a shard meets the groups of its task one after the other
    met = shards.crossJoin(groups.hint("shuffle_replicate_nl"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = [column[i].as_py() for column in batch.columns]
                if row[:3] != held:
                    held = row[:3]
                    candidates = shard_of(*unpacked(*held))
                names, queries = unpacked(*row[3:])
                if row[3] not in best:
                    best[row[3]] = nothing_yet(len(names), k)
                search_shard(names, queries, candidates, *best[row[3]])
        for names, found in best.items():
            place, *columns = listed(*found)
            columns = [np.frombuffer(names, np.int64)[place], *columns]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    found = met.mapInArrow(search, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
