"""Ranked lexical search the other way round: documents stream through an inverted index over the items' terms.

The index has, for each term of any item, the items that hold it. It is small and broadcast; documents never are indexed.
A first pass counts, for each document, its terms and the occurrences of the index's terms, and writes these counts; from them come
the number of documents that hold a term and the corpus totals. A second pass sends each document's term counts through the index,
adds up its score for every item that shares a term, and keeps for each item the best k documents so far (a bounded heap); the
heaps of all tasks are merged at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.blocks import BLOCK_BYTES, text_blocks
from tidemark.llm.shared import ship, written

FLAT, SLOPE = 10, 90  # per cent of the length norm: fixed, and in proportion to the length
SATURATION = 8
MERGED = 64  # first heaps of an item to merge, each of a share of the documents
POSTINGS = 1 << 20  # score contributions worked on at a time
EXACT = float(1 << 53)  # sums below are exact in double precision


class Index:
    """Terms of the items as a sorted list, and the places of the items that hold each."""

    def __init__(self, items: list[tuple[str | None, str]]):
        self.names = [name for name, _ in items]
        found, counts = w.stretches(pa.array([text for _, text in items], pa.string()), w.TERM)
        numbers, terms = w.coded(found)
        self.terms = terms
        pairs = np.unique(numbers.astype(np.int64) << 32 | np.repeat(np.arange(len(items)), counts))
        self.items = pairs & 0xFFFFFFFF
        self.starts = np.searchsorted(pairs >> 32, np.arange(len(terms) + 1))


def _counted(texts: pa.Array, terms: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of terms of each text, and which terms of the index it holds how often."""
    found, counts = w.stretches(texts, w.TERM)
    numbers, distinct = w.coded(found)
    place = pc.fill_null(pc.index_in(distinct, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    term = place[numbers] if len(numbers) else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    known = term >= 0
    pairs, times = np.unique(text[known] << 32 | term[known], return_counts=True)
    offsets = pa.array(np.searchsorted(pairs >> 32, np.arange(len(counts) + 1)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(c.astype(np.int32))) for c in (pairs & 0xFFFFFFFF, times)]
    return counts, *lists


def term_counts(docs: DataFrame, index: Index) -> DataFrame:
    """doc_id, n_terms and, for the terms of the index that occur, terms and times, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(index.terms.to_pylist())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(shared.value, pa.binary())
        for part in w.slices(batches, "text"):
            counts, held, times = _counted(part["text"], terms)
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(counts, pa.int64()), held, times], names)

    names = ["doc_id", "n_terms", "terms", "times"]
    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_terms long, terms array<int>, times array<int>")


def document_frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term of the index: summed in each task, then over the tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch["terms"].flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    sums = counted.select("terms").mapInArrow(add, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(n_terms, np.int64)
    for row in sums.toLocalIterator():  # at most one row for each term of the index
        out[row.term] = row.df
    return out


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


class Heaps:
    """The best k documents of each item so far: highest score first, then smallest id, a null id last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.zeros(n_items, np.int64)  # score of the k-th
        self.held: tuple[np.ndarray, ...] = (np.zeros(0, np.int64),) * 4

    def add(self, item: np.ndarray, score: np.ndarray, no_id: np.ndarray, doc_id: np.ndarray) -> None:
        hopeful = (score > 0) & (score >= self.least[item])
        new = [c[hopeful] for c in (item, score, no_id, doc_id)]
        if not len(new[0]):
            return
        item, score, no_id, doc_id = (np.concatenate(c) for c in zip(self.held, new, strict=True))
        order = np.lexsort((doc_id, no_id, -score, item))
        in_order = item[order]
        rank = np.arange(len(order)) - np.searchsorted(in_order, in_order)
        best, last = order[rank < self.k], order[rank == self.k - 1]
        self.held = tuple(c[best] for c in (item, score, no_id, doc_id))
        self.least[item[last]] = score[last]


def _scored(
    n_terms: np.ndarray, text: np.ndarray, term: np.ndarray, times: np.ndarray, index: Index, weight: np.ndarray, n_docs: int,
    total: int,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, item, score) of every pair that shares a term; whole texts at a time, texts in ascending order."""
    norm = 100 - SLOPE + (SLOPE * n_terms * n_docs) // max(total, 1)
    share = (1_000_000_000 * times) // (1000 * times + SATURATION * norm[text])
    worth = weight[term] * share
    each = index.starts[term + 1] - index.starts[term]
    n_items = len(index.names)
    ends = np.cumsum(each)
    start = 0
    while start < len(term):
        # cut between texts, after some POSTINGS contributions
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + POSTINGS, "right"))
        stop = int(np.searchsorted(text, text[max(stop - 1, start)], "right"))
        part = slice(start, stop)
        width = each[part]
        places = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        item = index.items[np.repeat(index.starts[term[part]], width) + places]
        base = int(text[start])
        cell = np.repeat(text[part] - base, width) * n_items + item
        cells, score = _sums(cell, np.repeat(worth[part], width))
        yield cells // n_items + base, cells % n_items, score
        start = stop


def _sums(cell: np.ndarray, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells and the sum of each, in whole numbers."""
    size = int(cell.max(initial=-1)) + 1
    cells, place = None, cell
    if size > 4 * len(cell):
        cells, place = np.unique(cell, return_inverse=True)
        size = len(cells)
    if float(worth.max(initial=0)) * len(worth) < EXACT:
        score = np.bincount(place, weights=worth, minlength=size).astype(np.int64)
    else:
        score = np.zeros(size, np.int64)
        np.add.at(score, place, worth)
    if cells is not None:
        return cells, score
    cells = np.flatnonzero(score)
    return cells, score[cells]


def _best(counted: DataFrame, index: Index, weight: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """item, doc_id, score: the heaps of all tasks."""
    shared = counted.sparkSession.sparkContext.broadcast((index, weight))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight = shared.value
        heaps = Heaps(len(index.names), k)
        for batch in batches:
            doc_id = batch["doc_id"]
            no_id = doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = pc.fill_null(doc_id, 0).to_numpy(zero_copy_only=False)
            n_terms = batch["n_terms"].to_numpy(zero_copy_only=False)
            held = batch["terms"]
            text = np.repeat(np.arange(batch.num_rows), pc.list_value_length(held).to_numpy(zero_copy_only=False))
            term, times = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (held, batch["times"]))
            for of, item, score in _scored(n_terms, text, term, times, index, weight, n_docs, total):
                heaps.add(item, score, no_id[of], ids[of])
        item, score, no_id, ids = heaps.held
        columns = [pa.array(item), pa.array(ids, mask=no_id > 0), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return counted.mapInArrow(search, "item long, doc_id long, score long")


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    """The best k of all heaps of an item, with their rank; in two steps, so that no task gets the heaps of all tasks."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    share = F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGED))
    for group in (["item", share], ["item"]):
        heaps = heaps.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)
    return heaps


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
    most: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the k best documents of each item with a score above 0; item_id as text.

    Terms are runs of letters and digits (a-z, 0-9 and all beyond ASCII) after lower-casing A-Z. Equal scores go by ascending
    doc_id, null ids last, and among rows with one id by no rule, as they are equal then. Null and empty texts have no terms and are
    no part of the counts. Repeated document rows are documents each. Repeated items count once; different texts under one id
    are items each. Empty tables give no rows; other columns do not matter. The items' text is broadcast in blocks of some
    ``most`` bytes; each block is a search of its own over all documents. Scores are whole numbers of 64 bits.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    items = items.select(items[item_col].alias("id"), items[text_col].alias("text"))
    out = None
    for block in text_blocks(items, most):
        found = _ranked_block(spark, docs, Index(block), k)
        out = found if out is None else out.unionByName(found)
    return out


def _ranked_block(spark: SparkSession, docs: DataFrame, index: Index, k: int) -> DataFrame:
    counted = written(term_counts(docs, index), "term-counts")
    totals = counted.agg(F.count(F.when(F.col("n_terms") > 0, True)).alias("docs"), F.sum("n_terms").alias("terms")).first()
    weight = weights(document_frequencies(counted, len(index.terms)), totals.docs)
    best = _merged(_best(counted, index, weight, totals.docs, totals.terms or 0, k), k)
    names = spark.createDataFrame(list(enumerate(index.names)), "item long, item_id string")  # as many as the block has items
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
