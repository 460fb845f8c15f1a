"""Benchmark decontamination with suffix arrays of the training documents.

The words of the documents are cut into shards, whole documents of some 1 MB of text each, and every shard gets the suffix array
of its words. Each suffix of every benchmark item is binary-searched in each shard. The neighbours of the place where it
would stand give its longest verbatim match; where that is as long as a window, two more searches give the range of all
places where the window occurs. Windows that follow each other in both texts are one match: item, word in the item, word in the
document, length. Documents with a match are affected and can be removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import suffixes as s
from tidemark.llm import words as w
from tidemark.llm.blocks import BLOCK_BYTES, text_blocks
from tidemark.llm.shared import ship, written

WINDOW = 10  # words
MATCH = "item_id string, item_word long, doc_word long, length long"
KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64()]


class Items:
    """The suffixes of all items as words, and the length of the window that begins each (0: none does)."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.names = np.array([name or "" for name, _ in items], dtype=object)
        found, counts = w.stretches(pa.array([text for _, text in items], pa.string()), w.TERM)
        self.numbers, self.words = w.coded(found)
        self.of = np.repeat(np.arange(len(items)), counts)
        self.start, self.stop = s.stops(counts)
        left = self.stop - np.arange(len(self.of))
        self.window = np.minimum(window, self.stop - self.start)  # an item of fewer words is one window
        self.window[left < self.window] = 0


class Shard:
    """The words of some documents with their suffix array."""

    def __init__(self, texts: pa.Array):
        found, self.counts = w.stretches(texts, w.TERM)
        numbers, self.words = w.coded(found)
        self.codes = numbers.astype(np.int64) + 1
        self.start, self.stop = s.stops(self.counts)
        self.order, _ = s.suffix_array(self.codes, self.counts)

    def agreeing(self, query: np.ndarray, at: np.ndarray, end: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many words each query suffix [at, end) shares with the suffix in its slot, and whether that suffix is smaller."""
        there = self.order[slots]
        same = np.zeros(len(at), np.int64)
        smaller = np.zeros(len(at), dtype=bool)
        going = np.arange(len(at))
        while len(going):
            # an end is smaller than any word; a query that is used up is smaller than or equal to the suffix
            going = going[at[going] + same[going] < end[going]]
            i, j = at[going] + same[going], there[going] + same[going]
            inside = j < self.stop[there[going]]
            theirs = np.where(inside, self.codes[np.minimum(j, len(self.codes) - 1)], 0)
            smaller[going] = theirs < query[i]
            going = going[theirs == query[i]]
            same[going] += 1
        return same, smaller

    def place(self, query: np.ndarray, at: np.ndarray, end: np.ndarray, after: bool = False) -> np.ndarray:
        """The first slot whose suffix is not smaller than the query's (``after``: nor begins with it), by binary search."""
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.order))
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            same, smaller = self.agreeing(query, at[open_], end[open_], middle)
            if after:
                smaller |= same == end[open_] - at[open_]
            low[open_] = np.where(smaller, middle + 1, low[open_])
            high[open_] = np.where(smaller, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        return low

    def longest(self, query: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The length of the longest verbatim match of each query suffix in the shard."""
        place, last = self.place(query, at, end), len(self.order) - 1
        if last < 0:
            return np.zeros(len(at), np.int64)
        beside = [self.agreeing(query, at, end, np.clip(place + d, 0, last))[0] for d in (-1, 0)]
        return np.maximum(*beside)

    def matches(self, items: Items) -> tuple[np.ndarray, ...]:
        """Item, word in the item, place in the shard and length of all maximal matches of a window or more, by place."""
        known = pc.fill_null(pc.index_in(items.words, value_set=self.words), len(self.words)).to_numpy(zero_copy_only=False)
        query = known.astype(np.int64)[items.numbers] + 1 if len(items.numbers) else np.zeros(0, np.int64)
        at = np.arange(len(query))
        at = at[self.longest(query, at, items.stop) >= np.maximum(items.window, 1)]
        at = at[items.window[at] > 0]
        end = at + items.window[at]
        first, after = self.place(query, at, end), self.place(query, at, end, after=True)
        n = after - first
        at = np.repeat(at, n)
        place = self.order[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
        # windows that begin one word later in both texts continue the match
        order = np.lexsort((place, place - at, items.of[at]))
        at, place = at[order], place[order]
        opens = np.ones(len(at), dtype=bool)
        opens[1:] = (place[1:] != place[:-1] + 1) | (at[1:] != at[:-1] + 1)
        opens[1:] |= (self.start[place[1:]] != self.start[place[:-1]]) | (items.of[at[1:]] != items.of[at[:-1]])
        heads = np.flatnonzero(opens)
        length = np.diff(np.append(heads, len(at))) - 1 + items.window[at[heads]]
        at, place = at[heads], place[heads]
        order = np.lexsort((at, place))
        at, place, length = at[order], place[order], length[order]
        return items.of[at], at - items.start[at], place, length


def _of_slice(texts: pa.Array, items: Items) -> tuple[np.ndarray, pa.Array]:
    """Number of words and all matches of each text."""
    shard = Shard(texts)
    item, item_word, place, length = shard.matches(items)
    offsets = np.searchsorted(place, np.append(0, np.cumsum(shard.counts))).astype(np.int32)
    columns = [items.names[item], item_word, place - shard.start[place], length]
    arrays = [pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)]
    found = pa.StructArray.from_arrays(arrays, names=["item_id", "item_word", "doc_word", "length"])
    return shard.counts, pa.ListArray.from_arrays(pa.array(offsets), found)


def _block_matches(docs: DataFrame, block: list[tuple[str | None, str]], window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Items(block, window))
    others = [f for f in docs.schema if f.name != "text"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in w.slices(batches, "text"):
            counts, found = _of_slice(part["text"], shared.value)
            columns = [*[part[name] for name in names], pa.array(counts, pa.int64()), found]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "matches"])

    names = [f.name for f in others]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others)
    match = MATCH.replace(" ", ": ").replace(",:", ",")
    return docs.mapInArrow(search, f"{kinds}, n_words long, matches array<struct<{match}>>")


def matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", item_col: str = "item_id",
    text_col: str = "text", most: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_words, matches (item_id, item_word, doc_word, length) of every row: all maximal verbatim matches.

    A match is a stretch of consecutive words that a document shares with an item, of ``window`` words or more, or the whole item
    if that has fewer; it cannot be made longer. Words are runs of a-z, 0-9 and all beyond ASCII after lower-casing A-Z. A null
    or empty text has no words; an item without words matches nothing; an item without an id has the empty text as its id.
    Repeated rows of documents are documents each, repeated items count once. Empty tables give no rows, or rows without
    matches. Other columns do not matter. The items are broadcast in blocks of some ``most`` bytes of text; with more than one
    block the documents are numbered and written once, and the matches of the blocks are put together by that number. A
    document is searched whole: memory grows with the longest text.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    items = items.select(items[item_col].alias("id"), items[text_col].alias("text"))
    blocks = text_blocks(items, most)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        return _block_matches(docs, block, window)
    docs = written(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = _block_matches(docs, block, window)
    while following is not None:
        found = found.unionByName(_block_matches(docs, following, window))
        following = next(blocks, None)
    one = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_list("matches").alias("m"))
    return one.select("doc_id", "n_words", F.flatten("m").alias("matches"))


def hit_words(found: str = "matches") -> Column:
    """The number of a document's words that lie in any of its matches."""
    spans = F.array_sort(F.transform(found, lambda m: F.struct(m["doc_word"].alias("a"), (m["doc_word"] + m["length"]).alias("b"))))
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("n"), zero.alias("end"))
    return F.aggregate(
        spans,
        start,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["b"] - F.greatest(x["a"], acc["end"]), zero)).alias("n"), F.greatest(x["b"], acc["end"]).alias("end")
        ),
        lambda acc: acc["n"],
    )


def items_of(found: str = "matches") -> Column:
    """The ids of the items that a document holds, each once, in the order of their bytes."""
    return F.sort_array(F.array_distinct(F.transform(found, lambda m: m["item_id"])))


def clean(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without a match, with all their columns. Equal texts share their fate, so they are named by digest."""
    digest = F.sha2(docs[text_col], 256)
    found = matches(docs.select(digest.alias("doc_id"), docs[text_col].alias("text")), items.withColumnRenamed(text_col, "text"), window, item_col=item_col)
    affected = found.where(F.size("matches") > 0).select(F.col("doc_id").alias("_affected")).distinct()
    return docs.join(affected, digest == F.col("_affected"), "left_anti")
