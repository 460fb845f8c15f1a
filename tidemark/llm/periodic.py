"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

The suffix array, its inverse (ISA) and the longest common prefixes (LCP) of each text are held as arrays. An LCP interval of
depth d is the set of suffixes that share their first d words and no more; it is found from the nearest smaller LCP values, without
nodes of a tree. A square ww with |w| = d that cannot be rotated to the right is a pair of suffixes i and i + d in different
children of one such interval: the suffixes of all children but the largest are tested, each for its neighbours i + d and
i - d, by looking whether their ISA lies in the interval. The square is then rotated to the left as long as words agree, and
the squares that meet in this way are one run. A square whose two neighbours to the left, i - d and i - 2d, lie in the interval
too belongs to a run of at least four periods. Work per text: n log n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidemark.llm import suffixes as s
from tidemark.llm import words as w
from tidemark.llm.shared import ship

PERIODS = 4  # the least exponent of a run
LEAST = 6  # its least length in words
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _intervals(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """Children of the LCP intervals of four suffixes or more: interval's first and end slot, depth, child's first and end slot.

    The largest child of each interval is left out, the first of them if several are.
    """
    places = np.flatnonzero(lcp > 0)
    low, high = s.nearest_below(lcp, places)
    wide = high - low >= PERIODS
    places, low, high = places[wide], low[wide], high[wide]
    order = np.lexsort((places, high, low))
    places, low, high = places[order], low[order], high[order]
    if not len(places):
        return (places,) * 5
    opens = np.ones(len(places), dtype=bool)
    opens[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    # each boundary starts a child, and the first slot of the interval one more
    firsts = np.flatnonzero(opens)
    child = np.insert(places, firsts, low[firsts])
    number = np.cumsum(opens) - 1
    of = np.insert(number, firsts, number[firsts])
    end = np.append(child[1:], 0)
    last = np.append(np.flatnonzero(of[1:] != of[:-1]), len(of) - 1)
    end[last] = high[firsts]
    size = end - child
    heads = np.append(0, last[:-1] + 1)
    is_largest = size == np.maximum.reduceat(size, heads)[of]
    nth = np.cumsum(is_largest)
    is_largest &= nth == (nth[heads] - is_largest[heads] + 1)[of]
    keep = ~is_largest
    at = firsts[of[keep]]
    return low[at], high[at], lcp[places[at]], child[keep], end[keep]


def runs(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run of at least four periods and six words, by start, then period.

    ``codes`` are the words of texts of ``counts`` words as numbers from 1 on; starts and ends are places in ``codes``.
    """
    none = (np.zeros(0, np.int64),) * 3
    n = len(codes)
    if not n:
        return none
    start, stop = s.stops(counts)
    order, levels = s.suffix_array(codes, counts, apart=True)
    isa = np.empty(n, np.int64)
    isa[order] = np.arange(n)
    lcp = np.full(n, -1, np.int64)
    beside = np.flatnonzero(start[order[1:]] == start[order[:-1]]) + 1
    lcp[beside] = s.common(levels, order[beside - 1], order[beside], stop)
    low, high, depth, first, end = _intervals(lcp)
    sizes = end - first
    child = np.repeat(np.arange(len(sizes)), sizes)
    slot = np.arange(len(child)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[child]
    i, d = order[slot], depth[child]

    def shares(place: np.ndarray, child: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Whether the suffix at a place within [start, stop) lies in the child's interval."""
        at = isa[np.clip(place, 0, n - 1)]
        return (place >= start) & (place < stop) & (at >= low[child]) & (at < high[child])

    def in_own_child(place: np.ndarray) -> np.ndarray:
        at = isa[np.clip(place, 0, n - 1)]
        return (at >= first[child]) & (at < end[child])

    after = shares(i + d, child, start[i], stop[i]) & ~in_own_child(i + d)
    before = shares(i - d, child, start[i], stop[i]) & ~in_own_child(i - d)
    square = np.concatenate([i[after], i[before] - d[before]])
    child = np.concatenate([child[after], child[before]])
    for back in range(1, PERIODS - 1):
        far = square - back * depth[child]
        fits = shares(far, child, start[square], stop[square])
        square, child = square[fits], child[fits]
    period = depth[child]
    begin = square - s.common_before(levels, square, square + period, start[square])
    finish = square + 2 * period
    # one stretch is found with every multiple of its period; the smallest is its period
    by = np.lexsort((period, finish, begin))
    begin, finish, period = begin[by], finish[by], period[by]
    keep = np.ones(len(by), dtype=bool)
    keep[1:] = (begin[1:] != begin[:-1]) | (finish[1:] != finish[:-1])
    keep &= finish - begin >= np.maximum(LEAST, PERIODS * period)
    begin, finish, period = begin[keep], finish[keep], period[keep]
    by = np.lexsort((period, begin))
    return begin[by], finish[by], period[by]


def _of_slice(texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of words, runs and collapsed text of each text."""
    found, counts = w.stretches(texts, ~w.SPACE, lower=False)
    numbers, _ = w.coded(found)
    begin, finish, period = runs(numbers + 1, counts)
    ends = np.cumsum(counts)
    text = np.searchsorted(ends, begin, "right")
    spans = pa.StructArray.from_arrays([pa.array(c) for c in (begin - (ends - counts)[text], finish - begin, period)], fields=list(RUN))
    offsets = np.searchsorted(begin, np.append(0, ends)).astype(np.int32)
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, begin + period, 1)
    np.add.at(change, finish, -1)
    kept = np.cumsum(change)[:-1] == 0
    left = np.append(0, np.cumsum(kept))[np.append(0, ends)].astype(np.int32)
    words = found if kept.all() else found.filter(pa.array(kept))
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left), words), b" ")
    return counts, pa.ListArray.from_arrays(pa.array(offsets), spans), collapsed.cast(pa.string())


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed (the text without repeats) of every row.

    A run is a stretch of consecutive words with smallest period q, of at least 4 q and 6 words, that no neighbouring word
    extends. Words are what lies between spaces and 0x09-0x0D. The collapsed text leaves out the words that a run contains
    after its first period, and has one space between words. A null or empty text has no words and no runs; rows without an
    id keep a null id; repeated rows are texts of their own; other columns are dropped, whatever their names. An empty table
    gives none. Texts are taken whole in slices of some 1 MB, a longer one on its own; memory grows with the longest text.
    """
    ship(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in w.slices(batches, "text"):
            counts, found, collapsed = _of_slice(part["text"])
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(counts, pa.int64()), found, collapsed], names)

    names = ["doc_id", "n_words", "runs", "collapsed"]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    run = "array<struct<start: long, length: long, period: long>>"
    return rows.mapInArrow(find, f"doc_id long, n_words long, runs {run}, collapsed string")
