"""Splitting a column of texts into words with array operations, without a Python loop over words.

A word is a longest run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SLICE_BYTES = 1 << 20  # of text in one step, whose arrays take some thirty times as much; a longer text is a step of its own


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offsets at which each begins, plus the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = texts.type in (pa.large_string(), pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32) if len(texts) else np.zeros(1, np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some SLICE_BYTES of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch[column]), 0).cast(pa.int64())).to_numpy()
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def pieces(data: np.ndarray, offsets: np.ndarray, begins: np.ndarray, keep: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Pieces of the kept bytes that start where ``begins`` is set, and the number of pieces of each text."""
    starts = np.flatnonzero(begins)
    kept = np.cumsum(keep, dtype=np.int32)
    ends = np.append(kept[starts] - keep[starts], kept[-1:] if len(kept) else 0).astype(np.int32)
    found = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[keep]))]
    )
    return found, np.diff(np.searchsorted(starts, offsets))


def text_starts(offsets: np.ndarray, size: int) -> np.ndarray:
    first = np.zeros(size, dtype=bool)
    first[offsets[:-1][offsets[:-1] < size]] = True
    return first


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts in order, and how many each text has."""
    data, offsets = text_bytes(texts)
    keep = ~SPACE[data]
    begins = keep.copy()
    begins[1:] &= ~keep[:-1]
    begins |= keep & text_starts(offsets, len(data))
    return pieces(LOWER[data], offsets, begins, keep)


def coded(found: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the words and the distinct words that they stand for."""
    encoded = found.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def listed(words: pa.Array) -> list[bytes]:
    """The words as Python objects; ``to_pylist`` makes one more of Arrow's for each."""
    return words.to_numpy(zero_copy_only=False).tolist()


TERM = np.zeros(256, dtype=bool)  # bytes of letters, digits and everything beyond ASCII, once lower-cased
TERM[48:58] = TERM[97:123] = TERM[128:] = True


def stretches(texts: pa.Array, kept: np.ndarray, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The longest runs of ``kept`` bytes of all texts in order, and how many each text has."""
    data, offsets = text_bytes(texts)
    data = LOWER[data] if lower else data
    keep = kept[data]
    begins = keep.copy()
    begins[1:] &= ~keep[:-1]
    begins |= keep & text_starts(offsets, len(data))
    return pieces(data, offsets, begins, keep)
