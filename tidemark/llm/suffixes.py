"""Suffix arrays of sequences of numbers, by prefix doubling with array operations.

Sequences lie one behind the other in one array; a suffix ends where its sequence ends, and an end sorts ahead of any number.
"""

from __future__ import annotations

import numpy as np


def stops(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of sequences of these lengths, where its sequence starts and where it ends."""
    ends = np.cumsum(counts)
    return np.repeat(ends - counts, counts), np.repeat(ends, counts)


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and for each place of that order the place where its run of equal keys starts."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return order, np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


def suffix_array(codes: np.ndarray, counts: np.ndarray, apart: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes in order, and their ranks by their first 1, 2, 4, ... numbers; the last ranks hold for whole suffixes.

    ``codes`` are whole numbers from 1 on. Suffixes of equal content share a rank. With ``apart`` every sequence has an array
    of its own: its suffixes come together and equal no others. Ranks are places of the order, from 1 on. Only suffixes that
    still share their rank are sorted again when the compared length doubles.
    """
    start, stop = stops(counts)
    codes = codes.astype(np.int64)
    order, first = _dense(start << 32 | codes if apart else codes)
    rank = np.zeros(len(codes), np.int32)
    rank[order] = first + 1
    levels = [rank]
    length = 1
    slots = np.arange(len(codes))
    while True:
        # open: shares its rank and is not yet seen to its end
        shares = np.zeros(len(slots), dtype=bool)
        at = rank[order[slots]]
        shares[1:] = at[1:] == at[:-1]
        shares[:-1] |= shares[1:]
        shares &= stop[order[slots]] - order[slots] >= length
        slots = slots[shares]
        if not len(slots):
            return order, levels
        here = order[slots]
        there = here + length
        second = np.where(there < stop[here], rank[np.minimum(there, len(codes) - 1)], 0).astype(np.int64)
        by, first = _dense(rank[here].astype(np.int64) << 32 | second)
        order[slots] = here[by]
        rank = rank.copy()
        rank[order[slots]] = slots[first] + 1
        levels.append(rank)
        length *= 2


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The number of equal numbers from the places ``a`` and ``b`` on; two suffixes of one array of their own (``apart``)."""
    out = np.zeros(len(a), np.int64)
    last = len(stop) - 1
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + out, b + out
        inside = (x < stop[a]) & (y < stop[b])
        same = inside & (levels[level][np.minimum(x, last)] == levels[level][np.minimum(y, last)])
        out += same.astype(np.int64) << level
    return out


def common_before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The number of equal numbers ahead of the places ``a`` and ``b``, a < b, within the sequence of ``a``."""
    out = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x = a - out - (1 << level)
        inside = x >= start
        same = inside & (levels[level][np.maximum(x, 0)] == levels[level][np.maximum(x + b - a, 0)])
        out += same.astype(np.int64) << level
    return out


def nearest_below(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the places the nearest places before and after it with a smaller value (-1 and the size if none).

    Minima of blocks of 1, 2, 4, ... values are laid out once; each search then takes one step per block size.
    """
    n = len(values)
    minima = [values]
    while 2 << (len(minima) - 1) <= n:
        wide = 1 << (len(minima) - 1)
        minima.append(np.minimum(minima[-1][:-wide], minima[-1][wide:]))
    own = values[places]
    before, after = places.copy(), places + 1  # all values in [before, after) are no smaller
    for level in range(len(minima) - 1, -1, -1):
        wide = 1 << level
        fits = before - wide >= 0
        before -= np.where(fits & (minima[level][np.maximum(before - wide, 0)] >= own), wide, 0)
        fits = after + wide <= n
        after += np.where(fits & (minima[level][np.clip(after, 0, n - wide)] >= own), wide, 0)
    return before - 1, after
