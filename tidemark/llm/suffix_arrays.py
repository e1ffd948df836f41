"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai prefixes, binary search."""

from __future__ import annotations

import numpy as np


def eights(data: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from each place as one big-endian number; zeros follow the data."""
    a = np.zeros(len(data) + pad + 8, np.uint64)
    a[: len(data)] = data
    for shift, step in ((8, 1), (16, 2), (32, 4)):
        a[:-step] = a[:-step] << np.uint64(shift) | a[step:]
    return a[: len(data) + pad]


def suffix_array(data: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Places in the order of the suffixes that start there; the end of the data sorts first.

    Suffixes are sorted by eight bytes; then, as Larsson and Sadakane refine,
    only groups of equal ones are sorted again, by the rank of the suffix that
    starts where the known prefix ends, which doubles the prefix each time.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    key = (eights(data, 0) if words is None else words[:n])
    order = np.argsort(key)
    ranks = np.zeros(n + 1, np.int64)  # the end of the data ranks lowest
    ordered = key[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks[order] = heads + 1
    known = 8
    alone = new & np.r_[new[1:], True]
    open_ = np.flatnonzero(~alone)
    while len(open_):
        at = order[open_]
        follow = ranks[np.minimum(at + known, n)]
        group = ranks[at]
        by = np.argsort(group.astype(np.uint64) << np.uint64(32) | follow.astype(np.uint64))
        at, group, follow = at[by], group[by], follow[by]
        order[open_] = at
        new = np.r_[True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])]
        first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        ranks[at] = open_[first] + 1
        open_ = open_[~(new & np.r_[new[1:], True])]
        known *= 2
    return order


def kasai(order: np.ndarray, words: np.ndarray, most: int, lanes: int = 4096) -> np.ndarray:
    """Common prefix (up to `most` bytes) of each suffix with the one before it in order; 0 for the first.

    Kasai's pass through the text, which keeps all but one byte of the prefix
    found one place earlier, in `lanes` stretches of the text at a time.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    by_place = np.zeros(n, np.int64)
    stretch = -(-n // min(lanes, n)) if n else 0
    at = np.arange(0, n, stretch or 1)
    h = np.zeros(len(at), np.int64)
    for t in range(stretch):
        i = at + t
        if i[-1] >= n:
            i, h = i[i < n], h[: int((i < n).sum())]
        j = before[i]
        np.maximum(h - 1, 0, out=h)
        h[j < 0] = 0
        live = np.flatnonzero((j >= 0) & (h < most))
        while len(live):
            differ = words[i[live] + h[live]] ^ words[j[live] + h[live]]
            same = differ == 0
            h[live[same]] += 8
            rest = live[~same]
            first = differ[~same]
            for bits in range(8, 64, 8):  # whole bytes that agree
                h[rest] += first < np.uint64(1 << 64 - bits)
            live = live[same]
            live = live[h[live] < most]
        by_place[i] = np.minimum(h, most)
    return by_place[order]


def compared(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
    """-1, 0 or 1 as the strings of `length` bytes (a multiple of 8) at i are less, equal or greater."""
    out, live = np.zeros(len(i), np.int8), np.arange(len(i))
    for k in range(0, length, 8):
        x, y = a[i[live] + k], b[j[live] + k]
        differ = x != y
        out[live[differ]] = np.where(x[differ] < y[differ], -1, 1)
        live = live[~differ]
        if not len(live):
            break
    return out


def found_in(a: np.ndarray, queries: np.ndarray, b: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For the strings of `length` bytes at `queries`: the first index in `order` (sorted places of b) of an equal one, or -1."""
    lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), len(order), np.int64)
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            break
        mid = (lo[live] + hi[live]) // 2
        less = compared(b, order[mid], a, queries[live], length) < 0
        lo[live[less]] = mid[less] + 1
        hi[live[~less]] = mid[~less]
    there = np.flatnonzero(lo < len(order))
    equal = np.zeros(len(queries), bool)
    equal[there] = compared(a, queries[there], b, order[lo[there]], length) == 0
    return np.where(equal, lo, -1)
