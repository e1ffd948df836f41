"""Counting quotient filters over packed n-grams of word ids, in numpy: lossless, sorted and mergeable.

An n-gram of b-bit word ids is a pair (first, rest) of b and (n - 1)b bits, so ids may
have up to 31 bits. An invertible permutation turns it into an even key: rest is
multiplied and shifted, then first is covered by a hash of rest. The top bits of the key are its quotient, which is stored
only as a unary run length; all other bits are stored as the remainder. Nothing is
lost: keys come back from their places, and n-grams from keys.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from .arrays import mix

ODD, OTHER_ODD = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


class Counts(NamedTuple):
    """Sorted different keys (high, low) with their counts."""

    high: np.ndarray
    low: np.ndarray
    count: np.ndarray


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permuted(first: np.ndarray, rest: np.ndarray, b: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (high of b bits, low of width bits) of n-grams (first, rest)."""
    mask, half = _mask(width), np.uint64((width + 1) // 2)
    low = (rest * np.uint64(ODD)) & mask
    low ^= low >> half
    low = (low * np.uint64(OTHER_ODD)) & mask
    return first ^ (mix(low) & _mask(b)), low


def restored(high: np.ndarray, low: np.ndarray, b: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of keys: permuted() backwards."""
    mask, half = _mask(width), np.uint64((width + 1) // 2)
    first = high ^ (mix(low) & _mask(b))
    rest = (low * np.uint64(pow(OTHER_ODD, -1, 1 << 64))) & mask
    rest ^= rest >> half
    return first, (rest * np.uint64(pow(ODD, -1, 1 << 64))) & mask


def merged(parts: list[Counts], b: int, width: int) -> Counts:
    """One sorted list of keys from several, counts of equal keys added. Sorted parts are runs to the stable sort."""
    high, low, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(high):
        return Counts(high, low, count)
    if b + width <= 64:
        key = (high << np.uint64(width)) | low
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.r_[True, key[1:] != key[:-1]]
    else:
        order = np.lexsort((low, high))
        fresh = np.r_[True, (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])]
    at = np.flatnonzero(fresh)
    return Counts(high[order][at], low[order][at], np.add.reduceat(count[order], at))


def _planes(x: np.ndarray, bits: int) -> bytes:
    """The lowest `bits` bits of each number, byte plane by byte plane."""
    return b"".join((x >> np.uint64(8 * k)).astype(np.uint8).tobytes() for k in range(-(-bits // 8)))


def _of_planes(data: memoryview, m: int, bits: int) -> np.ndarray:
    x = np.zeros(m, np.uint64)
    for k in range(-(-bits // 8)):
        x |= np.frombuffer(data[k * m : (k + 1) * m], np.uint8).astype(np.uint64) << np.uint64(8 * k)
    return x


def packed(c: Counts, b: int, width: int) -> bytes:
    """A filter's bytes: sizes, run lengths in unary, remainders, one-byte counters, then the counts that need more."""
    m = len(c.high)
    q = min(b, max(m, 1).bit_length())
    r = b - q
    runs = np.zeros(m + (1 << q), np.uint8)
    runs[(c.high >> np.uint64(r)).astype(np.int64) + np.arange(m)] = 1  # a one for each key, a zero ends a quotient
    small = np.minimum(c.count, 255).astype(np.uint8)
    large = c.count[small == 255].astype(np.int64).tobytes()
    sizes = np.array([m, q], np.int64).tobytes()
    return sizes + np.packbits(runs).tobytes() + _planes(c.high & _mask(r), r) + _planes(c.low, width) + small.tobytes() + large


def unpacked(data: bytes, b: int, width: int) -> Counts:
    m, q = (int(x) for x in np.frombuffer(data[:16], np.int64))
    view, r, at = memoryview(data), b - q, 16
    size = -(-(m + (1 << q)) // 8)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(view[at : at + size], np.uint8)))
    high = (ones - np.arange(m)).astype(np.uint64) << np.uint64(r)
    at += size
    high |= _of_planes(view[at:], m, r)
    at += m * -(-r // 8)
    low = _of_planes(view[at:], m, width)
    at += m * -(-width // 8)
    count = np.frombuffer(view[at : at + m], np.uint8).astype(np.int64)
    count[count == 255] = np.frombuffer(view[at + m :], np.int64)
    return Counts(high, low, count)
