"""Vectorised text work on Arrow batches: bytes, words and rolling hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Any odd numbers; hashes are compared only with hashes made with the same ones.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
OTHER_BYTE_BASE, OTHER_WORD_BASE = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n at least; kept."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            made.append(np.multiply.accumulate(a))
        _powers[base] = (made[0], made[1])
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads each bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of values[i] * base**i modulo 2**64, one longer than values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def rolled(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp hashes of values[starts:ends], spread over 64 bits."""
    return mix((sums[ends] - sums[starts]) * powers(base, len(sums))[1][starts])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string (or binary) column and each row's offsets into them; null is empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of about `most` bytes; a longer text is a run alone."""
    data, offsets = utf8(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Words:
    """The words of a run of texts: where they start and end, the row of each, and a hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        solid = ~IS_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first = solid.copy()
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.counts = np.diff(np.searchsorted(self.starts, offsets))
        self.rows = np.repeat(np.arange(len(offsets) - 1), self.counts)
        self.data = data
        self.hashes = self.hashed(BYTE_BASE)

    def hashed(self, base: int) -> np.ndarray:
        return rolled(prefix(self.data.astype(np.uint64) + np.uint64(1), base), self.starts, self.ends, base)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of all windows of n words within a text, and the windows' hashes."""
        w = len(self.rows)
        if w < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        starts = np.flatnonzero(self.rows[: w - n + 1] == self.rows[n - 1 :])
        return starts, rolled(prefix(self.hashes, WORD_BASE), starts, starts + n, WORD_BASE)

    def other(self, starts: np.ndarray, n: int) -> np.ndarray:
        """A second hash of the windows of n words at `starts`, from other hashes of the words."""
        return rolled(prefix(self.hashed(OTHER_BYTE_BASE), OTHER_WORD_BASE), starts, starts + n, OTHER_WORD_BASE)


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of n places lie in one of the intervals [start, start + length)."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, n), -1)
    return np.cumsum(steps[:-1]) > 0


def as_table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    kept = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(kept) if kept else None
