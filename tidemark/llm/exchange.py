"""Finding keys that several documents share, with the keys moved in packed arrays.

Millions of keys a partition (hashes of windows or of anchors) would cost more
as rows than as numbers. Here a task packs the keys of a run of documents by
bucket of the key; Spark shuffles the packs by bucket; a task that holds one
bucket sorts its keys and sends those that matter back, packed by group of
documents, where they meet the documents' texts. Every bucket and every group is
read as a stream in order, so a task holds one of them at a time, and their
number follows the measured size of the texts.

Buckets are many (a few MB each), partitions at most `most` (see Spread). Packs are
made for partitions, from runs of a million keys, so that they hold many keys
even then; a partition that stands for several buckets cuts its packs into these
and sorts them (a sort that spills) before it reads them.

Keys that documents of one run share are settled there and sent once, so a
passage that a third of all documents have reaches its bucket once a run. A key
is a 64-bit number or a KEY, which has a check beside it; equal means all of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute)
from pyspark.sql import DataFrame, functions as F

from .arrays import chunks, mix

PACK = "part int, found boolean, docs binary, counts binary, keys binary"
NAMES = ["part", "found", "docs", "counts", "keys"]
TYPES = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
TEXTS = "part int, found boolean, docs binary, counts binary, keys binary, doc long, tag long, z binary"
CHUNK = 2_000_000
KEYS_AT_ONCE = 1_000_000
PLAIN, KEY = np.dtype("<u8"), np.dtype([("hash", "<u8"), ("check", "<u2")])


class Spread(NamedTuple):
    """How keys or documents are dealt: to n buckets (or groups), several in a partition where there are more than partitions."""

    n: int
    partitions: int

    @staticmethod
    def over(n: int, most: int = 20_000) -> Spread:
        return Spread(n, min(n, most))

    def within(self, numbers: np.ndarray) -> np.ndarray:
        """Which of a partition's buckets keys are in, by their numbers."""
        return scaled(mix(numbers), -(-self.n // self.partitions))

    def bucket(self, route: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        return scaled(route, self.partitions) + self.partitions * self.within(numbers)

    def group(self, docs: np.ndarray) -> np.ndarray:
        return (mix(docs.view(np.uint64)) % np.uint64(self.n)).astype(np.int64)

    def partition(self, parts: np.ndarray) -> np.ndarray:
        """The partition of buckets or groups."""
        return parts % self.partitions


def batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def number(keys: np.ndarray) -> np.ndarray:
    return keys["hash"] if keys.dtype == KEY else keys


def key_order(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    return np.lexsort((docs, keys["check"], keys["hash"])) if keys.dtype == KEY else np.lexsort((docs, keys))


def scaled(values: np.ndarray, n: int) -> np.ndarray:
    """Numbers of 64 bits as places 0 to n - 1 of equal shares, in order."""
    return ((values >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def packed(part: np.ndarray, docs: np.ndarray, keys: np.ndarray, found: bool) -> list[tuple]:
    """A row for each part: its documents, how many keys each has, and the keys."""
    if not len(keys):
        return []
    order = np.lexsort((docs, part))
    part, docs, keys = part[order], docs[order], keys[order]
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    rows = []
    for lo, hi in zip(cut, np.r_[cut[1:], len(part)], strict=True):
        d = docs[lo:hi]
        at = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        rows.append((int(part[lo]), found, d[at].tobytes(), np.diff(np.r_[at, len(d)]).astype(np.uint32).tobytes(), keys[lo:hi].tobytes()))
    return rows


def unpacked(docs: list[bytes], counts: list[bytes], keys: list[bytes], kind: np.dtype = PLAIN) -> tuple[np.ndarray, np.ndarray]:
    d, n = np.frombuffer(b"".join(docs), np.int64), np.frombuffer(b"".join(counts), np.uint32)
    return np.repeat(d, n), np.frombuffer(b"".join(keys), kind)


def distinct(docs: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, in order of key, then document."""
    order = key_order(keys, docs)
    docs, keys = docs[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    return docs[new], keys[new]


def settle(docs: np.ndarray, keys: np.ndarray, later_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs in order of key: the first of each key, and which pairs are of a key with several: all, or those with a larger document."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[first, len(keys)])
    if later_only:
        return first, docs > np.repeat(docs[first], sizes), sizes
    return first, np.repeat(sizes > 1, sizes), sizes


def dealt(packs: DataFrame, to: Spread, split: Callable, *then) -> DataFrame:
    """packs at the partitions of their part, sorted by part, then `then`; packs of a partition with several parts are split first.

    split(rows) makes rows with their parts of packs' rows; rows with text (z) or already found keys stay as they are.
    """
    sent = packs.repartitionById(to.partitions, "part")
    if to.n > to.partitions:
        names, found, z = packs.columns, packs.columns.index("found"), packs.columns.index("z") if "z" in packs.columns else None

        def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for b in batches:
                whole = b.column(z).is_valid() if z is not None else b.column(found)
                yield b.filter(whole)
                rest = b.filter(pa.compute.invert(whole))
                held += zip(*(c.to_pylist() for c in rest.columns), strict=True)
                size += rest.nbytes
                if size > 16_000_000:
                    yield batch(split(held), names, b.schema.types)
                    held, size = [], 0
                kinds = b.schema.types
            if held:
                yield batch(split(held), names, kinds)

        sent = sent.mapInArrow(refine, packs.schema)
    return sent.sortWithinPartitions("part", *then)


def shared_keys(docs: DataFrame, doc: str, text: str, keys_of: Callable, to: Spread, later_only: bool, chunk: int = CHUNK, kind: np.dtype = PLAIN) -> DataFrame:
    """Packs for groups of documents of the keys that a document shares.

    keys_of(bytes, offsets) gives (row, key, route) arrays for a run of texts; a
    key's route, any 64-bit number of its own, leads it to its partition.
    later_only: only keys that also a smaller document has; else keys with two occurrences anywhere.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])

        def close():
            of, keys, route = (np.concatenate(x) for x in held)
            for x in held:
                x.clear()
            order = key_order(keys, of)
            of, keys, route = of[order], keys[order], route[order]
            if later_only:
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
                of, keys, route = of[new], keys[new], route[new]
            first, known, _ = settle(of, keys, later_only)
            out = packed(to.partition(to.bucket(route[first], number(keys[first]))), of[first], keys[first], False)
            if known.any():
                d, k = distinct(of[known], keys[known])
                out += packed(np.full(len(k), int(route[0] % np.uint64(to.partitions))), d, k, True)
            return batch(out, NAMES, TYPES)

        for b in batches:
            b = b.filter(b.column(0).is_valid())
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, offsets in chunks(b.column(1), chunk):
                rows, keys, route = keys_of(data, offsets)
                if len(keys):
                    for x, y in zip(held, (ids[lo:hi][rows], keys, route), strict=True):
                        x.append(y)
                    if sum(map(len, held[1])) >= KEYS_AT_ONCE:
                        yield close()
        if held[0]:
            yield close()

    def split(rows: list[tuple]) -> list[tuple]:
        d, k = unpacked(*([r[i] for r in rows] for i in (2, 3, 4)), kind)
        part = np.repeat([r[0] for r in rows], [len(r[4]) // kind.itemsize for r in rows])
        return packed(part + to.partitions * to.within(number(k)), d, k, False)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        at = None

        def close():
            d, k = unpacked(*held, kind)
            for x in held:
                x.clear()
            order = key_order(k, d)
            d, k = d[order], k[order]
            _, known, _ = settle(d, k, later_only)
            d, k = distinct(d[known], k[known])
            return packed(to.partition(to.group(d)), d, k, True)

        for b in batches:
            for part, found, d, n, k in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if part != at and held[0]:
                    if out := close():
                        yield batch(out, NAMES, TYPES)
                at = part
                if found:
                    dd, kk = unpacked([d], [n], [k], kind)
                    yield batch(packed(to.partition(to.group(dd)), dd, kk, True), NAMES, TYPES)
                else:
                    for x, y in zip(held, (d, n, k), strict=True):
                        x.append(y)
        if held[0] and (out := close()):
            yield batch(out, NAMES, TYPES)

    sent = docs.select(doc, text).mapInArrow(send, PACK)
    return dealt(sent, to, split).mapInArrow(meet, PACK)


def with_texts(packs: DataFrame, docs: DataFrame, to: Spread, work: Callable, schema: str, kind: np.dtype = PLAIN) -> DataFrame:
    """Each text of docs (doc long, tag long, text) with the packs of its group; texts travel compressed, after these.

    packs has the columns of PACK with part = the partition of the group. work() returns
    (load, each, flush): load(pack rows) once a group, each(doc, tag, raw bytes)
    for each text, flush(force), which gives a batch of `schema` or None.
    """
    docs = docs.select("doc", "tag", "text")

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        c = zstandard.ZstdCompressor(level=1)
        for b in batches:
            ids = b.column(0)
            nulls = ids.is_null().to_numpy(zero_copy_only=False)
            part = to.group(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)).astype(np.int32)
            part[nulls] = np.arange(int(nulls.sum())) % to.n
            z = pa.array((c.compress((t.as_py() or "").encode()) for t in b.column(2)), pa.binary())
            none = pa.nulls(b.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.nulls(b.num_rows, pa.bool_()), none, none, none, ids, b.column(1), z], [*NAMES, "doc", "tag", "z"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        d = zstandard.ZstdDecompressor()
        load, each, flush = work()
        at, held, loaded = None, [], False
        for b in batches:
            cols = [b.column(i) for i in range(8)]
            for i in range(b.num_rows):
                part, found = cols[0][i].as_py(), cols[1][i].as_py()
                if part != at:
                    at, held, loaded = part, [], False
                if found is not None:
                    held.append(tuple(cols[k][i].as_py() for k in (2, 3, 4)))
                    continue
                if not loaded:
                    load(held)
                    held, loaded = [], True
                each(cols[5][i].as_py(), cols[6][i].as_py(), d.decompress(cols[7][i].as_py()))
                if (out := flush(False)) is not None:
                    yield out
        if (out := flush(True)) is not None:
            yield out

    texts = docs.mapInArrow(squeeze, TEXTS)
    none = packs.withColumns({"doc": F.lit(None).cast("long"), "tag": F.lit(None).cast("long"), "z": F.lit(None).cast("binary")})

    def split(rows: list[tuple]) -> list[tuple]:
        d, k = unpacked(*([r[i] for r in rows] for i in (2, 3, 4)), kind)
        return [(*r, None, None, None) for r in packed(to.group(d), d, k, True)]

    return dealt(none.unionByName(texts), to, split, F.col("found").asc_nulls_last()).mapInArrow(merge, schema)


class Flagged:
    """The keys of each document in the packs of a group."""

    def __init__(self, kind: np.dtype = PLAIN):
        self.kind = kind
        self.docs, self.keys = np.zeros(0, np.int64), np.zeros(0, kind)

    def load(self, held: list[tuple]) -> None:
        if not held:
            self.__init__(self.kind)
            return
        d, k = unpacked([x[0] for x in held], [x[1] for x in held], [x[2] for x in held], self.kind)
        order = np.lexsort((*((k["check"], k["hash"]) if self.kind == KEY else (k,)), d))
        self.docs, self.keys = d[order], k[order]

    def of(self, doc: int | None) -> np.ndarray:
        if doc is None:
            return self.keys[:0]
        return self.keys[np.searchsorted(self.docs, doc) : np.searchsorted(self.docs, doc, "right")]


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among sorted ones."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(number(among), number(values)), len(among) - 1)
    found = among[at] == values
    if values.dtype == KEY:  # equal hashes with other checks lie side by side
        rest = np.flatnonzero(~found & (number(among)[at] == number(values)))
        if len(rest):
            known = set(among.tolist())
            found[rest] = [v in known for v in values[rest].tolist()]
    return found
