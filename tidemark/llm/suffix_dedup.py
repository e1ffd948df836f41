"""Suffix-array dedup: removes every byte in a string of `length` bytes that starts anywhere else too.

Routing. A suffix array of everything in one place does not scale, and shards
of documents would have to be compared pair by pair. So regions are dealt to
shards by content: the anchor of a window (of `length` bytes) is its leftmost
least `gram`-byte hash, so equal windows have equal anchors. Anchors that occur
once need no more work (shared_keys counts them, in packs). For the others,
each document cuts the stretch of its text that the anchor's windows cover, and
the stretches are shuffled by anchor; equal windows always meet in one bucket.
Where a passage is so common that an anchor's stretches, each with other text
around it, would be `hot_bytes` or more, its windows are routed one by one by
their own hashes: those that occur once drop out in the count of keys, and each
task sends one copy of a window, however many documents have it. Which anchors
are hot is estimated from one text in `sample` and all long ones; this decides
the routes only, which are the same in every task, not the result.

Shards. A bucket's stretches that are byte for byte equal collapse (all their
windows repeat). The rest fill shards of at most `shard_bytes`. Each shard gets
its suffix array (Larsson-Sadakane) and Kasai prefixes, which show its own
repeated windows, and the shards of a bucket are merged by binary search of
each one's windows in the others' arrays. Repeated windows go back to their
documents as intervals, which are cut from the whole texts.

Everything is judged on the input and compared byte by byte; hashes only route.
Null text is empty, and texts below `length` bytes are kept whole. Documents
are told apart by a 64-bit hash of doc_id and text; where a second hash shows
that two share it, these get other numbers. Rows equal in both get the same
answer and are repeats of each other; null doc_id is a value like any, and rows
with one doc_id and several texts are as many documents. An empty table gives an
empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrays import BYTE_BASE, chunks, mix, powers, prefix, rolled
from .common import parts, text_bytes
from .exchange import CHUNK, NAMES, PACK, TYPES, Flagged, Spread, batch, dealt, member, packed, shared_keys, with_texts
from .suffix_arrays import eights, found_in, kasai, suffix_array

LOW = np.uint64((1 << 24) - 1)
SLICE = 1 << 23
HOT_RUNS = 4_000
LONG_TEXT = 1_000_000
STRETCHES = "part int, found boolean, docs binary, starts binary, counts binary, keys binary, sizes binary, bytes binary"
STRETCH_NAMES = ["part", "found", "docs", "starts", "counts", "keys", "sizes", "bytes"]
STRETCH_TYPES = [pa.int32(), pa.bool_(), *[pa.binary()] * 6]
RESULT = "row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: the first window of each, how many, and the anchor's hash. Windows stay within a text."""
    out, owner = [[], [], []], np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for lo in range(0, max(1, len(data) - length + 1), SLICE):
        piece = data[lo : lo + SLICE + length - 1]
        n = len(piece) - length + 1
        if n <= 0:
            continue
        sums = prefix(piece.astype(np.uint64) + np.uint64(1), BYTE_BASE)
        hashes = mix((sums[gram:] - sums[:-gram]) * powers(BYTE_BASE, len(sums))[1][: len(sums) - gram])
        places = np.arange(len(hashes), dtype=np.uint64)
        least = hashes & ~LOW | places
        wide = length - gram + 1
        full = np.full(-(-len(least) // wide) * wide, np.iinfo(np.uint64).max, np.uint64)
        full[: len(least)] = least
        blocks = full.reshape(-1, wide)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        of = (np.minimum(behind[:n], ahead[wide - 1 : wide - 1 + n]) & LOW).astype(np.int64)
        text = owner[lo : lo + n]
        inside = offsets[1:][text] - np.arange(lo, lo + n) >= length
        new = np.ones(n, bool)
        new[1:] = (of[1:] != of[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, n])
        ok = inside[first]
        out[0].append(first[ok] + lo), out[1].append(size[ok]), out[2].append(mix(hashes[of[first[ok]]]))  # anchors' hashes are small ones; spread them again
    kinds = (np.int64, np.int64, np.uint64)
    return tuple(np.concatenate(x) if x else np.zeros(0, k) for x, k in zip(out, kinds, strict=True))


def routes(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, hot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As anchors(), in blocks, but each window of a hot anchor (sorted hashes) is a run of its own with its own hash as the key."""
    first, size, keys = anchors(data, offsets, length, gram)
    split = member(keys, hot)
    yield first[~split], size[~split], keys[~split]
    each = lambda n: np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    for lo in range(0, int(split.sum()), HOT_RUNS):
        at, n = first[split][lo : lo + HOT_RUNS], size[split][lo : lo + HOT_RUNS]
        spans = n + length - 1
        sums = prefix(data[np.repeat(at, spans) + each(spans)].astype(np.uint64) + np.uint64(1), BYTE_BASE)
        begin = np.repeat(np.cumsum(spans) - spans, n) + each(n)
        yield np.repeat(at, n) + each(n), np.ones(n.sum(), np.int64), rolled(sums, begin, begin + length, BYTE_BASE)


def hot_anchors(docs: DataFrame, length: int, gram: int, hot_bytes: int, sample: int) -> np.ndarray:
    """Sorted hashes of the anchors whose stretches are estimated at hot_bytes or more, from one text in `sample` and all long ones."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            times = b.column(0).to_numpy(zero_copy_only=False)
            for lo, _, data, offsets in chunks(b.column(1), CHUNK // 2):
                first, size, keys = anchors(data, offsets, length, gram)
                if not len(keys):
                    continue
                each, of = np.unique(keys, return_inverse=True)
                weight = np.bincount(of, (size + length - 1) * times[lo + np.searchsorted(offsets, first, "right") - 1])
                yield pa.RecordBatch.from_arrays([pa.array(each.view(np.int64)), pa.array(weight.astype(np.int64))], ["key", "weight"])

    long_text = F.octet_length("text") >= LONG_TEXT
    some = docs.where(long_text | (F.pmod("doc", F.lit(sample)) == 0)).select(F.when(long_text, 1).otherwise(sample).cast("long").alias("times"), "text")
    heavy = some.mapInArrow(weigh, "key long, weight long").groupBy("key").agg(F.sum("weight").alias("weight")).where(F.col("weight") >= hot_bytes)
    return np.sort(np.array([k.key for k in heavy.select("key").collect()], np.int64).view(np.uint64))


def repeated_windows(stretches: list[bytes], counts: np.ndarray, length: int, shard_bytes: int) -> list[np.ndarray]:
    """For distinct stretches with `counts` window starts each: which starts have an equal window at another start."""
    shards, marks = [], []
    lo = 0
    sizes = np.array([len(s) for s in stretches])
    while lo < len(stretches):
        hi = max(lo + 1, lo + int(np.searchsorted(np.cumsum(sizes[lo:]), shard_bytes, "right")))
        data = np.frombuffer(b"".join(stretches[lo:hi]), np.uint8)
        at = np.r_[0, np.cumsum(sizes[lo:hi])[:-1]]
        starts = np.zeros(len(data), bool)
        begin, n = at, counts[lo:hi]
        starts[np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = True
        words = eights(data, length + 8)
        order = suffix_array(data, words)
        common = kasai(order, words, length)
        is_start = starts[order]
        windows = order[is_start]
        broken = np.cumsum(common < length)  # windows between which nothing breaks are equal
        same = np.diff(broken[is_start]) == 0
        again = np.zeros(len(windows), bool)
        again[1:] |= same
        again[:-1] |= same
        shards.append((words, windows, np.r_[0, np.cumsum(~same)] if len(windows) else np.zeros(0, int)))
        marks.append((again, at, n, len(data)))
        lo = hi
    for a in range(len(shards)):
        for b in range(a + 1, len(shards)):
            (words_a, windows_a, class_a), (words_b, windows_b, class_b) = shards[a], shards[b]
            one = np.flatnonzero(np.r_[True, class_a[1:] != class_a[:-1]]) if len(class_a) else np.zeros(0, int)
            hit = found_in(words_a, windows_a[one], words_b, windows_b, length)
            marks[a][0][np.isin(class_a, class_a[one[hit >= 0]])] = True
            marks[b][0][np.isin(class_b, class_b[hit[hit >= 0]])] = True
    out = []
    for (_, windows, _), (again, at, n, size) in zip(shards, marks, strict=True):
        flags = np.zeros(size, bool)
        flags[windows[again]] = True
        out += [flags[x : x + k] for x, k in zip(at, n, strict=True)]
    return out


def intervals(docs: list[int], starts: list[int], to: Spread) -> list[tuple]:
    """Packs (part, found, docs, counts, keys) of windows' starts and run lengths, a key being start << 24 | windows."""
    d, s = np.array(docs, np.int64), np.array(starts, np.uint64)
    return packed(to.partition(to.group(d)), d, s, True)


def runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, how many) of each run of set flags, at most 2**24 - 1 in one."""
    steps = np.diff(np.r_[0, flags.view(np.int8), 0])
    for lo, hi in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist(), strict=True):
        for at in range(lo, hi, int(LOW)):
            yield at, min(hi - at, int(LOW))


def stretch_packs(part: np.ndarray, docs: np.ndarray, starts: np.ndarray, keys: np.ndarray, stretches: list[bytes], length: int) -> list[tuple]:
    """A row of STRETCHES for each part."""
    by = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.r_[True, part[by][1:] != part[by][:-1]]) if len(by) else []
    rows = []
    for lo, hi in zip(edges, [*edges[1:], len(by)], strict=True):
        mine = by[lo:hi]
        held = [stretches[i] for i in mine]
        sizes = np.array([len(x) for x in held], np.int64)
        rows.append((int(part[mine[0]]), False, docs[mine].tobytes(), starts[mine].tobytes(), (sizes - length + 1).tobytes(), keys[mine].tobytes(), sizes.tobytes(), b"".join(held)))
    return rows


def split_stretches(rows: list[tuple], to: Spread, length: int) -> list[tuple]:
    """Rows of STRETCHES for the buckets of such rows' keys."""
    docs, starts, keys, sizes = (np.frombuffer(b"".join(r[i] for r in rows), kind) for i, kind in ((2, np.int64), (3, np.int64), (5, np.uint64), (6, np.int64)))
    data, ends = b"".join(r[7] for r in rows), np.cumsum(sizes)
    return stretch_packs(to.bucket(keys, keys), docs, starts, keys, [data[x - k : x] for x, k in zip(ends.tolist(), sizes.tolist(), strict=True)], length)


def row_ids(docs: DataFrame, doc_id: str, text: str, bits: int = 64) -> Column:
    """A number for each row of docs by doc_id and text: a 64-bit hash, or another one for those that share it with another row.

    Hashes that several rows share are few (none or one in 10^9 rows), so they are listed in the plan.
    """
    one, two = (F.xxhash64(F.lit(seed), F.col(doc_id).isNull(), doc_id, text) for seed in (1, 2))
    tried, shared = F.shiftright(one, 64 - bits) if bits < 64 else one, []
    while True:
        row = F.when(tried.isin(shared), two) if shared else F.lit(None).cast("long")
        row = F.coalesce(row, tried)
        clash = docs.select(row.alias("row"), two.alias("check")).groupBy("row").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo < hi")
        found = [r.row for r in clash.select("row").collect()]
        if not found:
            return row
        if not set(found) - set(shared):
            raise ValueError("two hashes of different rows agree")
        shared += found


def stretches_of(docs: DataFrame, to: Spread, length: int, gram: int, hot: np.ndarray) -> DataFrame:
    """STRETCHES of docs (doc, tag, text) for the buckets of to, and the intervals that tasks have settled."""

    def keys_of(data, offsets):
        out = []
        for first, _, keys in routes(data, offsets, length, gram, hot):
            rows = np.searchsorted(offsets, first, "right") - 1
            if out:  # of a hot window's places in one text two say that it repeats
                order = np.lexsort((rows, keys))
                rows, keys = rows[order], keys[order]
                third = np.r_[False, False, (keys[2:] == keys[:-2]) & (rows[2:] == rows[:-2])][: len(keys)]
                rows, keys = rows[~third], keys[~third]
            out.append((rows, keys))
        rows, keys = (np.concatenate(x) for x in zip(*out, strict=True))
        return rows, keys, keys

    def cut():
        flagged, held, rows, weight = Flagged(), {}, [], [0]
        settled: tuple[list, list] = ([], [])

        def settle(row, at, count):
            if settled[0] and settled[0][-1] == row and (settled[1][-1] >> 24) + (n_last := settled[1][-1] & int(LOW)) == at and n_last + count <= int(LOW):
                settled[1][-1] += count
            else:
                settled[0].append(row), settled[1].append(at << 24 | count)
                weight[0] += 100

        def each(row, _, raw):
            known = flagged.of(row)
            if not len(known):
                return
            data = np.frombuffer(raw, np.uint8)
            for first, size, keys in routes(data, np.array([0, len(data)]), length, gram, hot):
                ok = member(keys, known)
                for at, count, key in zip(first[ok].tolist(), size[ok].tolist(), keys[ok].tolist(), strict=True):
                    stretch = raw[at : at + count + length - 1]
                    if (seen := held.get((key, stretch))) is None:
                        held[key, stretch] = [row, at, False]
                        weight[0] += len(stretch) + 200
                    else:
                        if not seen[2]:
                            seen[2] = True
                            settle(seen[0], seen[1], count)
                        settle(row, at, count)

        def flush(force):
            if not held or not force and weight[0] < 24_000_000:
                return None
            keys = np.fromiter((k for k, _ in held), np.uint64, len(held))
            values = list(held.values())
            docs_, starts = (np.array([v[k] for v in values], np.int64) for k in (0, 1))
            rows = stretch_packs(to.partition(to.bucket(keys, keys)), docs_, starts, keys, [x for _, x in held], length)
            if settled[0]:
                for p, _, dd, cc, kk in intervals(settled[0], settled[1], to):
                    rows.append((p, True, dd, None, cc, kk, None, None))
            held.clear(), settled[0].clear(), settled[1].clear()
            weight[0] = 0
            return batch(rows, STRETCH_NAMES, STRETCH_TYPES)

        return flagged.load, each, flush

    packs = shared_keys(docs, "doc", "text", keys_of, to, later_only=False, chunk=CHUNK // 2)
    return with_texts(packs, docs, to, cut, STRETCHES)


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 200, gram: int = 32, bytes_per_part: int = 8_000_000, shard_bytes: int = 4_000_000, with_kept_bytes: bool = True, hot_bytes: int = 4_000_000, sample: int = 16, most_partitions: int = 20_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes (null unless with_kept_bytes)."""
    docs = docs.select(row_ids(docs, doc_id, text).alias("doc"), docs[doc_id].cast("long").alias("tag"), F.coalesce(docs[text], F.lit("")).alias("text"))
    to = Spread.over(parts(docs.sparkSession, text_bytes(docs), bytes_per_part), most_partitions)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def close():
            docs_ = np.concatenate([np.frombuffer(x[0], np.int64) for x in held])
            starts = np.concatenate([np.frombuffer(x[1], np.int64) for x in held])
            counts = np.concatenate([np.frombuffer(x[2], np.int64) for x in held])
            keys = np.concatenate([np.frombuffer(x[3], np.uint64) for x in held]).tolist()
            ends = np.cumsum(np.concatenate([np.frombuffer(x[4], np.int64) for x in held]))
            data = b"".join(x[5] for x in held)
            held.clear()
            where: dict[tuple[int, bytes], list[int]] = {}
            variants: dict[int, int] = {}
            lo = 0
            for i, (key, hi) in enumerate(zip(keys, ends.tolist(), strict=True)):
                same = where.setdefault((key, data[lo:hi]), [])
                if not same:
                    variants[key] = variants.get(key, 0) + 1
                same.append(i)
                lo = hi
            d, s = [], []

            def mark(of, first, count):
                for i in of:
                    d.append(int(docs_[i])), s.append(int(starts[i]) + first << 24 | count)

            open_ = []
            for (key, stretch), of in where.items():
                if len(of) > 1:
                    mark(of, 0, int(counts[of[0]]))
                if variants[key] > 1:
                    open_.append((stretch, of))
            if open_:
                flags = repeated_windows([x for x, _ in open_], counts[[of[0] for _, of in open_]], length, shard_bytes)
                for f, (_, of) in zip(flags, open_, strict=True):
                    if len(of) == 1:
                        for first, count in runs(f):
                            mark(of, first, count)
            return batch(intervals(d, s, to), NAMES, TYPES) if d else None

        for b in batches:
            for i in range(b.num_rows):
                part, found, *rest = (b.column(k)[i].as_py() for k in range(8))
                if part != at and held and (out := close()):
                    yield out
                at = part
                if found:
                    dd, cc, kk = rest[0], rest[2], rest[3]
                    yield batch([(part, True, dd, cc, kk)], NAMES, TYPES)
                else:
                    held.append(rest)
        if held and (out := close()):
            yield out

    def remove():
        flagged, rows = Flagged(), []

        def each(row, doc, raw):
            spans = flagged.of(row)
            keep, n_spans = raw, 0
            if len(spans):
                first, count = (spans >> np.uint64(24)).astype(np.int64), (spans & LOW).astype(np.int64)
                steps = np.zeros(len(raw) + 1, np.int64)
                np.add.at(steps, first, 1)
                np.add.at(steps, np.minimum(first + count - 1 + length, len(raw)), -1)
                gone = np.cumsum(steps[:-1]) > 0
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                keep = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            rows.append((row, doc, len(raw), len(raw) - len(keep), n_spans, hashlib.sha256(keep).hexdigest(), keep if with_kept_bytes else None))

        def flush(force):
            if not rows or not force and len(rows) < 1000:
                return None
            out = batch(rows, ["row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"], [*[pa.int64()] * 5, pa.string(), pa.binary()])
            rows.clear()
            return out

        return flagged.load, each, flush

    cuts = stretches_of(docs, to, length, gram, hot_anchors(docs, length, gram, hot_bytes, sample))
    # Settled intervals already carry their group of documents as their part and pass through.
    found = dealt(cuts, to, lambda rows: split_stretches(rows, to, length)).mapInArrow(meet, PACK)
    return with_texts(found, docs, to, remove, RESULT).drop("row")
