"""Quality classifier: histogram gradient-boosted trees over document statistics.

One pass over the whole texts makes a row of statistics for each document. The
trees are fitted on a bounded sample of labelled rows (the `sample` rows with the
smallest hash of doc_id, ties by doc_id, label and statistics): statistics become up to `bins` quantile bins, and
each tree grows level by level on histograms of gradients of the logistic loss.
A fitted forest is three arrays (statistic, bin threshold, leaf value), and a
batch is scored by stepping all its rows down all levels at once.

Null and empty texts have zero statistics and are scored like any other. Rows
whose label is null are not learned from; with no labelled rows, or with labels
of one kind, the score is the smoothed share of label 1. Repeated doc_ids in
labels or documents are as many examples, of which the sample is taken too.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import WORD_BASE, Words, chunks, mix, prefix, rolled
from .common import bounded, stage

CHUNK = 2_000_000
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"|", b"#$%&*@^~<>{}[]\\/=+", b".,;:", b"\n", b" ", b"\"'()-_"]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of statistics for each text: sizes, shares of kinds of bytes, and repetition of words, pairs and lines."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    over = lambda x, y: x / np.maximum(y, 1)
    within = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][offsets])
    out = [np.log1p(size)]
    for kind in CLASSES:
        table = np.zeros(256, bool)
        table[list(kind)] = True
        out.append(over(within(table[data]), size))
    out.append(over(within(data >= 128), size))
    w = Words(data, offsets)
    length = w.ends - w.starts
    words = w.counts
    sums = lambda x: np.bincount(w.rows, x, n)
    mean = over(sums(length), words)
    out += [np.log1p(words), mean, np.sqrt(np.maximum(over(sums(length.astype(float) ** 2), words) - mean**2, 0)), over(sums(length <= 3), words), over(sums(length >= 12), words)]
    upper = (data[w.starts] >= 65) & (data[w.starts] <= 90) if len(data) else np.zeros(0, bool)
    last = data[w.ends - 1] if len(w.ends) else np.zeros(0, np.uint8)
    letter_end = (last >= 97) & (last <= 122) | (last >= 128)
    out += [over(sums(upper), words), over(sums(letter_end), words), over(sums(last == 46), words)]
    for rows, keys in ((w.rows, w.hashes), _pairs(w), _lines(data, offsets)):
        one, count = np.unique(mix(keys ^ mix(rows.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)[1:]
        shown = count[one]
        total = np.bincount(rows, minlength=n)
        out.append(over(np.bincount(rows, 1.0 / shown, n), total))  # share of distinct ones
        top = np.zeros(n)
        np.maximum.at(top, rows, shown)
        out.append(over(top, total))
    return np.stack(out, axis=1).astype(np.float32) if n else np.zeros((0, len(out)), np.float32)


def _pairs(w: Words) -> tuple[np.ndarray, np.ndarray]:
    starts, keys = w.windows(2)
    return w.rows[starts], keys


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.unique(np.r_[np.flatnonzero(data == 10) + 1, offsets])
    cuts = cuts[cuts <= len(data)]
    starts, ends = cuts[:-1], cuts[1:]
    rows = np.searchsorted(offsets, starts, "right") - 1
    return rows, rolled(prefix(data.astype(np.uint64) + np.uint64(1), WORD_BASE), starts, ends, WORD_BASE)


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and stats (array<float>) of each row of docs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(1), CHUNK):
                x = statistics(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), lists], ["doc_id", "stats"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, stats array<float>")


class Forest(NamedTuple):
    """Perfect binary trees of one depth, in arrays: node i has children 2i+1 and 2i+2."""

    base: float
    edges: np.ndarray  # statistic x bin edge
    statistic: np.ndarray  # tree x node
    threshold: np.ndarray  # tree x node, in bins
    leaf: np.ndarray  # tree x leaf

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c) for e, c in zip(self.edges, x.T, strict=True)], axis=1).astype(np.int16) if len(self.edges) else x

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if len(self.leaf):
            b, rows = self.binned(x), np.arange(len(x))
            inner = self.statistic.shape[1]
            for s, t, leaf in zip(self.statistic, self.threshold, self.leaf, strict=True):
                node = np.zeros(len(x), np.int64)
                for _ in range(int(np.log2(inner + 1))):
                    node = 2 * node + 1 + (b[rows, s[node]] > t[node])
                total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 2.0, least: int = 5) -> Forest:
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Forest(base, np.zeros((0, 0)), np.zeros((0, 1), int), np.zeros((0, 1), int), np.zeros((0, 2)))
    edges = np.quantile(x, np.arange(1, bins) / bins, axis=0).T
    forest = Forest(base, edges, np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), bins, np.int64), np.zeros((trees, 2**depth)))
    b = forest.binned(x).astype(np.int64)
    total = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            best = np.full(width, 1e-6)
            for s in range(x.shape[1]):
                cell = at * bins + b[:, s]
                sums = [np.bincount(cell, v, width * bins).reshape(width, bins).cumsum(axis=1) for v in (g, h, None)]
                gl, hl, nl = (v[:, :-1] for v in sums)
                ga, ha, na = (v[:, -1:] for v in sums)
                gain = gl**2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga**2 / (ha + l2)
                gain[(nl < least) | (na - nl < least)] = 0
                cut = gain.argmax(axis=1)
                top = gain[np.arange(width), cut]
                better = top > best
                best[better] = top[better]
                forest.statistic[t, first : first + width][better] = s
                forest.threshold[t, first : first + width][better] = cut[better]
            node = 2 * node + 1 + (b[np.arange(n), forest.statistic[t, node]] > forest.threshold[t, node])
        leaf = node - (2**depth - 1)
        forest.leaf[t] = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + l2)
        total += forest.leaf[t][leaf]
    return forest


def train(stats: DataFrame, labels: DataFrame, sample: int = 20_000) -> Forest:
    """A forest from stats (doc_id, stats) and labels (doc_id, label), on at most `sample` labelled rows of stats."""
    share = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(6)), 11) / F.lit(float(1 << 53))
    known = labels.where("label is not null and doc_id is not null").select("doc_id", "label").join(stats.select("doc_id"), "doc_id", "left_semi").withColumn("share", share)
    # Labels with hashes above four times the share that is wanted cannot be among the smallest.
    low = known.where(F.col("share") * known.count() < 4 * sample)
    rows = stats.join(bounded(low, 8 * sample), "doc_id").orderBy("share", "doc_id", "label", "stats").limit(sample).select("stats", "label").toArrow()
    y = rows.column("label").to_numpy().astype(float)
    x = np.array(rows.column("stats").to_pylist(), np.float32).reshape(len(y), -1) if len(y) else np.zeros((0, 1), np.float32)
    return fit(x, y)


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """doc_id and score of each row of stats."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(x))], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(work, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """doc_id, score, predicted for every row of docs; labels: doc_id, label (0 or 1)."""
    stats = stage(with_statistics(docs), "statistics")
    return scored(stats, train(stats, labels, sample)).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
