"""MinHash near-dedup with DartMinHash signatures.

Each text is the set of its `gram`-word shingles (a text of fewer words is one
shingle; words are as they stand, split at white space). DartMinHash throws
hashed darts at the plane (weight, rank): each element's darts come from a
Poisson process fixed by its hash alone, a dart hits a text where it lies below
the element's weight, and each of `bands * rows` coordinates keeps the hitting
dart of least rank. About k ln k + 2k darts are thrown for a text whatever its
size; where a coordinate stays empty, the ranks searched double. Two texts agree
in a coordinate with a chance equal to their (weighted) Jaccard similarity.

1. Texts with equal shingle sets (two 64-bit sums and the size agree) are one
   vertex, named by the first sum, or by the second where several share the first.
2. Signatures are banded; vertices that share a band's values are candidates.
   In a bucket every member is compared with one centre, never all pairs;
   verified links (exact similarity of 64-bit shingle hashes >= `threshold`)
   join vertices to groups, and buckets whose members are in one group are done.
   Further rounds take other centres.
3. What is still in several groups is compared in full. Of buckets with at most
   FEW members all pairs that sizes and signatures (5 standard deviations) leave
   are verified, once each. Members of larger buckets are joined exactly, by prefix
   filtering: with shingles in order of how few of these texts have them, two
   similar texts share one within their first 1 - threshold of shingles, so only
   texts of different groups that meet in such a shingle are compared. A template
   that a third of all texts share is common and hence in no prefix. Where a prefix
   shingle is common all the same, pairs of bounded blocks of its texts are
   compared, each in a task's group of its own, by signature, then exactly. No
   member, pair or candidate is left out, and only links leave the tasks.

Equal input gives equal output, links included: centres and blocks follow hashes
of the texts, not row order or partitions.

Texts without words (null too) and rows with null doc_id stay alone. Rows with
equal doc_id and different texts are as many vertices under one id: if one is
linked, all rows of that id are. An empty table gives an empty result; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .arrays import WORD_BASE, Words, chunks, mix, prefix, rolled
from .common import bounded, discard, salted_join, stage

CHUNK = 1_000_000
FEW = 64
IDS = 500_000  # rows of ids, labels or pairs that are broadcast at most
SET = ["n", "k1", "k2"]


def shingles(data: np.ndarray, offsets: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of each distinct shingle, in order of row, then hash."""
    w = Words(data, offsets)
    starts, keys = w.windows(gram)
    rows = w.rows[starts]
    short = np.flatnonzero((w.counts > 0) & (w.counts < gram))
    if len(short):
        first = np.cumsum(w.counts) - w.counts
        sums = prefix(w.hashes, WORD_BASE)
        keys = np.r_[keys, rolled(sums, first[short], first[short] + w.counts[short], WORD_BASE)]
        rows = np.r_[rows, short]
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])]) if len(keys) else np.zeros(0, np.int64)
    return rows[new], keys[new], np.diff(np.r_[new, len(keys)])


def cell(i: int) -> tuple[float, float]:
    """The i-th interval of ranks: dyadic from 1/16 to 8, then of length 8."""
    if i < 8:
        return (0.0 if i == 0 else 2.0 ** (i - 5)), 2.0 ** (i - 4)
    return 8.0 * (i - 7), 8.0 * (i - 6)


_poisson: dict[float, np.ndarray] = {}


def poisson(area: float) -> np.ndarray:
    """Distribution function of the number of darts in an area."""
    if area not in _poisson:
        n = np.arange(int(area + 12 * math.sqrt(area) + 24))
        _poisson[area] = np.cumsum(np.exp(n * math.log(area) - area - np.array([math.lgamma(x + 1) for x in n])))
    return _poisson[area]


def dart_minhash(rows: np.ndarray, keys: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """The n x k signature of rows of weighted elements; rows without elements have zeros."""
    total = np.bincount(rows, weights, n)
    darts = k * math.log(k) + 2 * k
    reach = np.where(total > 0, darts / np.maximum(total, 1e-300), 0.0)
    least, sign = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
    open_ = total > 0
    unit = 2.0 ** -32
    while open_.any():
        live = np.flatnonzero(open_[rows])
        v = 0
        while len(live):
            low, high = (0.0, 1.0) if v == 0 else (2.0 ** (v - 1), 2.0**v)
            heavy = live[weights[live] > low]
            part, c = heavy, 0
            while len(part):
                a, b = cell(c)
                part = part[reach[rows[part]] > a]
                seed = mix(keys[part] ^ np.uint64((v * 1_000_003 + c + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
                count = np.searchsorted(poisson((high - low) * (b - a)), (seed >> np.uint64(11)) * 2.0**-53, "right")
                of = np.repeat(np.arange(len(part)), count)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                dart = mix(seed[of] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
                more = mix(dart ^ np.uint64(0x165667B19E3779F9))
                element = part[of]
                rank = a + (b - a) * (dart >> np.uint64(32)) * unit
                hits = (rank < reach[rows[element]]) & (low + (high - low) * (more >> np.uint64(32)) * unit < weights[element])
                at = rows[element[hits]] * k + ((more[hits] & np.uint64(0xFFFFFFFF)) % np.uint64(k)).astype(np.int64)
                rank, dart = rank[hits], dart[hits]
                np.minimum.at(least, at, rank)
                won = least[at] == rank
                sign[at[won]] = dart[won]
                c += 1
            live, v = heavy if v else live[weights[live] > 1.0], v + 1
        open_ &= np.isinf(least.reshape(n, k)).any(axis=1)
        reach = np.where(open_, reach * 2, reach)
    return sign.reshape(n, k)


def set_sums(of: np.ndarray, keys: np.ndarray, counts: np.ndarray, n: int, weights: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: its number of shingles, and two 64-bit sums that stand for the set of them (and their counts)."""
    size = np.bincount(of, minlength=n)
    edges = np.r_[0, np.cumsum(size)]
    weight = counts.astype(np.uint64) if weights == "count" else np.uint64(1)
    sums = []
    for spread in (keys ^ weight, keys + np.uint64(0x2545F4914F6CDD1D) * weight):
        total = np.r_[np.uint64(0), np.cumsum(mix(spread))]
        sums.append((total[edges[1:]] - total[edges[:-1]]).view(np.int64))
    return size, *sums


SIGNED = "doc_id long, n long, k1 long, k2 long, bands array<long>, sign binary"


def signatures(docs: DataFrame, gram: int, bands: int, rows: int, weights: str) -> DataFrame:
    """SIGNED: number of distinct shingles, two sums that stand for their set, the bands' values, and one byte of each coordinate."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(1), CHUNK):
                of, keys, counts = shingles(data, offsets, gram)
                n = hi - lo
                size, k1, k2 = set_sums(of, keys, counts, n, weights)
                s = dart_minhash(of, keys, counts.astype(float) if weights == "count" else np.ones(len(keys)), n, bands * rows)
                folded = np.zeros((n, bands), np.uint64)
                for r in range(rows):
                    folded = mix(folded + s[:, r::rows] + np.uint64(r + 1))
                folded = mix(folded + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[size > 0]
                lengths = np.r_[0, np.cumsum(np.where(size > 0, bands, 0))].astype(np.int32)
                small = (s & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, n), pa.array(size), pa.array(k1), pa.array(k2),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(folded.ravel().view(np.int64))), pa.array([x.tobytes() for x in small], pa.binary()),
                ], ["doc_id", *SET, "bands", "sign"])

    return docs.mapInArrow(sign, SIGNED)


def sets_of(docs: DataFrame, gram: int, weights: str) -> DataFrame:
    """doc_id, n, k1, k2 as in SIGNED, and the distinct shingles' hashes and counts of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(1), CHUNK):
                of, keys, counts = shingles(data, offsets, gram)
                size, k1, k2 = set_sums(of, keys, counts, hi - lo, weights)
                edges = pa.array(np.r_[0, np.cumsum(size)].astype(np.int32))
                weighed = counts.astype(np.int32) if weights == "count" else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), pa.array(size), pa.array(k1), pa.array(k2),
                    pa.ListArray.from_arrays(edges, pa.array(keys.view(np.int64))), pa.ListArray.from_arrays(edges if weights == "count" else pa.array(np.zeros(hi - lo + 1, np.int32)), pa.array(weighed)),
                ], ["doc_id", *SET, "keys", "counts"])

    return docs.mapInArrow(work, "doc_id long, n long, k1 long, k2 long, keys array<long>, counts array<int>")


def lists(column: pa.Array) -> list[np.ndarray]:
    """The lists of an Arrow list column as numpy views."""
    values, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]


def jaccard(p: np.ndarray, q: np.ndarray, v: np.ndarray, w: np.ndarray) -> float:
    """Similarity of two sets of distinct shingles; where they have counts v and w, sum of minima over sum of maxima."""
    if not len(v):
        both = len(np.intersect1d(p, q, assume_unique=True))
        return both / max(1, len(p) + len(q) - both)
    _, i, j = np.intersect1d(p, q, assume_unique=True, return_indices=True)
    least = float(np.minimum(v[i], w[j]).sum())
    return least / max(1.0, float(v.sum()) + float(w.sum()) - least)


def floor_of_agreement(threshold: float, coordinates: int) -> float:
    """The share of coordinates, 5 standard deviations below the threshold, under which a signature rules a pair out."""
    return threshold - 5 * math.sqrt(threshold * (1 - threshold) / max(1, coordinates))


def not_ruled_out(pairs: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """The pairs (doc, centre) whose signatures agree enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p, q = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(b.num_rows, -1) for k in (2, 3))
                near = (p == q).mean(axis=1) >= floor_of_agreement(threshold, p.shape[1])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["doc", "centre"]).filter(pa.array(near))

    pairs = stage(pairs, "star-pairs")
    counts = stage(pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("n_")), "centre-counts")
    one = signed.select(F.col("rep").alias("doc"), F.col("sign").alias("sign_doc"))
    two = signed.join(bounded(counts.select(F.col("centre").alias("rep")), IDS), "rep", "left_semi").select(F.col("rep").alias("centre"), F.col("sign").alias("sign_centre"))
    both = salted_join(one.join(bounded(pairs, IDS), "doc"), two, ["centre"], counts, F.col("doc"))
    return both.select("doc", "centre", "sign_doc", "sign_centre").mapInArrow(work, "doc long, centre long")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (doc, centre) those whose sets are similar by threshold or more: a < b, similarity.

    A centre's set goes out to as many salts as its members fill.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sim = np.array([jaccard(*x) for x in zip(*(lists(b.column(i)) for i in range(2, 6)), strict=True)], float)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sim)], ["doc", "centre", "similarity"]).filter(pa.array(sim >= threshold))

    pairs = stage(pairs, "pairs")
    counts = pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("n_"))
    one = sets.select(F.col("rep").alias("doc"), F.col("keys").alias("p"), F.col("counts").alias("v"))
    two = sets.join(bounded(counts.select(F.col("centre").alias("rep")), 1_000_000), "rep", "left_semi").select(F.col("rep").alias("centre"), F.col("keys").alias("q"), F.col("counts").alias("w"))
    joined = salted_join(one.join(bounded(pairs, IDS), "doc"), two, ["centre"], counts, F.col("doc"))
    found = joined.select("doc", "centre", "p", "q", "v", "w").mapInArrow(work, "doc long, centre long, similarity double")
    return found.select(F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b"), "similarity").distinct()


def components(edges: DataFrame) -> DataFrame:
    """doc, label (staged): the smallest vertex of each vertex's component, by alternating large and small stars.

    A round is two jobs, the next edges and the test for the end: that no vertex has two parents or is child and parent.
    """
    e = stage(edges.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).where("x <> y").distinct(), "edges")
    while True:
        both = e.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(e.select(F.col("y").alias("u"), F.col("x").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(low.select("x", F.col("m").alias("y")))
        e = stage(small.distinct(), "edges", replaces=e)
        ends = e.select(F.col("x").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("y").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty():
            break
    stars = e.select(F.col("x").alias("doc"), F.col("y").alias("label"))
    return stage(stars.unionByName(e.select(F.col("y").alias("doc"), F.col("y").alias("label")).distinct()), "labels", replaces=e)


def apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members (bucket, doc, ..) with label and all (the bucket's members), of buckets with more than one label; a vertex without links is its own label."""
    named = stage(members.join(bounded(labels, IDS), "doc", "left").withColumn("label", F.coalesce("label", "doc")), "named")
    mixed = named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n_")).where("lo < hi").select("bucket", "n_")
    mixed = stage(mixed, "mixed")
    return stage(salted_join(named, mixed.select("bucket", F.col("n_").alias("all")), ["bucket"], mixed, F.col("doc"), rows_to_broadcast=IDS), "apart", replaces=named)


def starred(members: DataFrame, turn: int) -> DataFrame:
    """(doc, centre): each member with the centre of its bucket, without those already in the centre's group."""
    order = F.struct(F.xxhash64("doc", F.lit(turn)).alias("h"), "doc", "label")
    centre = members.groupBy("bucket").agg(F.min(order).alias("c"), F.count(F.lit(1)).alias("n_")).select("bucket", F.col("c.doc").alias("centre"), F.col("c.label").alias("its"), "n_")
    centre = stage(centre, "centres")
    return salted_join(members, centre.drop("n_"), ["bucket"], centre, F.col("doc"), rows_to_broadcast=IDS).where("label <> its").select("doc", "centre").distinct()


def rare_shingles(sets: DataFrame, docs: DataFrame, threshold: float, by_count: bool) -> DataFrame:
    """(bucket, doc, n): the shingles by which each of docs (doc, n) can meet a similar one of them.

    Shingles are in order of how few of docs have them; of two texts similar by
    threshold, the first common shingle has at most 1 - threshold of the weight of
    either text before it. Shingles that only one text has come first and meet none.
    """
    one = F.explode(F.arrays_zip("keys", "counts")) if by_count else F.explode("keys")
    weight = F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y) if by_count else F.size("keys").cast("long")
    known = sets.withColumnRenamed("rep", "doc").join(bounded(docs, IDS), "doc").withColumn("total", weight)
    each = known.select("doc", "n", "total", one.alias("e"))
    if by_count:
        each = each.select("doc", "n", "total", F.col("e.keys").alias("bucket"), F.col("e.counts").cast("long").alias("w"))
    else:
        each = each.select("doc", "n", "total", F.col("e").alias("bucket"), F.lit(1).cast("long").alias("w"))
    often = stage(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_")).where("n_ > 1"), "shingle-counts")
    shared = salted_join(each, often, ["bucket"], often, F.col("doc"), rows_to_broadcast=IDS)
    of, ahead = W.partitionBy("doc"), W.partitionBy("doc").orderBy("n_", "bucket").rowsBetween(W.unboundedPreceding, -1)
    before = F.col("total") - F.sum("w").over(of) + F.coalesce(F.sum("w").over(ahead), F.lit(0))
    first = shared.withColumn("before", before).where(F.col("before") <= F.col("total") * (1 - threshold) + 1e-6)
    return first.select("bucket", "doc", "n")


def block_pairs(members: DataFrame, rows_per_block: int, shingles_per_block: int) -> DataFrame:
    """members with main, block, and a row for each pair of blocks (x, y), x <= y, of their bucket that they are in.

    The largest group of a bucket (main) and its other members are each cut
    into blocks of bounded rows and shingles. Blocks of other members meet each
    other and those of main; the first block of main meets them as the pair in
    which a block of other members is also compared within itself.
    """
    per = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n_"), F.sum("n").alias("size"))
    main = per.groupBy("bucket").agg(F.max(F.struct("n_", "label", "size")).alias("m"), F.sum("n_").alias("sum"), F.sum("size").alias("sizes"))
    blocks = lambda n, size: F.greatest(F.ceil(n / rows_per_block), F.ceil(size / shingles_per_block), F.lit(1)).cast("int")
    main = main.select("bucket", F.col("m.label").alias("main"), blocks(F.col("m.n_"), F.col("m.size")).alias("mains"), blocks(F.col("sum") - F.col("m.n_"), F.col("sizes") - F.col("m.size")).alias("others"))
    named = members.join(main, "bucket").withColumn("main", F.col("label") == F.col("main"))
    spread = lambda n: F.pmod(F.xxhash64("doc"), n.cast("long")).cast("int")
    named = named.withColumn("block", F.when(F.col("main"), F.col("others") + spread(F.col("mains"))).otherwise(spread(F.col("others"))))
    met = F.filter(F.sequence(F.lit(0), F.col("others") - 1 + F.when(F.col("main"), 0).otherwise(F.col("mains"))), lambda c: c != F.col("block"))
    return named.withColumn("meets", F.explode(met)).select("bucket", "doc", "n", "label", "main", "block", F.least("block", "meets").alias("x"), F.greatest("block", "meets").alias("y"), (F.greatest("block", "meets") == F.col("others")).alias("within"))


def in_blocks(rows: DataFrame, columns: list[str], compare: Callable, schema: str) -> DataFrame:
    """compare(block x, within, the columns as lists) for the rows of each (bucket, x, y), which gives a batch of schema."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, within, held = None, False, []
        for b in batches:
            kinds = [lists(c) if pa.types.is_list(c.type) else c.to_pylist() for c in b.columns]
            for bucket, x, y, inside, *rest in zip(*kinds, strict=True):
                if (bucket, x, y) != at and held:
                    yield compare(at, within, held)
                    held = []
                at, within = (bucket, x, y), inside
                held.append(rest)
        if held:
            yield compare(at, within, held)

    ordered = rows.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "doc")
    return ordered.select("bucket", "x", "y", "within", *columns).mapInArrow(work, schema)


def likely(x: int, within: bool, docs: np.ndarray, labels: np.ndarray, blocks: np.ndarray, n: np.ndarray, signs: np.ndarray, threshold: float, by_count: bool, lanes: int = 64, width: int = 512) -> Iterator[tuple[int, int]]:
    """Pairs (p, q), p in block x, that the pair of blocks has to compare and that sizes and signatures (5 standard deviations) do not rule out."""
    enough = floor_of_agreement(threshold, signs.shape[1])
    ours = np.flatnonzero(blocks == x)
    for lo in range(0, len(ours), lanes):
        mine = ours[lo : lo + lanes]
        for to in range(0, len(docs), width):
            there = slice(to, to + width)
            maybe = labels[mine][:, None] != labels[None, there]
            if not by_count:
                maybe &= np.minimum(n[mine][:, None], n[None, there]) >= threshold * np.maximum(n[mine][:, None], n[None, there]) - 1e-9
            other = blocks[None, there] != x
            maybe &= other | (docs[mine][:, None] < docs[None, there]) if within else other
            i, j = np.nonzero(maybe)
            near = (signs[mine[i]] == signs[to + j]).mean(axis=1) >= enough
            yield from zip(mine[i[near]].tolist(), (to + j[near]).tolist(), strict=True)


BLOCK = ["doc", "label", "block", "n", "sign"]


def arrays(held: list) -> tuple:
    """The columns BLOCK of rows, in numpy."""
    return *(np.array([h[k] for h in held]) for k in range(4)), np.frombuffer(b"".join(h[4] for h in held), np.uint8).reshape(len(held), -1)


def signed_blocks(members: DataFrame, signed: DataFrame, rows_per_block: int = 4_000, shingles_per_block: int = 2_000_000) -> DataFrame:
    dealt = stage(block_pairs(members, rows_per_block, shingles_per_block), "block-pairs")
    some = signed.withColumnRenamed("rep", "doc").join(bounded(dealt.select("doc").distinct(), IDS), "doc", "left_semi")
    return dealt.join(some, "doc")


def pairs_of_small(members: DataFrame, signed: DataFrame, threshold: float, by_count: bool) -> DataFrame:
    """(doc, centre): once each, the pairs across groups that share a small bucket and that sizes and signatures do not rule out.

    With at most FEW members a bucket, a member has at most FEW / 2 of them in each.
    """

    def pairs(at, within, held) -> pa.RecordBatch:
        docs, *rest = arrays(held)
        found = [(docs[p], docs[q]) for p, q in likely(at[1], within, docs, *rest, threshold, by_count)]
        return pa.RecordBatch.from_arrays([pa.array([min(f) for f in found], pa.int64()), pa.array([max(f) for f in found], pa.int64())], ["centre", "doc"])

    return in_blocks(signed_blocks(members, signed), BLOCK, pairs, "centre long, doc long").distinct()


def in_full(members: DataFrame, signed: DataFrame, sets: DataFrame, threshold: float, by_count: bool = False, rows_per_block: int = 4_000, shingles_per_block: int = 2_000_000) -> DataFrame:
    """(a, b, similarity): links between the groups that share a large bucket, after comparing all its members across groups.

    Pairs of bounded blocks are compared, each in a task's group of its own (see
    block_pairs): first by sizes and signatures alone, then, with the sets of the
    texts that have a partner left, exactly. Only links leave them; of a text's
    links to one other group in a pair of blocks the first is enough.
    """
    rows = "bucket long, x int, y int, within boolean, doc long, label long, block int, n long, sign binary"

    def screen(at, within, held) -> pa.RecordBatch:
        kept = sorted({k for pair in likely(at[1], within, *arrays(held), threshold, by_count) for k in pair})
        found = [(*at, within, *held[k]) for k in kept]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)], ["bucket", "x", "y", "within", *BLOCK])

    def exactly(at, within, held) -> pa.RecordBatch:
        docs, labels, *rest = arrays(held)
        joined: set[tuple[int, int]] = set()
        out = []
        for p, q in likely(at[1], within, docs, labels, *rest, threshold, by_count):
            if (p, labels[q]) not in joined:
                sim = jaccard(held[p][5], held[q][5], held[p][6], held[q][6])
                if sim >= threshold:
                    joined.add((p, labels[q]))
                    out.append((min(docs[p], docs[q]), max(docs[p], docs[q]), sim))
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in ((0, pa.int64()), (1, pa.int64()), (2, pa.float64()))], ["a", "b", "similarity"])

    left = stage(in_blocks(signed_blocks(members, signed, rows_per_block, shingles_per_block), BLOCK, screen, rows), "likely")
    some = sets.withColumnRenamed("rep", "doc").join(bounded(left.select("doc").distinct(), IDS), "doc", "left_semi")
    with_sets = left.join(some, "doc")
    return in_blocks(with_sets, [*BLOCK, "keys", "counts"], exactly, "a long, b long, similarity double").dropDuplicates(["a", "b"])


def all_links(left: DataFrame, labels: DataFrame, signed: DataFrame, sets: DataFrame, threshold: float, by_count: bool, few: int = FEW) -> DataFrame:
    """(a, b, similarity): the links between the groups that share a bucket of left (see apart).

    Pairs in small buckets are verified one by one. Members of larger ones are joined by their rare shingles, where again small buckets give pairs and larger ones blocks.
    """
    many = left.where(F.col("all") > few).select("doc", "n").distinct()
    met = apart(rare_shingles(sets, many, threshold, by_count), labels)
    pairs = pairs_of_small(left.where(F.col("all") <= few).unionByName(met.where(F.col("all") <= few)), signed, threshold, by_count)
    return verified(pairs, sets, threshold).unionByName(in_full(met.where(F.col("all") > few), signed, sets, threshold, by_count)).dropDuplicates(["a", "b"])


class Near(NamedTuple):
    """classes: doc_id, class_id, class_size, links for each input row. texts: doc_id, text (the vertex of its set), class_id.
    links: a, b (vertices), similarity: the verified links, enough of them to span every class."""

    classes: DataFrame
    texts: DataFrame
    links: DataFrame


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = 5, threshold: float = 0.8, bands: int = 32, rows: int = 5, weights: str = "set", rounds: int = 1, ids_to_broadcast: int = 1_000_000,
) -> Near:
    """Near-duplicate classes and their links; weights: `set`, or `count` for weighted Jaccard over shingle counts."""
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    signed = stage(signatures(docs, gram, bands, rows, weights), "signatures")
    usable = signed.where("n > 0 and doc_id is not null")
    sets_seen = usable.groupBy(*SET).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_"), F.first("bands").alias("bands"), F.first("sign").alias("sign"))
    seen = stage(sets_seen, "vertices")
    shared = [r.k1 for r in seen.groupBy("k1").agg(F.count(F.lit(1)).alias("n_")).where("n_ > 1").select("k1").collect()]  # by chance only
    vertices = seen.withColumn("rep", F.when(F.col("k1").isin(shared), F.col("k2")).otherwise(F.col("k1")) if shared else F.col("k1"))
    texts = salted_join(usable.select("doc_id", *SET), vertices.select(*SET, "rep"), SET, vertices, F.col("doc_id"))
    texts = stage(texts.select("doc_id", "rep"), "texts")

    banded = vertices.select(F.col("rep").alias("doc"), "n", F.explode("bands").alias("bucket"))
    buckets = stage(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_")).where("n_ > 1"), "buckets")
    members = stage(salted_join(banded, buckets.select("bucket"), ["bucket"], buckets, F.col("doc"), rows_to_broadcast=IDS), "members")
    needed = members.select(F.col("doc").alias("rep")).distinct().join(vertices.select("rep", F.col("first").alias("doc_id"), *SET), "rep")
    needed = stage(needed, "needed")
    whole = docs.join(bounded(needed.select("doc_id").distinct(), ids_to_broadcast), "doc_id", "left_semi")
    sets = sets_of(whole, gram, weights).dropDuplicates(["doc_id", *SET]).join(bounded(needed, IDS), ["doc_id", *SET]).select("rep", "keys", "counts")
    sets = stage(sets, "sets", replaces=needed)

    # Several texts under one doc_id belong together, which is no link.
    per_id = texts.distinct().groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("hi")).where("a < hi")
    same_id = texts.distinct().join(per_id, "doc_id").where("rep > a").select("a", F.col("rep").alias("b")).distinct()
    links, stars, labels = None, stage(same_id, "same-id"), None
    used = [seen, buckets, members, sets, stars]
    left = members.withColumn("label", F.col("doc"))
    for turn in range(rounds + 1):
        if turn < rounds:
            new = verified(not_ruled_out(starred(left, turn), vertices.select("rep", "sign"), threshold), sets, threshold)
        else:
            if labels is None:
                labels = components(stars)
                left = apart(members, labels)
            new = all_links(left, labels, vertices.select("rep", "sign"), sets, threshold, weights == "count")
        new = stage(new, "new-links")
        labels = components(stars.unionByName(new.select("a", "b")))
        links = stage(new if links is None else links.unionByName(new).dropDuplicates(["a", "b"]), "links", replaces=links)
        discard(new)
        stars = labels.select(F.col("label").alias("a"), F.col("doc").alias("b"))
        used.append(labels)
        if turn < rounds:
            left = apart(left.drop("label", "all"), labels)
            used.append(left)
            if left.isEmpty():
                break

    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    named = vertices.select("rep", "first", "n_").join(labels.select(F.col("doc").alias("rep"), "label"), "rep", "left").join(degree, "rep", "left")
    named = named.select("rep", "first", "n_", F.coalesce("label", "rep").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    ids = texts.distinct().join(named.select("rep", "label"), "rep").select("doc_id", "label").distinct()
    sizes = ids.groupBy("label").agg(F.count(F.lit(1)).alias("class_size"))
    firsts = named.groupBy("label").agg(F.min("first").alias("class_id"))
    named = stage(named.drop("first").join(sizes, "label").join(firsts, "label"), "near-classes")
    placed = salted_join(texts, named.drop("label", "n_"), ["rep"], named.select("rep", "n_"), F.col("doc_id")).select("doc_id", "rep", "class_id", "class_size", "links")
    alone = signed.where("not (n > 0 and doc_id is not null)").select("doc_id", F.lit(None).cast("long").alias("rep"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("links"))
    placed = stage(placed.unionByName(alone), "placed", replaces=signed)
    for table in [*used, named, texts]:
        discard(table)
    return Near(placed.select("doc_id", "class_id", "class_size", "links"), placed.where("rep is not null").select("doc_id", F.col("rep").alias("text"), "class_id"), links)


def near_dedup(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its group), class_size (ids) and links (of its text, among those found) for each row; settings as in near_groups."""
    return near_groups(docs, **settings).classes


def keep_one(docs: DataFrame, classes: DataFrame, ids_to_broadcast: int = 1_000_000) -> DataFrame:
    """The rows of docs whose doc_id is that of their class; of rows with equal doc_id all, and those with null doc_id."""
    gone = stage(classes.where("doc_id <> class_id").select("doc_id").distinct(), "near-copies")
    return docs.join(bounded(gone, ids_to_broadcast), "doc_id", "left_anti").select(*docs.columns)
