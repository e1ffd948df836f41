"""Spelling variant grouping: words one edit apart, found by dense prefix-suffix tiling of blocks.

Words are counted per batch before they are shuffled. Two words, the shorter of m
code points, that are one edit apart agree in their first floor(m / 2) code points
or in their last ceil(m / 2): so a block is a class m with an agreed prefix and
suffix, which the words of m and m + 1 code points enter by both halves. Blocks whose words have
more than `most` code points are halved again by the same rule on what is still free
between prefix and suffix, in rounds over all such blocks, until one free code point is
left; then a block has at most s + s * s words for s letters, whatever the table.
Within a block, padded code-point matrices (left- and right-aligned) are compared
tile against tile; a pair is near if its common prefix and suffix together reach the
longer length minus one. Each near pair is reported by one block only: the smaller
length is the block's class, and wherever both halves agree the prefix block has it.

Cases: a null or empty text has no words; a null doc_id deletes nothing; repeated
rows count as often as they are there; ties of n go to the word first in code-point
order; an empty table gives no rows. Very long words are words like others. Other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import discard, parts, salted_join, stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BATCH = 4_000_000  # bytes whose words are counted together
MOST = 20_000  # code points of the words of a block that is compared as it is
TILE = 1 << 22  # cells of a comparison
CELLS = 1 << 21  # cells of the rows that are compared together, by the widest


def words_of(doc_id: int | None, text: bytes, least: int, every: int) -> Counter:
    """The words of at least `least` code points of one text: runs, where `every` divides their hash without one code point."""
    runs = Counter(RUN.findall(text.translate(LOWER).decode()))
    if doc_id is None:
        return Counter({run: n for run, n in runs.items() if len(run) >= least})
    start, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= least:
            out[run] += n
    return out


def counted(docs: DataFrame, least: int = 5, times: int = 3, every: int = 97) -> DataFrame:
    """word, n of the words of docs (doc_id, text) with at least `times` occurrences."""

    def flush(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = Counter(), 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                text = text.as_py()
                total.update(words_of(doc_id, text, least, every))
                size += len(text)
                if size >= BATCH:
                    yield flush(total)
                    total, size = Counter(), 0
        yield flush(total)

    some = docs.where("text is not null").select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(work, "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def block_key() -> Column:
    """What the words of a block share: their class, places and agreed ends (as a hash: blocks that share one are only larger)."""
    return F.xxhash64("m", "i", "j", "limit", F.expr("substring(word, 1, i)"), F.expr("right(word, j)"))


def halves(rows: DataFrame) -> DataFrame:
    """Each row (m, i, j, limit, word, n) in its prefix half and its suffix half.

    i and j are the agreed lengths; a pair in a suffix half whose common prefix reaches `limit` belongs to a prefix half.
    """
    cut = F.expr("i + (m - i - j) div 2").cast("int")
    first = F.struct(cut.alias("i"), F.col("j"), F.col("limit"))
    second = F.struct(F.col("i"), F.expr("m - (i + (m - i - j) div 2)").cast("int").alias("j"), F.least("limit", cut).alias("limit"))
    # With one free code point the prefix half is the block itself, so the block stays whole.
    return rows.withColumn("h", F.explode(F.array(first, second))).select("m", "h.i", "h.j", "h.limit", "word", "n")


def blocks(words: DataFrame, least: int, most: int) -> DataFrame:
    """Rows (block, m, limit, word, n) of all blocks of two words or more, one of them of m code points."""
    both = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m")
    none = F.lit(0).cast("int")
    rows = words.select("word", "n", both).where(F.col("m") >= least).select("m", none.alias("i"), none.alias("j"), F.lit(2**31 - 1).cast("int").alias("limit"), "word", "n")
    done, rows, staged = [], halves(rows), None
    while True:
        rows = stage(rows.withColumn("block", block_key()), "blocks", replaces=staged)
        staged = rows
        shorter = F.count(F.when(F.length("word") == F.col("m"), 1))
        sizes = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n_"), F.sum(F.length("word")).alias("cells"), shorter.alias("shorter"), F.max(F.expr("m - i - j")).alias("free"))
        sizes = stage(sizes.where("n_ > 1 and shorter > 0").withColumn("large", (F.col("cells") > most) & (F.col("free") > 1)), "sizes")
        pick = lambda large, rows=rows, sizes=sizes: salted_join(rows, sizes.where(large).select("block"), ["block"], sizes.select("block", "n_"), F.col("word"))
        done.append(stage(pick("not large").select("block", "m", "limit", "word", "n"), "done"))
        if sizes.where("large").isEmpty():
            discard(rows)
            break
        rows = halves(pick("large"))
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words, left-aligned and right-aligned, padded with 0; and lengths."""
    size = np.array([len(w) for w in words])
    wide = int(size.max())
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint16)
    rows = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(flat)) - np.repeat(np.r_[0, size.cumsum()[:-1]], size)
    left, right = np.zeros((2, len(words), wide), np.uint16)
    left[rows, at] = flat
    right[rows, np.repeat(size, size) - 1 - at] = flat
    return left, right, size


def agreed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of each row of a with each row of b, over a tile: columns are compared while any pair agrees."""
    alive = np.ones((len(a), len(b)), bool)
    out = np.zeros((len(a), len(b)), np.int32)
    for x, y in zip(a.T, b.T, strict=True):
        alive &= (x[:, None] == y[None, :]) & (x != 0)[:, None]
        if not alive.any():
            break
        out += alive
    return out


def near_pairs(block: np.ndarray, m: np.ndarray, limit: np.ndarray, words: list[str], tile: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Rows (x, y) of near pairs within the blocks of rows that are sorted by block."""
    left, right, size = matrices(words)
    cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(block)]
    found = []
    small = np.repeat(np.diff(cuts), np.diff(cuts)) <= 32
    # Small blocks: all together, every row against the one `step` rows further on.
    for step in range(1, 32):
        x = np.flatnonzero(small[:-step] & (block[step:] == block[:-step]))
        if not len(x):
            break
        for part in np.array_split(x, 1 + len(x) * left.shape[1] // TILE):
            y = part + step
            lasting = lambda c, x=part, y=y: np.logical_and.accumulate((c[x] == c[y]) & (c[x] != 0), axis=1).sum(axis=1)
            found.append((part, y, lasting(left), lasting(right)))
    # Larger ones: tile against tile.
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi - lo <= 32:
            continue
        for p in range(lo, hi, tile):
            for q in range(p, hi, tile):
                a, b = slice(p, min(p + tile, hi)), slice(q, min(q + tile, hi))
                pre, suf = agreed(left[a], left[b]), agreed(right[a], right[b])
                x, y = np.nonzero(pre + suf >= np.maximum(size[a][:, None], size[b][None, :]) - 1)
                keep = x + p < y + q
                x, y = x[keep], y[keep]
                found.append((x + p, y + q, pre[x, y], suf[x, y]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y, pre, suf = (np.concatenate(c) for c in zip(*found, strict=True))
    longer, shorter = np.maximum(size[x], size[y]), np.minimum(size[x], size[y])
    near = (pre + suf >= longer - 1) & (longer - shorter <= 1) & (pre < longer) & (shorter == m[x]) & (pre < limit[x])
    return x[near], y[near]


def links(rows: DataFrame, tasks: int) -> DataFrame:
    """word, n, other, other_n, both ways, of the near pairs of blocks."""

    def close(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        if not t.num_rows:
            return
        number = lambda name: t.column(name).to_numpy()
        x, y = near_pairs(number("block"), number("m"), number("limit"), t.column("word").to_pylist())
        for a, b in ((x, y), (y, x)):
            w, n = t.column("word").combine_chunks(), t.column("n").combine_chunks()
            yield pa.RecordBatch.from_arrays([w.take(pa.array(a)), n.take(pa.array(a)), w.take(pa.array(b)), n.take(pa.array(b))], ["word", "n", "other", "other_n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if b.num_rows and size * b.column(1)[-1].as_py() >= CELLS:  # classes ascend, so the last one is the widest
                t = pa.Table.from_batches(held)
                whole = np.flatnonzero(t.column("block").to_numpy() != b.column(0)[-1].as_py())
                whole = int(whole[-1]) + 1 if len(whole) else 0  # all but the last block are whole
                yield from close(t.slice(0, whole).to_batches())
                held = t.slice(whole).to_batches()
                size = t.num_rows - whole
        if held:
            yield from close(held)

    sorted_ = rows.repartition(tasks, "block").sortWithinPartitions("m", "block")
    return sorted_.mapInArrow(work, "word string, n long, other string, other_n long")


def rooted(forms: DataFrame) -> DataFrame:
    """word, root of words with a form (word, form), by doubling: each round joins every word to what its form follows."""
    up = stage(forms.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while True:
        on = up.groupBy("root").agg(F.count(F.lit(1)).alias("n_"))
        on = on.join(up.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        step = salted_join(up, on.drop("n_"), ["root"], on.drop("next"), F.col("word"))
        step = step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        up = stage(step, "roots", replaces=up)
        if up.where("moved").isEmpty():
            return up.select("word", "root")


def variants(docs: DataFrame, least: int = 5, times: int = 3, every: int = 97, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of docs (doc_id, text)."""
    words = stage(counted(docs, least, times, every), "words")
    rows = blocks(words, least, most)
    near = links(rows, parts(docs.sparkSession, rows.count(), 200_000))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    about = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= 2 * F.col("n")
    forms = words.join(about, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    forms = stage(forms, "forms")
    full = forms.join(rooted(forms), "word", "left").withColumn("root", F.coalesce("root", "word"))
    return full.select("word", "form", "root", "n", "n_near", "form_n")
