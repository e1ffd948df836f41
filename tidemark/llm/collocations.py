"""Phrase collocation mining: lossless n-gram counts in counting quotient filters, scored per language.

Texts are read once into chunks of one language: their word streams as numbers
of a vocabulary of their own. The vocabularies are added up to the exact count of
every word, and words with fewer than `least` occurrences, which no candidate can
hold, get no id. A chunk's few different words (not its occurrences) are joined
with the ids. Its n-grams are then packed, permuted and counted in one filter for
each bucket of the permuted keys, and the filters of a bucket are merged across
chunks. Where a language needs more buckets than `fan` bits, that takes several
rounds: groups of chunks are merged first and dealt out to finer buckets. A bucket
is even whatever the words are, for its key is a permutation, and a frequent phrase
is one entry of a chunk's filter.

Cases: a null text has no words, a null lang is `und` and counts with a language
of that name; a piece of one word has no phrase; repeated rows count as often as
they are there; an empty table gives no rows. Equal scores are ordered by count,
then phrase in byte order. Very long texts are cut at piece boundaries, so only a
single piece is held whole. Other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import bounded, parts, ranked, salted_join, stage
from .quotient_filter import Counts, merged, packed, permuted, restored, unpacked

CHUNK = 16_000_000  # bytes of text
ENTRIES = 3_000_000  # entries that a merge holds
FAN = 9  # bits of the bucket that one round deals out
BREAK, BLANK = 1, 0
PLAIN = bytes(10 if chr(c) in ".,;:!?\n\v\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
CUT = re.compile(rb"[.,;:!?\n-\r]")
CHUNK_SCHEMA = "chunk long, lang string, tokens binary, words array<string>, counts array<long>"


def slices(text: bytes, size: int) -> Iterator[bytes]:
    """text in slices of about `size` bytes that end where a piece ends."""
    at = 0
    while len(text) - at > size:
        cut = CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


def numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of texts as numbers (BREAK between pieces), and the words."""
    ids: defaultdict = defaultdict(itertools.count().__next__)
    ids[b""], ids[b"\n"]  # BLANK and BREAK
    data = b"\n".join(texts).translate(PLAIN).replace(b"\n", b" \n ")
    tokens = np.fromiter(map(ids.__getitem__, data.split(b" ")), np.int32)
    return tokens[tokens != BLANK], list(ids)


def chunked(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """Chunks of one language each: word stream, words, and how often each occurs."""

    def flush(held: dict[str, list[bytes]], number: Iterator[int]) -> Iterator[pa.RecordBatch]:
        for lang, texts in held.items():
            tokens, words = numbered(texts)
            counts = np.bincount(tokens, minlength=len(words))
            planes = tokens.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
            names = pa.array(words[2:], pa.binary()).cast(pa.string())
            row = [pa.array([next(number)]), pa.array([lang]), pa.array([planes], pa.binary())]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (names, pa.array(counts[2:]))]
            yield pa.RecordBatch.from_arrays(row + lists, ["chunk", "lang", "tokens", "words", "counts"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held: dict[str, list[bytes]] = defaultdict(list)
        total = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                for piece in slices(text.as_py(), size):
                    held[lang].append(piece)
                    total += len(piece)
                    if total >= size:
                        yield from flush(held, number)
                        held.clear()
                        total = 0
        yield from flush(held, number)

    lang = F.coalesce(docs["lang"].cast("string"), F.lit("und"))
    return docs.where("text is not null").select(lang.alias("lang"), "text").mapInArrow(work, CHUNK_SCHEMA)


def of_stream(ids: np.ndarray, b: int, n: int) -> Counts:
    """Keys of the n-grams of a stream of ids, in which -1 breaks."""
    at = [ids[k : len(ids) - n + 1 + k] for k in range(n)]
    whole = np.logical_and.reduce([x >= 0 for x in at])
    first, *others = (x[whole].astype(np.uint64) for x in at)
    rest = np.zeros(len(first), np.uint64)
    for x in others:
        rest = (rest << np.uint64(b)) | x
    high, low = permuted(first, rest, b, (n - 1) * b)
    return merged([Counts(high, low, np.ones(len(high), np.int64))], b, (n - 1) * b)


def dealt(c: Counts, used: int, bits: int, b: int, width: int) -> Iterator[tuple[int, bytes]]:
    """Filters of c, whose keys agree in the first `used` bits, by their first `used + bits` bits."""
    left = b - used - bits
    bucket = (c.high >> np.uint64(left)).astype(np.int64)
    cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi > lo:
            yield int(bucket[lo]), packed(Counts(c.high[lo:hi] & np.uint64((1 << left) - 1), c.low[lo:hi], c.count[lo:hi]), left, width)


def bucket_bits(words: int, b: int, entries: int) -> int:
    """Bits of a bucket, so that its entries before merging are about `entries` at most."""
    return min(b, max(0, math.ceil(math.log2(max(1, words / entries)))))


FILTERS = "lang string, n int, b int, bits int, used int, bucket long, part long, filter binary"
NAMES = [x.split()[0] for x in FILTERS.split(", ")]
COUNTS = "lang string, n int, i1 long, i2 long, i3 long, f long"


def filters(chunks: DataFrame, sizes: tuple[int, ...], entries: int, fan: int) -> DataFrame:
    """Filters of the n-grams of each chunk; chunks: chunk, lang, tokens, ids (idx, id), words_ and ids_ of the language."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, lang, tokens, ids, total, known = (batch.column(k)[row] for k in range(6))
                flat = ids.values
                stream = np.frombuffer(tokens.as_buffer(), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()
                to = np.full(int(stream.max(initial=0)) + 1, -1, np.int64)
                to[flat.field(0).to_numpy() + 2] = flat.field(1).to_numpy()
                b = max(1, known.as_py().bit_length())
                bits = bucket_bits(total.as_py(), b, entries)
                for n in sizes:
                    c = of_stream(to[stream], b, n)
                    step = min(fan, bits)
                    rows = [(lang.as_py(), n, b, bits, step, bucket, chunk.as_py(), data) for bucket, data in dealt(c, 0, step, b, (n - 1) * b)]
                    if rows:
                        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], NAMES)

    return chunks.select("chunk", "lang", "tokens", "ids", "words_", "ids_").mapInArrow(work, FILTERS)


def merge(rows: DataFrame, least: int, entries: int, fan: int, last: bool) -> DataFrame:
    """Merge the filters of equal (lang, n, bucket, part), which come sorted; then n-grams with counts, or finer filters."""

    def close(key: tuple, held: list[Counts]) -> Iterator[pa.RecordBatch]:
        lang, n, b, bits, used, bucket, part = key
        width = (n - 1) * b
        c = merged(held, b - used, width)
        c = c._replace(high=c.high | np.uint64(bucket << (b - used)))
        if not last:
            step = min(fan, bits - used)
            out = [(lang, n, b, bits, used + step, at, part, data) for at, data in dealt(c, used, step, b, width)]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], NAMES)
            return
        often = c.count >= least
        first, rest = restored(c.high[often], c.low[often], b, width)
        mask, shift = np.uint64((1 << b) - 1), np.uint64(b)
        second, third = (rest, None) if n == 2 else (rest >> shift, rest & mask)
        m = len(first)
        columns = [pa.array([lang] * m, pa.string()), pa.array(np.full(m, n, np.int32)), pa.array(first.astype(np.int64)), pa.array(second.astype(np.int64))]
        columns += [pa.nulls(m, pa.int64()) if third is None else pa.array(third.astype(np.int64)), pa.array(c.count[often])]
        yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in COUNTS.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for row, at in enumerate(zip(*columns, strict=True)):
                if at != key:
                    if key is not None:
                        yield from close(key, held)
                    key, held, size = at, [], 0
                _, n, b, _, used, _, _ = at
                held.append(unpacked(batch.column(7)[row].as_py(), b - used, (n - 1) * b))
                size += len(held[-1].high)
                if size > entries and len(held) > 1:
                    held, size = [merged(held, b - used, (n - 1) * b)], 0
        if key is not None:
            yield from close(key, held)

    return rows.mapInArrow(work, COUNTS if last else FILTERS)


def frequent(chunks: DataFrame, least: int, sizes: tuple[int, ...] = (2, 3), entries: int = ENTRIES, fan: int = FAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: lang, word, f, id), (langs: lang, n) and (phrases: lang, n, i1, i2, i3, f) with at least `least` occurrences."""
    spark = chunks.sparkSession
    each = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", "w.words", "w.counts")
    counts = each.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f"), F.count(F.lit(1)).alias("n_"))
    counts = stage(counts, "words")
    langs = counts.groupBy("lang").agg(F.sum("f").alias("words_"), F.count(F.when(F.col("f") >= least, 1)).alias("ids_"))
    langs = stage(langs, "langs")
    few = bounded(langs, 100_000)
    places = ranked(counts.where(F.col("f") >= least), F.col("lang"), F.col("word"))
    starts = bounded(places.groupBy("lang").agg(F.min("rank").alias("start_")), 100_000)
    words = stage(places.join(starts, "lang").select("lang", "word", "f", (F.col("rank") - F.col("start_")).alias("id"), "n_"), "ids")
    uses = chunks.select("chunk", "lang", F.posexplode("words").alias("idx", "word"))
    ids = salted_join(uses, words.select("lang", "word", "id"), ["lang", "word"], words.select("lang", "word", "n_"), F.col("chunk"))
    ids = ids.groupBy("chunk").agg(F.collect_list(F.struct("idx", "id")).alias("ids"))  # no more than a chunk's words
    ready = chunks.select("chunk", "lang", "tokens").join(ids, "chunk").join(few, "lang")
    made = filters(ready, sizes, entries, fan)
    biggest = langs.agg(F.max("words_"), F.max("ids_"), F.sum("words_")).first()
    bits = bucket_bits(biggest[0] or 0, max(1, (biggest[1] or 0).bit_length()), entries)
    tasks = parts(spark, (biggest[2] or 0) * len(sizes), entries)
    rounds = max(1, math.ceil(bits / fan))
    for k in range(rounds - 1):
        # a bucket's filters in groups of so many chunks that about `entries` entries meet
        groups = max(1, -(-(biggest[0] or 0) // entries) >> (fan * (k + 1)))
        made = made.withColumn("part", F.pmod(F.xxhash64("part", F.lit(k)), F.lit(groups)))
        made = stage(merge(_dealt(made, tasks), least, entries, fan, last=False), "filters")
    made = made.withColumn("part", F.lit(0).cast("long"))
    phrases = stage(merge(_dealt(made, tasks), least, entries, fan, last=True), "phrases")
    return words.drop("n_"), langs.select("lang", F.col("words_").alias("n")), phrases


def _dealt(rows: DataFrame, tasks: int) -> DataFrame:
    keys = ["lang", "n", "b", "bits", "used", "bucket", "part"]
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys)


def looked_up(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with the columns of right (one row a key), which is broadcast where it is counted to be small."""
    return salted_join(left, right, keys, left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_")), F.col("spread_"), rows_to_broadcast=500_000)


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of each candidate that no longer one covers."""
    word = lambda k, f: words.select("lang", F.col("id").alias(f"i{k}"), F.col("word").alias(f"w{k}"), *([F.col("f").alias(f"f{k}")] if f else []))
    score = lambda a, l, r: F.expr(f"(cast({a} as decimal(19,0)) * cast({a} as decimal(19,0))) * 1000000 div (cast({l} as decimal(19,0)) * cast({r} as decimal(19,0)))")  # noqa: E731, E741
    twos = phrases.where("n = 2").select("lang", "i1", "i2", F.col("f").alias("a"))
    threes = phrases.where("n = 3").select("lang", "i1", "i2", "i3", F.col("f").alias("a"))
    inside = threes.select("lang", F.explode(F.array(F.struct("i1", "i2"), F.struct(F.col("i2").alias("i1"), F.col("i3").alias("i2")))).alias("p"), "a")
    # One row for each pair of words, by grouping both sides together instead of joining them.
    both = twos.withColumn("longer", F.lit(None).cast("long")).unionByName(
        inside.select("lang", "p.i1", "p.i2", F.lit(None).cast("long").alias("a"), F.col("a").alias("longer")))
    free = both.groupBy("lang", "i1", "i2").agg(F.max("a").alias("a"), F.max("longer").alias("longer"))
    free = free.where("longer is null or 100 * longer < 50 * a").drop("longer")
    free = free.withColumn("spread_", F.xxhash64("i1", "i2"))
    for k in (1, 2):
        free = looked_up(free, word(k, True), ["lang", f"i{k}"])
    two = free.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score("a", "f1", "f2").alias("score"))
    threes = threes.withColumn("spread_", F.xxhash64("i1", "i2", "i3"))
    for k, f in ((1, True), (2, False), (3, True)):
        threes = looked_up(threes, word(k, f), ["lang", f"i{k}"])
    threes = looked_up(threes, twos.withColumnRenamed("a", "f12"), ["lang", "i1", "i2"])
    threes = looked_up(threes, twos.select("lang", F.col("i1").alias("i2"), F.col("i2").alias("i3"), F.col("a").alias("f23")), ["lang", "i2", "i3"])
    cut = F.least(F.struct(score("a", "f1", "f23").alias("score"), F.lit(1).alias("k")), F.struct(score("a", "f12", "f3").alias("score"), F.lit(2).alias("k")))
    three = threes.withColumn("cut", cut).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(F.col("cut.k") == 1, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(F.col("cut.k") == 1, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.col("cut.score").alias("score"),
    )
    return two.unionByName(three)


def collocations(docs: DataFrame, least: int = 10, first: int = 2000, chunk: int = CHUNK, entries: int = ENTRIES, fan: int = FAN) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `first` phrases of each language of docs (lang, text)."""
    words, langs, phrases = frequent(stage(chunked(docs, chunk), "chunks"), least, entries=entries, fan=fan)
    order = [F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")]
    places = ranked(scored(words, phrases), *order, into="place")
    starts = places.groupBy("lang").agg(F.min("place").alias("start_"))
    about = bounded(starts.join(langs, "lang"), 100_000)
    rank = F.col("place") - F.col("start_") + 1
    kept = places.join(about, "lang").withColumn("rank", rank).where(F.col("rank") <= first)
    return kept.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
