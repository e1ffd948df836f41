"""Toxicity: learned terms and their misspellings, weighed by the words around them.

The lexicon is learned from labelled texts: words (and stems, where only the ending
varies) that occur in toxic texts and next to never in others. Texts that are copies
of each other weigh together as one: a text's weight is one over the largest number
of texts that share one of its least shingle hashes. All tokens of a text are
matched by Levenshtein automata on the lexicon's trie (lexicon.py). A hit counts by
its term's weight and its edits, less within quotation marks or beside a word of
reporting, more beside an address; these factors are parameters. A logistic model
of the sums of hits, fitted on labelled rows that the lexicon was not learned from
and held near prior weights, gives the score.

Fitted on at most `sample` labelled rows (those with the smallest hash of doc_id):
lexicon, misspellings that are ordinary words, and the logistic weights all come from them
and are bounded by it. Whole texts of all rows are scored.

Cases: null and empty texts have no hits and get the score of that; rows whose label
is null are not learned from; without labels of both kinds the lexicon is empty and
the score is the smoothed share of label 1. Repeated rows are as many rows. An empty
table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stage
from .lexicon import Lexicon

TOKEN = re.compile(r"[^\s\"'«»“”„‘’`()\[\]{}<>,.;:?/|\\…–—-]+")
AROUND = "!%&#*+=~^_"  # stripped from a token's ends, with $ and @ from its end
QUOTED = re.compile(r"\"[^\"\n]{1,400}\"|“[^”\n]{1,400}”|„[^“”\n]{1,400}[“”]|«[^»\n]{1,400}»|»[^«\n]{1,400}«")
# Words that report speech or name a word, and words that address somebody.
REPORTS = frozenset("said says saying called calling wrote writes quoted quote word words term terms slur insult means sagte schrieb nannte wort begriff dit appelé mot terme dijo escribió llamó palabra término".split())
ADDRESS = frozenset("you your you're u ur du dich dir dein deine ihr euch tu te toi vous votre ton tú ti usted ustedes tus eres".split())
STEM_LENGTHS = (4, 5, 6, 7)


class Context(NamedTuple):
    """Factors of a hit by what stands around it, in a window of so many tokens on both sides."""

    window: int = 6
    quoted: float = 0.3
    reported: float = 0.5
    addressed: float = 1.25
    edit: float = 0.6
    stem: float = 0.8


class Model(NamedTuple):
    lexicon: Lexicon
    weights: np.ndarray  # of the columns of `measures`, and a constant last
    context: Context


#: The logistic model's weights before any text is seen: direct hits, strongest hit, hits that are not exact, share of tokens, constant.
PRIOR = np.array([2.0, 4.0, -0.5, 1.0, -3.0])


def tokens(text: str) -> list[str]:
    return [w for t in TOKEN.findall(text.lower()) if (w := t.lstrip(AROUND).rstrip(AROUND + "$@"))]


def hits(text: str, lexicon: Lexicon, context: Context) -> tuple[list[tuple[str, str, int, float]], int]:
    """(token, term, edits, value) of each hit of a text, and its number of tokens."""
    low = text.lower()
    words = [w.lstrip(AROUND).rstrip(AROUND + "$@") for w in TOKEN.findall(low)]
    found = {w: hit for w in set(words) if w and (hit := lexicon.match(w))}
    if not found:
        return [], len(words)
    spans = [(m.start(), m.end()) for m in QUOTED.finditer(low)]
    starts = np.array([s for s, _ in spans] or [0])
    ends = np.array([e for _, e in spans] or [0])
    out = []
    for k, m in enumerate(TOKEN.finditer(low)):
        w = words[k]
        if w not in found:
            continue
        term, edits = found[w]
        near = words[max(0, k - context.window) : k + context.window + 1]
        value = lexicon.weights[term] * context.edit**edits
        if edits == 0 and term != w:
            value *= context.stem
        if m.start() < ends[max(0, np.searchsorted(starts, m.start(), "right") - 1)]:
            value *= context.quoted
        if not REPORTS.isdisjoint(near):
            value *= context.reported
        if not ADDRESS.isdisjoint(near):
            value *= context.addressed
        out.append((w, term, edits, value))
    return out, len(words)


def measures(found: list[tuple[str, str, int, float]], n: int) -> list[float]:
    """What the model weighs: the columns of PRIOR for the hits of a text of n tokens."""
    values = [v for *_, v in found]
    other = sum(v for w, t, _, v in found if w != t)
    return [float(np.log1p(sum(values))), max(values, default=0.0), float(np.log1p(other)), min(1.0, 20 * len(found) / max(n, 1)), 1.0]


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, prior: np.ndarray, strength: float = 0.5, rounds: int = 50) -> np.ndarray:
    """Newton's steps to logistic weights of rows that count n times, which a Gaussian holds near `prior`."""
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + strength * (w - prior)
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def chosen(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, text, label, fold of at most `sample` labelled rows: those with the smallest hash of doc_id."""
    share = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(11)), 11) / F.lit(float(1 << 53))
    known = labels.where("label is not null and doc_id is not null").select("doc_id", "label").withColumn("share", share)
    low = stage(known.where(F.col("share") * known.count() < 2 * sample), "labels")
    low = low.orderBy("share", "doc_id", "label").limit(sample)
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(low), "doc_id")
    return rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(5)))


def vocabulary(rows: DataFrame) -> DataFrame:
    """row, label, fold, words (each once), sketch (least hashes of three-word shingles) of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, text, label, fold in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                w = tokens(text)
                shingles = {hash3(*w[k : k + 3]) for k in range(max(1, len(w) - 2))}
                h = np.fromiter(shingles, np.uint64, len(shingles))
                sketch = [int(((h * np.uint64(odd)) >> np.uint64(8)).min(initial=2**56)) for odd in ODDS]
                out.append((doc_id, int(label), int(fold), list(set(w)), sketch))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["row", "label", "fold", "words", "sketch"])

    return rows.select("doc_id", "text", "label", "fold").mapInArrow(work, "row long, label int, fold int, words array<string>, sketch array<long>")


ODDS = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]


def hash3(*words: str) -> int:
    """A hash of a shingle that is the same in every process."""
    data = " ".join(words).encode()
    return zlib.crc32(data) | zlib.adler32(data) << 32


def weighed(vocab: DataFrame) -> DataFrame:
    """vocab with weight: one over the largest number of rows that share a place of the sketch."""
    each = vocab.select("row", F.posexplode("sketch").alias("at", "least"))
    sizes = each.groupBy("at", "least").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    most = each.join(F.broadcast(sizes), ["at", "least"]).groupBy("row").agg(F.max("rows").alias("rows"))  # of the sample only
    return vocab.join(F.broadcast(most), "row", "left").withColumn("weight", 1.0 / F.coalesce("rows", F.lit(1)))


def learned(words: DataFrame, toxic: float, clean: float, least: float, ratio: float, most_terms: int) -> tuple[dict, dict]:
    """Terms and stems with their weights (0 to 1) from words (word, t, c: weights of toxic and other texts)."""
    odds = lambda t, c: F.log((t + 0.1) / (toxic + 1)) - F.log((c + 0.1) / (clean + 1))
    terms = words.where(F.length("word") >= 3).withColumn("odds", odds(F.col("t"), F.col("c")))
    terms = terms.where((F.col("t") >= least) & (F.col("odds") >= F.log(F.lit(ratio))))
    heads = words.where(F.length("word") >= 5).select("word", "t", "c", F.explode(F.array(*[F.lit(k) for k in STEM_LENGTHS])).alias("k"))
    heads = heads.where(F.length("word") > F.col("k")).groupBy(F.expr("substring(word, 1, k)").alias("word"))
    stems = heads.agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.sum(F.when(F.col("t") > 0, 1).otherwise(0)).alias("forms"))
    stems = stems.withColumn("odds", odds(F.col("t"), F.col("c"))).where((F.col("forms") >= 4) & (F.col("t") >= least) & (F.col("odds") >= F.log(F.lit(2 * ratio))))
    out = []
    for table in (terms, stems):
        rows = table.orderBy(F.desc("odds"), "word").limit(most_terms).select("word", "odds").collect()
        out.append({r.word: min(1.0, r.odds / 5.0) for r in rows})
    return out[0], out[1]


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, least: float = 4.0, ratio: float = 20.0, most_terms: int = 5_000, context: Context = Context()) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, label: 0 or 1) on at most `sample` labelled rows."""
    rows = stage(chosen(docs, labels, sample), "sample")
    vocab = stage(weighed(vocabulary(rows)), "vocabulary")
    learn = vocab.where("fold > 0")
    sums = {r.label: r.w for r in learn.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    words = learn.select("label", "weight", F.explode("words").alias("word")).groupBy("word")
    words = stage(words.agg(F.sum(F.col("weight") * F.col("label")).alias("t"), F.sum(F.col("weight") * (1 - F.col("label"))).alias("c")), "words")
    terms, stems = learned(words, sums.get(1, 0.0), sums.get(0, 0.0), least, ratio, most_terms) if len(sums) == 2 else ({}, {})
    lexicon = Lexicon(terms, stems)

    def likes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [w for w in b.column(0).to_pylist() if (hit := lexicon.match(w)) and hit.term != w]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["word"])

    ordinary = words.where("c > 0 and c >= t").select("word").mapInArrow(likes, "word string").collect() if terms or stems else []
    lexicon = Lexicon(terms, stems, frozenset(r.word for r in ordinary))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [measures(*hits(t, lexicon, context)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1).cast(pa.int32())], ["x", "label"])

    held = rows.where("fold = 0").select("text", F.col("label").cast("int").alias("label")).mapInArrow(measured, "x array<double>, label int")
    table = held.groupBy("x", "label").agg(F.count(F.lit(1)).alias("n")).toArrow()
    x = np.array(table.column("x").to_pylist()).reshape(-1, len(PRIOR))
    y, n = (table.column(k).to_numpy().astype(float) for k in ("label", "n"))
    if len(sums) < 2:
        share = (sums.get(1, 0.0) + 0.5) / (sum(sums.values()) + 1)
        return Model(lexicon, np.array([0, 0, 0, 0, np.log(share / (1 - share))]), context)
    return Model(lexicon, logistic(x, y, n, PRIOR), context)


def toxicity(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """doc_id, score, predicted, n_hits, terms for every row of docs; labels: doc_id, label (0 or 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **parameters))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights, context = shared.value
        for b in batches:
            score, number, terms = [], [], []
            for text in b.column(1):
                found, n = hits(text.as_py() or "", lexicon, context)
                score.append(1 / (1 + np.exp(-np.clip(measures(found, n) @ weights, -30, 30))))
                number.append(len(found))
                terms.append(sorted({term for _, term, *_ in found}))
            kinds = (pa.float64(), pa.int64(), pa.list_(pa.string()))
            columns = [pa.array(c, k) for c, k in zip((score, number, terms), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["doc_id", "score", "n_hits", "terms"])

    found = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, score double, n_hits long, terms array<string>")
    return found.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
