"""Substring dedup: Rabin-Karp hashes of all windows of `length` words.

Each run of documents gives the rolling hash of every window (64 bits, over
hashes of whole words) and a second one from other word hashes, whose first half
leads a key to its partition and whose last 16 bits go with it as a check. Keys
are shuffled in packs by bucket, and for each key the smallest document that has
it is found; every other document gets the key back. There, windows with such
keys are merged into maximal intervals and their words go. Windows are judged on
the input, so nothing depends on order.

Windows are taken as equal where they meet in a partition and 64 + 16 bits agree:
with n windows over p partitions the chance of any wrong pair is n^2 / (p 2^81),
below one in a hundred at 10^13 windows over 20,000 partitions.

Texts shorter than a window keep all words; null text has none. Rows with a
null doc_id have no place in the order: they are kept whole and remove nothing.
Rows with equal doc_id do not remove from one another, whatever their texts.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import Words, covered
from .common import parts, text_bytes
from .exchange import KEY, Flagged, Spread, batch, member, shared_keys, with_texts

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 13, bytes_per_part: int = 8_000_000, most_partitions: int = 20_000, with_kept_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text (the kept words joined by one space; null unless with_kept_text)."""
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    to = Spread.over(parts(docs.sparkSession, text_bytes(docs), bytes_per_part), most_partitions)

    def windows(data, offsets):
        w = Words(data, offsets)
        starts, hashes = w.windows(length)
        other = w.other(starts, length)
        keys = np.empty(len(starts), KEY)
        keys["hash"], keys["check"] = hashes, other & np.uint64(0xFFFF)
        return w.rows[starts], starts, keys, other

    def keys_of(data, offsets):
        rows, _, keys, route = windows(data, offsets)
        return rows, keys, route

    def work():
        flagged, rows = Flagged(KEY), []

        def each(doc, _, raw):
            kept = raw.split()
            total, known = len(kept), flagged.of(doc)
            if len(known):
                _, starts, keys, _ = windows(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                gone = covered(total, starts[member(keys, known)], length)
                kept = [w for w, g in zip(kept, gone.tolist(), strict=True) if not g]
            joined = b" ".join(kept)
            rows.append((doc, total, total - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode() if with_kept_text else None))

        def flush(force):
            if not rows or not force and len(rows) < 2000:
                return None
            out = batch(rows, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()])
            rows.clear()
            return out

        return flagged.load, each, flush

    packs = shared_keys(docs, "doc_id", "text", keys_of, to, later_only=True, kind=KEY)
    return with_texts(packs, docs.select(F.col("doc_id").alias("doc"), F.lit(0).cast("long").alias("tag"), "text"), to, work, RESULT, kind=KEY)
