"""Benchmark decontamination: a size-partitioned MinHash containment search [native].

Finds short benchmark items inside long documents: pairs whose containment,
the share of the item's distinct `gram`-word shingles that the document has, is
at least `threshold`. Words are runs of letters and digits in lower case.

Items are partitioned by size (powers of two of their number of shingles q).
The MinHash sketch of an item is its k shingles of least hash, and k is fixed
per size class so that no qualifying pair can be missed: a document may lack at
most m = q - ceil(threshold q) shingles of the item, so of the k = 2m + 2
sketched ones (m at the class's largest q) it has k - m or more. A long
document needs no sketch of its own, which a short item could not resemble; its
shingles are looked up in the sketches as they are made, in one scan without a
shuffle of text. Only hits are shuffled, counted by (document, item) and held
against k - m. Candidates are then verified by exact containment of whole
shingles, read from the candidates' texts alone.

Sketches and item shingles are broadcast only when counted to be small, else
they are joined by shuffle. An item that a third of all documents contain makes
as many result rows, each from its own document's task.

An item of fewer than `gram` words is one shingle of its own length; documents
are also cut into shingles of those lengths below `gram` that such items have.
Items without words, with null text or null item_id, and documents with null
doc_id or text give no pairs; very long texts are texts like others, and other
columns of both tables are not read. Rows of items with equal
item_id are one item with all their shingles; rows of documents with equal
doc_id are one document. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import bounded, stage


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def places(df: DataFrame, keep: list[str], lengths: list[int | Column]) -> DataFrame:
    """A row for each shingle's place: the columns `keep`, words, i (from 1) and length, for each of the lengths."""
    cut = df.select(*keep, tokens(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.size("words")
    if len(lengths) == 1:  # plain numbers are cheaper to take apart than pairs
        n = F.lit(lengths[0]) if isinstance(lengths[0], int) else lengths[0]
        return cut.where(size >= n).select(*keep, "words", n.alias("length"), F.explode(F.sequence(F.lit(1), size - (n - 1))).alias("i"))

    def of_length(n: int) -> Column:
        at = F.transform(F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1))), lambda i: F.struct(i.alias("i"), F.lit(n).alias("length")))
        return F.when(size >= n, at).otherwise(F.array().cast("array<struct<i:int,length:int>>"))

    return cut.select(*keep, "words", F.explode(F.flatten(F.array(*map(of_length, lengths)))).alias("p")).select(*keep, "words", "p.i", "p.length")


def contained(docs: DataFrame, items: DataFrame, gram: int = 5, threshold: float = 0.8, rows_to_broadcast: int = 500_000) -> DataFrame:
    """doc_id, item_id, item_shingles, hits, containment of each contaminated pair."""
    docs = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    items = items.where("item_id is not null and text is not null").select("item_id", "text")
    n_words = F.size(tokens(F.col("text")))
    short = [r.n for r in items.select(n_words.alias("n")).where(F.col("n").between(1, gram - 1)).distinct().collect()]
    in_docs, in_items = sorted({gram, *short}), [F.least(F.size("words"), F.lit(gram))]
    shingle = F.slice("words", F.col("i"), F.col("length"))
    whole = F.array_join(shingle, " ")
    of_items = places(items, ["item_id"], in_items).select("item_id", whole.alias("shingle")).distinct()
    of_items = stage(of_items, "item-shingles")
    need = lambda q: F.ceil(q * threshold - 1e-9)
    q = F.col("item_shingles")
    top = F.pow(F.lit(2), F.floor(F.log2(q)) + 1) - 1  # the largest size of the item's class
    by_hash = W.partitionBy("item_id").orderBy("h", "shingle")
    sketches = (
        of_items.withColumn("h", F.xxhash64(F.split("shingle", " ")))
        .withColumns({"item_shingles": F.count(F.lit(1)).over(W.partitionBy("item_id")), "place": F.row_number().over(by_hash)})
        .withColumn("k", F.least(q, 2 * (top - need(top)) + 2))
        .where("place <= k").select("item_id", "h", (F.col("k") - (q - need(q))).alias("least"))
    )
    sketches = stage(sketches, "sketches")
    hits = places(docs, ["doc_id"], in_docs).select("doc_id", F.xxhash64(shingle).alias("h")).join(bounded(sketches, rows_to_broadcast), "h")
    candidates = stage(hits.groupBy("doc_id", "item_id").agg(F.count_distinct("h").alias("n"), F.first("least").alias("least")).where("n >= least").select("doc_id", "item_id"), "candidates")

    suspects = docs.join(bounded(candidates.select("doc_id").distinct(), 4 * rows_to_broadcast), "doc_id", "left_semi")
    found = places(suspects, ["doc_id"], in_docs).select("doc_id", whole.alias("shingle")).join(bounded(of_items, rows_to_broadcast), "shingle")
    counts = found.groupBy("doc_id", "item_id").agg(F.count_distinct("shingle").alias("hits")).join(candidates, ["doc_id", "item_id"], "left_semi")
    sizes = of_items.groupBy("item_id").agg(F.count(F.lit(1)).alias("item_shingles"))
    return (
        counts.join(bounded(sizes, rows_to_broadcast), "item_id").where(F.col("hits") >= need(q))
        .select("doc_id", "item_id", "item_shingles", "hits", (F.col("hits") / q).alias("containment"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, gram: int = 5, threshold: float = 0.8, ids_to_broadcast: int = 1_000_000) -> DataFrame:
    """The rows of docs that contain no item."""
    found = stage(contained(docs, items, gram, threshold).select("doc_id").distinct(), "contaminated")
    return docs.join(bounded(found, ids_to_broadcast), "doc_id", "left_anti").select(*docs.columns)
