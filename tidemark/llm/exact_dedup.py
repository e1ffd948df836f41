"""Exact dedup by a tree-merge of sorted digest runs [native].

Each input row is dealt to a run of about `rows_per_run` rows and enters with the
SHA-256 of its normalised text (every character of [\\x20\\x09-\\x0D] deleted; null
counts as empty), and two checks that verify the digest: a second hash of the
same text and its length. A leaf run has a row for each of its texts, with its
best identifier and count, sorted by digest.

Runs then meet in rounds, as in a binomial tree with `fan_in` branches: in each
round the runs whose numbers agree but for the last digit (to the base fan_in)
are exchanged and merged into one, sorted again, in which equal digests with
equal checks are one row that retains the smallest identifier. The last round
leaves one run. Runs are cut into `slices` by the digest's first bits, and runs
meet slice by slice, so that the root is as many sorted slices in as many tasks
and no task holds a run of all. A text that a third of all rows share comes as
at most `fan_in` rows to any merge.

The way back is the same tree: the root's answer joins the leaf rows, and these
join the documents on (run, digest), so a hot text stays split over the runs.

The best of equal texts has most code points in the original text, then the
smallest doc_id (null ids last). Repeated rows with equal doc_id: all are
returned; `kept` marks one row of each group, whose doc_id is keep_id. An empty
table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded, stage

DROPPED = "[\\x20\\x09-\\x0D]+"
CHECKS = ["text_sha256", "check", "n"]


def raw_key(text: str) -> Column:
    """A digest of the text as it stands; null is unlike any text."""
    return F.coalesce(F.sha2(text, 256), F.lit("null"))


def sorted_run(rows: DataFrame) -> DataFrame:
    """Exchange rows by (run, slice) and sort each part by digest: the order in which a merge reads them."""
    return rows.repartition("run", "slice").sortWithinPartitions("run", "slice", *CHECKS)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_run: int = 500_000, fan_in: int = 8, slices: int = 256) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, raw_sha256 (of the text as it stands); one row for each of docs."""
    plain = F.coalesce(F.col(text), F.lit(""))
    digests = docs.select(
        F.col(doc_id).alias("doc_id"), F.length(plain).alias("chars"), F.regexp_replace(plain, DROPPED, "").alias("t"), F.monotonically_increasing_id().alias("row"), raw_key(text).alias("raw_sha256"),
    ).select("doc_id", "chars", "row", "raw_sha256", F.sha2("t", 256).alias("text_sha256"), F.xxhash64("t").alias("check"), F.length("t").alias("n"))
    digests = stage(digests, "digests")
    runs, wanted = fan_in, digests.count() / rows_per_run
    while runs < wanted:
        runs *= fan_in
    dealt = digests.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int"))
    # Smallest first: most characters, then doc_id with null last, then the row as tie-break.
    best = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))
    leaves = dealt.groupBy("run", *CHECKS).agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("size"))
    leaves = stage(leaves.withColumn("slice", F.pmod(F.conv(F.substring("text_sha256", 1, 6), 16, 10).cast("int"), F.lit(slices))), "leaf-runs")
    level, left = leaves, runs
    while left > 1:
        left //= fan_in
        met = sorted_run(level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")))
        level = met.groupBy("run", "slice", *CHECKS).agg(F.min("best").alias("best"), F.sum("size").alias("size"))
    root = level.select(*CHECKS, F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), F.col("size").alias("group_size"))
    answers = leaves.select("run", *CHECKS).join(root, CHECKS)
    return dealt.join(answers, ["run", *CHECKS]).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", "raw_sha256")


def drop_copies(docs: DataFrame, ids_to_broadcast: int = 200_000) -> DataFrame:
    """The rows of docs (doc_id, text, ..) that stay; of rows equal in doc_id and text one (any, where other columns differ).

    Rows are told apart by doc_id and the SHA-256 of the text as it stands; null doc_ids are one value.
    """
    id_key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keys = exact_dedup(docs).groupBy(id_key.alias("id_key_"), F.col("raw_sha256").alias("raw_key_")).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    keys = stage(keys.where("not kept or n > 1"), "copies")
    both = ["id_key_", "raw_key_"]
    gone, repeated = (bounded(keys.where(c).select(*both), ids_to_broadcast) for c in ("not kept", "kept"))
    keyed = docs.withColumns({"id_key_": id_key, "raw_key_": raw_key("text")})
    once = keyed.join(repeated, both, "left_semi").dropDuplicates(both)
    return keyed.join(gone, both, "left_anti").join(repeated, both, "left_anti").unionByName(once).select(*docs.columns)
