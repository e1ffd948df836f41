"""Change detection over content-addressed snapshots (source, series, period, content)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

KEY = ["source", "series"]


def content_address(text: Column) -> Column:
    return F.sha2(text, 256)


def is_new(period: Column, last: Column) -> Column:
    return last.isNull() | (period > last)


def is_revision(period: Column, digest: Column, last: Column, known: Column) -> Column:
    """Same period and another, known hash; an empty or missing stored hash never makes a revision."""
    return F.coalesce((period == last) & (known != "") & (digest != known), F.lit(False))


def classify(batch: DataFrame, state: DataFrame) -> DataFrame:
    """batch (source, series, period, digest) with class new, revision or same, against state (.., last_period, last_digest)."""
    joined = batch.join(state, KEY, "left")
    new, revised = is_new(F.col("period"), F.col("last_period")), is_revision(F.col("period"), F.col("digest"), F.col("last_period"), F.col("last_digest"))
    return joined.withColumn("class", F.when(new, "new").when(revised, "revision").otherwise("same")).select(*batch.columns, "class")


def advance(state: DataFrame, classified: DataFrame) -> DataFrame:
    """State after a batch: the changed row of the newest period (then of the highest seq) replaces a key's entry."""
    changed = classified.where("class <> 'same'").select(*KEY, F.col("period").alias("last_period"), F.col("digest").alias("last_digest"), "seq")
    rows = state.withColumn("seq", F.lit(-1).cast("long")).unionByName(changed.withColumn("seq", F.col("seq").cast("long")))
    order = F.struct("last_period", "seq")
    return rows.groupBy(*KEY).agg(F.max("last_period").alias("last_period"), F.max_by("last_digest", order).alias("last_digest"))


def replay(snapshots: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Class of each snapshot (.., seq) as if classified and advanced one by one in order of seq, from a state if there is one.

    The state's period is the running maximum; a snapshot of that period meets
    the hash of the one before it with the same period, as every later one of
    the period was then the newest. A state is a snapshot before all others.
    """
    w = W.partitionBy(*KEY).orderBy("first_", "seq")
    same_period = W.partitionBy(*KEY, "period").orderBy("first_", "seq")
    rows = snapshots.withColumn("first_", F.lit(1))
    if state is not None:
        start = state.select(*KEY, F.col("last_period").alias("period"), F.col("last_digest").alias("digest"), F.lit(0).alias("first_"))
        rows = rows.unionByName(start, allowMissingColumns=True)
    before = {"last_period": F.max("period").over(w.rowsBetween(W.unboundedPreceding, -1)), "last_digest": F.lag("digest").over(same_period)}
    rows = rows.withColumns(before).where("first_ = 1")
    new, revised = is_new(F.col("period"), F.col("last_period")), is_revision(F.col("period"), F.col("digest"), F.col("last_period"), F.col("last_digest"))
    return rows.withColumn("class", F.when(new, "new").when(revised, "revision").otherwise("same")).select(*snapshots.columns, "class")
