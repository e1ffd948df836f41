"""Work-queue analytics over replayed statuses: picking, summary, recovery, routing, publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

STATES = ("queued", "generating", "ready", "needs_review", "published", "superseded")


def pick(items: DataFrame, state: str, n: int) -> DataFrame:
    """The n oldest items (entity_id, status, created_at) of a state: a top-k, not a sort of all."""
    return items.where(F.col("status") == state).orderBy("created_at", "entity_id").limit(n)


def summary(items: DataFrame, attempts: DataFrame) -> DataFrame:
    """Counts of each state, the oldest queued item, and the error class of the newest attempt that failed or needs review."""
    counts = items.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATES], F.min(F.when(F.col("status") == "queued", F.col("created_at"))).alias("oldest_queued"))
    error = attempts.where("outcome in ('error', 'needs_review')").agg(F.max_by("error_class", F.struct("attempted_at", "attempt_id")).alias("latest_error"))
    return counts.join(error)


def recover(items: DataFrame) -> DataFrame:
    """Events that put stuck items back in the queue."""
    return items.where("status = 'generating'").select("entity_id", F.lit("generating").alias("from_status"), F.lit("queued").alias("to_status"), F.lit("recovered after restart").alias("reason"))


def route(results: DataFrame) -> DataFrame:
    """results (entity_id, pack_sha256, stored_sha256, retryable, fatal, valid) with the next status and the outcome."""
    outcome = (
        F.when(F.col("pack_sha256") != F.col("stored_sha256"), "hash_mismatch").when(F.col("retryable"), "retryable").when(F.col("fatal"), "fatal").when(~F.col("valid"), "invalid").otherwise("ok")
    )
    to = F.when(F.col("outcome").isin("hash_mismatch", "retryable"), "queued").when(F.col("outcome").isin("fatal", "invalid"), "needs_review").otherwise("ready")
    return results.withColumn("outcome", outcome).select("entity_id", "outcome", to.alias("to_status"))


def newest_artifact(artifacts: DataFrame) -> DataFrame:
    """Newest artifact of each insight, and whether its stored hash is that of its content."""
    newest = artifacts.groupBy("ins_id").agg(F.max_by(F.struct("artifact_id", "content", "content_sha256"), F.struct("created_at", "artifact_id")).alias("a"))
    return newest.select("ins_id", "a.artifact_id", (F.sha2("a.content", 256) == F.col("a.content_sha256")).alias("intact"))


def supersede(published: DataFrame, items: DataFrame) -> DataFrame:
    """published (entity_id, supersedes_id): events for predecessors that are themselves published."""
    old = items.select(F.col("entity_id").alias("supersedes_id"), "status")
    return published.join(old, "supersedes_id").where("status = 'published'").select(F.col("supersedes_id").alias("entity_id"), F.col("entity_id").alias("by_id"), F.lit("published").alias("from_status"), F.lit("superseded").alias("to_status"))


def drained(routed: DataFrame, published: DataFrame) -> DataFrame:
    """How a drain ended: published, needs_review, requeued and failed items."""
    done = routed.join(published.select("entity_id").distinct().withColumn("out", F.lit(True)), "entity_id", "left")
    return done.agg(
        F.count_if(F.col("out").isNotNull() & (F.col("to_status") == "ready")).alias("published"), F.count_if(F.col("to_status") == "needs_review").alias("needs_review"),
        F.count_if(F.col("to_status") == "queued").alias("requeued"), F.count_if(F.col("out").isNull() & (F.col("to_status") == "ready")).alias("failed"),
    )
