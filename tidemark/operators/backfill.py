"""Repair of queues and evidence from what was published and stored before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def parse_briefs(briefs: DataFrame) -> DataFrame:
    """briefs (brief_id, body) to (brief_id, source, period, flags): front-matter lines `key: value`, and lines `- **flag**`."""
    front = F.regexp_extract("body", "(?s)^---\\n(.*?)\\n---", 1)
    pairs = F.str_to_map(front, F.lit("\n"), F.lit(": "))
    flags = F.regexp_extract_all("body", F.lit("(?m)^- \\*\\*([^*\\n]+)\\*\\*"), 1)
    return briefs.select("brief_id", F.trim(F.try_element_at(pairs, F.lit("source"))).alias("source"), F.trim(F.try_element_at(pairs, F.lit("period"))).alias("period"), F.array_join(flags, "|").alias("flags"))


def published_periods(evidence: DataFrame, provenance: DataFrame, published: DataFrame) -> DataFrame:
    """(source, period) of evidence whose insight was ever published."""
    return evidence.join(provenance, "evi_id").join(published.select("ins_id").distinct(), "ins_id", "left_semi").select("source", "period").distinct()


def iterations(briefs: DataFrame, cache: DataFrame, published: DataFrame) -> DataFrame:
    """briefs with is_iteration: the cached period of its source is published already."""
    done = cache.join(published, ["source", "period"], "left_semi").select("source").distinct().withColumn("done", F.lit(True))
    return briefs.join(done, "source", "left").select("brief_id", "source", F.coalesce("done", F.lit(False)).alias("is_iteration"))


def rebuild(readings: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence to write for sources whose readings are of one period: value or change, unless a non-null value is there."""
    one = readings.groupBy("source").agg(F.count_distinct("period").alias("n")).where("n = 1").select("source")
    have = evidence.where("value is not null").select("source", "metric", "period").distinct()
    rows = readings.join(one, "source", "left_semi").withColumn("value", F.coalesce("value", "yoy")).where("value is not null")
    return rows.join(have, ["source", "metric", "period"], "left_anti").select("source", "metric", "period", "value")


def one_each(evidence: DataFrame) -> DataFrame:
    """One row for each (source, metric, period): a value before none, then the oldest."""
    order = W.partitionBy("source", "metric", "period").orderBy(F.col("value").isNull(), "created_at", "evi_id")
    return evidence.withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")


def missed(evidence: DataFrame, provenance: DataFrame) -> DataFrame:
    """(source, period) with evidence of which none has provenance."""
    used = evidence.join(provenance.select("evi_id").distinct(), "evi_id", "left_semi").select("source", "period").distinct()
    return evidence.select("source", "period").distinct().join(used, ["source", "period"], "left_anti")


def reconstruct(evidence: DataFrame, cache: DataFrame) -> DataFrame:
    """Updates of evidence with the cached change, taken only if the cache is of the same period."""
    held = cache.select("source", "metric", F.col("period").alias("cached"), "yoy_pct")
    joined = evidence.join(held, ["source", "metric"], "left")
    return joined.select("source", "metric", "period", "value", F.when(F.col("cached") == F.col("period"), F.col("yoy_pct")).alias("yoy_pct"))


def requeue(provenance: DataFrame, evidence: DataFrame, official: DataFrame) -> DataFrame:
    """Insights of which all evidence is of official sources now."""
    good = official.select("source").distinct().withColumn("official", F.lit(True))
    rows = provenance.join(evidence.select("evi_id", "source"), "evi_id").join(good, "source", "left")
    return rows.groupBy("ins_id").agg(F.bool_and(F.coalesce("official", F.lit(False))).alias("ok"), F.count(F.lit(1)).alias("n_evidence")).where("ok").select("ins_id", "n_evidence")
