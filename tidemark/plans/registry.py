"""All registered queries of the engine and their SQL counterparts."""

from __future__ import annotations

from . import backfill_queries, claim_queries, corpus_queries, extract_queries, ledger_queries, pack_queries, series_queries, transcript_queries

PARTS = [series_queries, ledger_queries, transcript_queries, corpus_queries, extract_queries, claim_queries, pack_queries, backfill_queries]
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in PARTS for name, sql in part.ORACLE.items()}


def flagship(spark, sf_dir):
    """Latest value, changes and trend of each series, with the rules that it fires."""
    from pyspark.sql import functions as F

    from ..operators import rules

    stats = series_queries.stats(spark, sf_dir)
    fired = rules.single_rules(stats, series_queries.rules_of(spark, series_queries.SINGLE + series_queries.RANGES))
    flags = fired.groupBy("source", "series").agg(F.count(F.lit(1)).alias("n_flags"), F.array_join(F.sort_array(F.collect_list("text")), "; ").alias("flags"))
    return stats.join(flags, ["source", "series"], "left").select("source", "series", "period", "value", "mom_pct", "yoy_pct", "trend", F.coalesce("n_flags", F.lit(0)).alias("n_flags"), F.coalesce("flags", F.lit("")).alias("flags"))
