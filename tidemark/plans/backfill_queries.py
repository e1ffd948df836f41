"""Queries O1-O7: line items as evidence, orders as insights, briefs rendered from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import backfill as bf
from ..sources.tables import table

SQL = """evi AS (SELECT l_orderkey * 10 + l_linenumber AS evi_id, l_orderkey AS ins_id, l_returnflag || l_linestatus || l_suppkey AS source, 'm' || l_linenumber AS metric, strftime(l_shipdate, '%Y-%m') AS period, CASE WHEN l_tax <> 0 THEN l_quantity END AS value, l_shipdate AS created_at FROM lineitem)"""
EV = f"WITH {SQL}"


def evidence(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("evi_id"), F.col("l_orderkey").alias("ins_id"), F.concat("l_returnflag", "l_linestatus", "l_suppkey").alias("source"), F.concat(F.lit("m"), "l_linenumber").alias("metric"),
        F.date_format("l_shipdate", "yyyy-MM").alias("period"), F.when(F.col("l_tax") != 0, F.col("l_quantity")).alias("value"), F.col("l_shipdate").alias("created_at"),
    )


def provenance(spark, d):
    """Links of line items with a discount."""
    return table(spark, d, "lineitem").where("l_discount > 0.04").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("evi_id"), F.col("l_orderkey").alias("ins_id")).distinct()


PROV = "prov AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS evi_id, l_orderkey AS ins_id FROM lineitem WHERE l_discount > 0.04)"


def published(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("ins_id"))


def briefs(spark, d) -> DataFrame:
    flag = F.when(F.col("o_totalprice") > 300000, "- **large order** noted\n").otherwise("")
    body = F.concat(F.lit("---\nsource: "), "o_orderpriority", F.lit("\nperiod: "), F.date_format("o_orderdate", "yyyy-MM"), F.lit("\ntags: [a, b]\n---\n\n# Brief\n- plain line\n"), flag, F.lit("- **status "), "o_orderstatus", F.lit("**\n"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("brief_id"), body.alias("body"))


def cache(spark, d) -> DataFrame:
    """The newest reading of each source and metric."""
    return evidence(spark, d).groupBy("source", "metric").agg(F.max("period").alias("period"), F.max("value").alias("yoy_pct"))


CACHE = "ca AS (SELECT source, metric, max(period) AS period, max(value) AS yoy_pct FROM evi GROUP BY ALL)"


def source_briefs(spark, d):
    return table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("brief_id"), F.concat("l_returnflag", "l_linestatus", "l_suppkey").alias("source"))


def readings(spark, d) -> DataFrame:
    """Readings of customers by segment: period by nation, a value or only a change."""
    return table(spark, d, "customer").select(
        F.concat(F.lit("s"), "c_nationkey").alias("source"), F.concat(F.lit("c"), "c_custkey").alias("metric"), F.when((F.col("c_nationkey") % 3 == 0) & (F.col("c_acctbal") > 9000), "1999-02").otherwise("1999-01").alias("period"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("value"), F.when(F.col("c_acctbal") < -500, F.lit(1.5)).alias("yoy"),
    )


def stored(spark, d):
    return table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("s"), "c_nationkey").alias("source"), F.concat(F.lit("c"), "c_custkey").alias("metric"), F.lit("1999-01").alias("period"), F.when(F.col("c_acctbal") < 5000, F.col("c_acctbal")).alias("value"))


def official(spark, d):
    return table(spark, d, "lineitem").where("l_linestatus = 'O'").select(F.concat("l_returnflag", "l_linestatus", "l_suppkey").alias("source")).distinct()


def periods(spark, d):
    return bf.published_periods(evidence(spark, d).drop("ins_id"), provenance(spark, d), published(spark, d))


QUERIES = {
    "o1_brief_parse": lambda s, d: bf.parse_briefs(briefs(s, d)),
    "o2_published_periods": periods,
    "o3_legacy_or_iteration": lambda s, d: bf.iterations(source_briefs(s, d).distinct(), cache(s, d), periods(s, d)),
    "o4_evidence_rebuild": lambda s, d: bf.rebuild(readings(s, d), stored(s, d)),
    "o4_one_evidence_each": lambda s, d: bf.one_each(evidence(s, d).distinct()).select("source", "metric", "period", "evi_id", "value"),
    "o5_missed_queue": lambda s, d: bf.missed(evidence(s, d), provenance(s, d)),
    "o6_update_reconstruction": lambda s, d: bf.reconstruct(evidence(s, d).select("source", "metric", "period", "value"), cache(s, d)),
    "o7_requeue": lambda s, d: bf.requeue(provenance(s, d), evidence(s, d).select("evi_id", "source").distinct(), official(s, d)),
}

PERIODS = "pp AS (SELECT DISTINCT source, period FROM evi JOIN prov USING (evi_id) WHERE prov.ins_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))"
ORACLE = {
    "o1_brief_parse": "SELECT o_orderkey AS brief_id, o_orderpriority AS source, strftime(o_orderdate, '%Y-%m') AS period, CASE WHEN o_totalprice > 300000 THEN 'large order|' ELSE '' END || 'status ' || o_orderstatus AS flags FROM orders",
    "o2_published_periods": f"{EV}, {PROV}, {PERIODS} SELECT * FROM pp",
    "o3_legacy_or_iteration": f"{EV}, {PROV}, {CACHE}, {PERIODS} SELECT DISTINCT evi_id AS brief_id, source, source IN (SELECT ca.source FROM ca JOIN pp USING (source, period)) AS is_iteration FROM evi",
    "o4_evidence_rebuild": """WITH r AS (SELECT 's' || c_nationkey AS source, 'c' || c_custkey AS metric, CASE WHEN c_nationkey % 3 = 0 AND c_acctbal > 9000 THEN '1999-02' ELSE '1999-01' END AS period, CASE WHEN c_acctbal > 0 THEN c_acctbal WHEN c_acctbal < -500 THEN 1.5 END AS value, c_mktsegment, c_acctbal FROM customer)
        SELECT source, metric, period, value FROM r WHERE value IS NOT NULL AND source IN (SELECT source FROM r GROUP BY 1 HAVING count(DISTINCT period) = 1) AND NOT (c_mktsegment = 'BUILDING' AND c_acctbal < 5000 AND period = '1999-01')""",
    "o4_one_evidence_each": f"{EV} SELECT source, metric, period, evi_id, value FROM (SELECT DISTINCT * FROM evi) QUALIFY row_number() OVER (PARTITION BY source, metric, period ORDER BY value IS NULL, created_at, evi_id) = 1",
    "o5_missed_queue": f"{EV}, {PROV} SELECT DISTINCT source, period FROM evi EXCEPT SELECT source, period FROM evi WHERE evi_id IN (SELECT evi_id FROM prov)",
    "o6_update_reconstruction": f"{EV}, {CACHE} SELECT source, metric, evi.period, value, CASE WHEN ca.period = evi.period THEN yoy_pct END AS yoy_pct FROM evi LEFT JOIN ca USING (source, metric)",
    "o7_requeue": f"{EV}, {PROV}, x AS (SELECT DISTINCT evi_id, source FROM evi) SELECT ins_id, count(*) AS n_evidence FROM prov JOIN x USING (evi_id) GROUP BY 1 HAVING bool_and(source IN (SELECT source FROM evi WHERE source LIKE '_O%'))",
}
