"""Queries M1-M24: every line of every document as a segment and as a claim candidate; concepts from parts, runs from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import claims as cl
from ..sources.tables import table
from .transcript_queries import FOLDED

#: A candidate is doc_id * LINES + line: no document has so many lines.
LINES = 1_000_000_000
SQL_CLAIMS = f"""d AS (SELECT doc_id, source, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    seg AS (SELECT doc_id AS transcript_version_id, unnest(range(0, len(lines))) AS ordinal, unnest(lines) AS text FROM d),
    l AS (SELECT doc_id, source, length(text) AS size, len(lines) AS n_lines, unnest(range(0, len(lines))) AS i, unnest(lines) AS line FROM d),
    l2 AS (SELECT *, size + i AS n, CASE WHEN (size + i) % 6 = 0 THEN (size + i) % (n_lines + 2) ELSE i END AS first FROM l),
    c AS (SELECT doc_id * 1000000000 + i AS candidate, n, n_lines, line AS claim_text, CASE WHEN n % 23 <> 0 THEN 'fact' END AS claim_type, CASE n % 4 WHEN 0 THEN 'speaker_statement' WHEN 1 THEN 'speaker_reasoning' ELSE 'system_evaluation' END AS layer,
        CASE WHEN n % 3 = 0 THEN NULL WHEN n % 5 = 0 THEN 'Unknown ' ELSE source END AS speaker, CASE WHEN n % 29 <> 0 THEN doc_id END AS transcript_version_id, first AS segment_start_ordinal, first + n % 2 AS segment_end_ordinal,
        n AS start_ms, n + 10 - n % 12 AS end_ms, left(line, ceil(length(line) / 2)::INT) AS exact_quote, CASE WHEN n % 31 <> 0 THEN 'https://v.example/' || doc_id END AS timestamp_url, sha256(source) AS raw_caption_sha256, n % 8 <> 0 AS from_model FROM l2),
    j AS (SELECT c.*, s.text AS segment_text, n_lines AS total_known, {FOLDED.replace('{x}', 'exact_quote')} AS q, {FOLDED.replace('{x}', 's.text')} AS t FROM c LEFT JOIN seg s ON s.transcript_version_id = c.transcript_version_id AND s.ordinal = c.segment_start_ordinal),
    k AS (SELECT *, list_filter([{', '.join(f"CASE WHEN coalesce({f}::VARCHAR, '') = '' THEN '{f}' END" for f in cl.REQUIRED)}], lambda x: x IS NOT NULL) AS missing,
        from_model AND layer = 'speaker_statement' AS r10, layer = 'speaker_statement' AND lower(trim(coalesce(speaker, ''))) IN ('', 'unknown', 'none', 'n/a') AS r4,
        len(regexp_extract_all(claim_text, '{cl.COUPLING_CN}')) + len(regexp_extract_all(claim_text, '{cl.COUPLING_EN}')) >= 2 OR len(regexp_extract_all(claim_text, '[。！？!?；;]')) >= 3 AS r5,
        transcript_version_id IS NULL OR segment_end_ordinal >= total_known OR end_ms < start_ms AS r3, coalesce(segment_text, '') = '' AS no_segment, NOT coalesce(q <> '' AND contains(t, q), false) AS r2 FROM j),
    v AS (SELECT *, CASE WHEN len(missing) > 0 THEN 'R1' WHEN r10 THEN 'R10' WHEN r4 THEN 'R4' WHEN r5 THEN 'R5' WHEN r3 THEN 'R3' WHEN no_segment THEN 'R1' WHEN r2 THEN 'R2' END AS rule_id FROM k)"""
CLAIMS = f"WITH {SQL_CLAIMS}"


def documents(spark, d) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select("doc_id", "source", text.alias("text"), F.length(text).alias("n"), F.split(text, "\n", -1).alias("lines"))


def segments(spark, d) -> DataFrame:
    return documents(spark, d).select(F.col("doc_id").alias("transcript_version_id"), F.posexplode("lines").alias("ordinal", "text"))


def candidates(spark, d) -> DataFrame:
    """A candidate a line: the line as the claim, its first half as the quote, and flaws that follow from lengths."""
    rows = documents(spark, d).select("doc_id", "source", F.col("n").alias("size"), F.size("lines").alias("n_lines"), F.posexplode("lines").alias("i", "line")).withColumn("n", F.col("size") + F.col("i"))
    n = F.col("n")
    start = F.when(n % 6 == 0, n % (F.col("n_lines") + 2)).otherwise(F.col("i"))
    return rows.select(
        (F.col("doc_id") * LINES + F.col("i")).alias("candidate"), "n", F.col("line").alias("claim_text"), F.when(n % 23 != 0, "fact").alias("claim_type"),
        F.when(n % 4 == 0, "speaker_statement").when(n % 4 == 1, "speaker_reasoning").otherwise("system_evaluation").alias("layer"),
        F.when(n % 3 == 0, None).when(n % 5 == 0, "Unknown ").otherwise(F.col("source")).alias("speaker"), F.when(n % 29 != 0, F.col("doc_id")).alias("transcript_version_id"),
        start.alias("segment_start_ordinal"), (start + n % 2).alias("segment_end_ordinal"), n.alias("start_ms"), (n + 10 - n % 12).alias("end_ms"),
        F.expr("substr(line, 1, cast(ceil(length(line) / 2) as int))").alias("exact_quote"), F.when(n % 31 != 0, F.concat(F.lit("https://v.example/"), "doc_id")).alias("timestamp_url"),
        F.sha2("source", 256).alias("raw_caption_sha256"), (n % 8 != 0).alias("from_model"),
    )


def judged(spark, d):
    return cl.judged(candidates(spark, d), segments(spark, d))


def accepted(spark, d):
    return cl.accepted(candidates(spark, d), segments(spark, d))


def rule(column: str):
    return lambda s, d: judged(s, d).select("candidate", column)


def line_of(spark, d, key: str, line=0):
    """The candidate of a line of the document that a key falls on, over all documents there are."""
    return F.col(key) % table(spark, d, "documents").count() * LINES + line


def edges(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        line_of(spark, d, "o_custkey").alias("from_candidate"), line_of(spark, d, "o_orderkey", 1).alias("to_candidate"), F.col("o_orderpriority").alias("relation"), F.when(F.col("o_orderstatus") == "F", "speaker_reasoning").otherwise("system_evaluation").alias("layer"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_custkey")).alias("transcript_version_id"), F.when(F.col("o_totalprice") < 400000, F.col("o_orderpriority")).alias("exact_quote"), "o_orderkey",
    )


EDGES = """e AS (SELECT o_custkey % (SELECT count(*) FROM documents) * 1000000000 AS from_candidate, o_orderkey % (SELECT count(*) FROM documents) * 1000000000 + 1 AS to_candidate, o_orderpriority AS relation, o_orderkey, o_orderstatus = 'F' AND NOT (o_totalprice > 100000 AND o_totalprice < 400000) AS r6 FROM orders)"""


def concepts(spark, d):
    return table(spark, d, "part").select(F.col("p_name").alias("name"), F.when(F.col("p_brand") < "Brand#2", "canonical").otherwise("proposed").alias("status"), "p_partkey", "p_brand", "p_type").withColumn("name", F.concat_ws(" ", "name", "p_brand", "p_type"))


CON = "con AS (SELECT p_name || ' ' || p_brand || ' ' || p_type AS name, CASE WHEN p_brand < 'Brand#2' THEN 'canonical' ELSE 'proposed' END AS status, p_partkey, p_brand, p_type, p_size, p_retailprice FROM part)"


def named_once(spark, d):
    return concepts(spark, d).groupBy("name").agg(F.max("status").alias("status"))


def sources(spark, d):
    return table(spark, d, "part").where("p_size > 20").select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("name")).distinct()


CLAIM_FIELDS = (*cl.REQUIRED, "speaker")


def bundles(spark, d) -> DataFrame:
    """A bundle a document: all its candidates as claims, and one item of each other kind; every tenth has an edge that is no object."""
    n = F.col("n")
    s = lambda cond, value: F.when(cond, value).otherwise(F.lit(""))
    of = candidates(spark, d).select(F.call_function("div", F.col("candidate"), F.lit(LINES)).alias("doc_id"), "candidate", F.struct(*CLAIM_FIELDS).alias("claim"))
    claims = of.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("candidate", "claim"))), lambda x: x["claim"]).alias("claims"))  # one document's lines
    evidence = F.struct(s(n % 5 != 0, "pub").alias("publisher"), F.lit("2024-01").alias("observed_period"), s(n % 13 != 0, "hash").alias("content_sha256"))
    body = F.to_json(F.struct(
        "claims",
        F.array(F.struct(F.when(n % 3 == 0, "canonical").otherwise("proposed").alias("status"), s(n % 2 == 0, "src").alias("concept_source"))).alias("concepts"),
        F.array(F.struct(F.when(n % 2 == 0, "macro_bridge").otherwise("human").alias("evaluator"), F.when(n % 17 != 0, evidence).alias("external_evidence"))).alias("evaluations"),
        F.array(F.struct(F.when(n % 2 == 1, "speaker_reasoning").otherwise("other").alias("layer"), s(n % 11 != 0, "7").alias("transcript_version_id"), s(n % 7 != 0, "q").alias("exact_quote"))).alias("edges"),
        F.array(F.struct(s(n % 3 != 1, "cpi > 2").alias("outcome_condition"), s(n % 4 == 2, "2024-01").alias("time_window_start"), s(n % 4 == 3, "2024-12").alias("time_window_end"))).alias("forecasts"),
    ))
    odd = F.when(n % 10 == 0, F.replace(body, F.lit('"edges":['), F.lit('"edges":[42,'))).otherwise(body)
    return documents(spark, d).join(claims, "doc_id").select(F.col("doc_id").alias("bundle_id"), (n % 8 != 0).alias("from_model"), odd.alias("body"))


BUNDLES = f"""SELECT d.doc_id AS bundle_id, 'claims' AS kind, candidate % {LINES} AS index,
        CASE WHEN len(missing) > 0 THEN 'R1' WHEN d.n % 8 <> 0 AND layer = 'speaker_statement' THEN 'R10' WHEN r4 THEN 'R4' WHEN r5 THEN 'R5'
            WHEN r3 THEN 'R3' WHEN no_segment THEN 'R1' WHEN r2 THEN 'R2' ELSE 'accepted' END AS verdict
    FROM k JOIN d ON d.doc_id = candidate // {LINES}
    UNION ALL SELECT doc_id, 'concepts', 0, CASE WHEN n % 3 = 0 AND n % 2 <> 0 THEN 'R7' ELSE 'accepted' END FROM d
    UNION ALL SELECT doc_id, 'evaluations', 0, CASE WHEN n % 2 = 0 AND (n % 5 = 0 OR n % 13 = 0 OR n % 17 = 0) THEN 'R8' ELSE 'accepted' END FROM d
    UNION ALL SELECT doc_id, 'edges', CASE WHEN n % 10 = 0 THEN 1 ELSE 0 END, CASE WHEN n % 2 = 1 AND (n % 7 = 0 OR n % 11 = 0) THEN 'R6' ELSE 'accepted' END FROM d
    UNION ALL SELECT doc_id, 'edges', 0, 'R6' FROM d WHERE n % 10 = 0
    UNION ALL SELECT doc_id, 'forecasts', 0, CASE WHEN n % 3 = 1 OR n % 4 < 2 THEN 'R9' ELSE 'accepted' END FROM d"""


def m10(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_type") == "view", "human").otherwise("macro_bridge").alias("evaluator"), F.when(F.col("value") > 5, F.col("event_type")).alias("publisher"), F.when(F.col("value") < 40, F.lit("2024-01")).otherwise(F.lit("")).alias("observed_period"), F.sha2("props", 256).alias("content_sha256"))
    return e.select("event_id", cl.evaluation_without_evidence(F.col("evaluator"), "publisher", "observed_period", "content_sha256").alias("r8"))


def forecasts(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", line_of(spark, d, "o_custkey").alias("candidate"), F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.col("o_orderpriority")).alias("outcome_condition"), F.when(F.col("o_totalprice") > 300000, F.col("o_orderdate").cast("string")).alias("time_window_start"), F.when(F.col("o_totalprice") < 200000, "2024-12").alias("time_window_end"))


R9 = "(o_orderstatus = 'P' OR (o_totalprice <= 300000 AND o_totalprice >= 200000))"


def links(spark, d):
    o = table(spark, d, "lineitem")
    return o.select(line_of(spark, d, "l_partkey", F.col("l_linenumber") - 1).alias("candidate"), F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_linenumber")).alias("name"), F.element_at(F.array(*map(F.lit, ("defines", "uses", "bogus", "relates"))), (F.col("l_suppkey") % 4 + 1).cast("int")).alias("relation"))


LINKS = "ln AS (SELECT DISTINCT l_partkey % (SELECT count(*) FROM documents) * 1000000000 + l_linenumber - 1 AS candidate, l_returnflag || '-' || l_linestatus || '-' || l_linenumber AS name, ['defines', 'uses', 'bogus', 'relates'][l_suppkey % 4 + 1] AS relation FROM lineitem), good AS (SELECT candidate, name, min(relation) AS relation FROM ln WHERE relation <> 'bogus' AND candidate IN (SELECT candidate FROM v WHERE rule_id IS NULL) GROUP BY ALL)"


def known_names(spark, d):
    return table(spark, d, "lineitem").where("l_linenumber > 2").select(F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_linenumber")).alias("name")).distinct()


def anchored(spark, d):
    c = candidates(spark, d)
    rows = c.where("transcript_version_id is not null").select("claim_type", F.concat(F.lit("concept "), "candidate").alias("name"), "transcript_version_id", F.col("segment_start_ordinal").alias("ordinal"), F.when(F.col("n") % 2 == 0, F.col("exact_quote")).alias("quote"), F.when(F.col("n") % 7 == 0, "definition").alias("role"))
    return cl.anchor_sources(rows.drop("claim_type"), segments(spark, d))


def m19(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return c.where("trim(coalesce(text, '')) <> ''").select("conv_id", "turn", F.coalesce(F.nullif(F.col("role"), F.lit("system")), F.lit("unspecified")).alias("mention_type"), F.sha2("text", 256).alias("text_sha256"))


def runs(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("transcript_version_id"), F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("ok").alias("status"), F.col("o_orderdate").alias("finished_at"))


def seeds(spark, d):
    region = table(spark, d, "region").select(F.lower("r_name").alias("slug"), F.col("r_name").alias("name"))
    current = table(spark, d, "customer").groupBy(F.lower("c_mktsegment").alias("slug")).agg(F.lit("curated").alias("name")).unionByName(region.select("slug", F.when(F.col("slug") < "b", F.lit("")).otherwise(F.lit("kept")).alias("name")).where("slug <> 'europe'"))
    return cl.seed_dimension(current, region)


def m18(s, d):
    pairs, _ = cl.concept_links(links(s, d), accepted(s, d), known_names(s, d))
    return pairs


QUERIES = {
    "m1_required_fields": lambda s, d: candidates(s, d).select("candidate", F.array_join(cl.missing_fields(), ",").alias("missing")),
    "m2_model_statement": rule("r10"),
    "m3_unknown_speaker": rule("r4"),
    "m4_atomicity": rule("r5"),
    "m5_segment_range": rule("r3"),
    "m6_quote_in_segment": lambda s, d: judged(s, d).select("candidate", "no_segment", "r2"),
    "m7_first_failure": rule("rule_id"),
    "m8_edge_source": lambda s, d: edges(s, d).select("o_orderkey", cl.edge_without_source().alias("r6")),
    "m9_concept_source": lambda s, d: cl.concept_without_source(named_once(s, d), sources(s, d)),
    "m10_evaluation_evidence": m10,
    "m11_forecast_criteria": lambda s, d: forecasts(s, d).select("o_orderkey", cl.forecast_without_criteria().alias("r9")),
    "m12_bundle_validation": lambda s, d: cl.bundle_items(bundles(s, d), segments(s, d)),
    "m13_cross_binding": lambda s, d: candidates(s, d).where(F.col("transcript_version_id") == F.call_function("div", F.col("candidate"), F.lit(LINES)) + F.when(F.col("n") % 10 == 0, 1).otherwise(0)).select("candidate"),
    "m14_accepted_claims": lambda s, d: cl.fan_out(accepted(s, d))[0],
    "m14_accepted_sources": lambda s, d: cl.fan_out(accepted(s, d))[1],
    "m15_rejected_rows": lambda s, d: cl.rejected_rows(judged(s, d).where("rule_id is not null")),
    "m16_concept_upsert": lambda s, d: cl.upsert_concepts(concepts(s, d).withColumn("domain_slugs", F.array("p_brand", "p_type")), named_once(s, d).where("status = 'canonical'"))[0],
    "m16_concept_domains": lambda s, d: cl.upsert_concepts(concepts(s, d).withColumn("domain_slugs", F.array("p_brand", "p_type")), named_once(s, d))[1],
    "m17_concept_anchors": anchored,
    "m18_concept_links": m18,
    "m18_new_concepts": lambda s, d: cl.concept_links(links(s, d), accepted(s, d), known_names(s, d))[1],
    "m19_evidence_mentions": m19,
    "m20_forecast_rows": lambda s, d: forecasts(s, d).where(~cl.forecast_without_criteria()).join(accepted(s, d).select("candidate"), "candidate").select("o_orderkey", "candidate", "outcome_condition"),
    "m21_reasoning_edges": lambda s, d: cl.reasoning_edges(edges(s, d), cl.fan_out(accepted(s, d))[0].select("candidate", "claim_id")),
    "m22_analysis_once": lambda s, d: cl.unanalysed(runs(s, d), runs(s, d).where("finished_at < '1999-01-01'")),
    "m23_alias_merge": lambda s, d: cl.merge_aliases(concepts(s, d).select("name", F.col("p_brand").alias("alias")), concepts(s, d).where("p_type = 'ECONOMY'").select("name", F.col("p_brand").alias("alias")).distinct()),
    "m23_canonical_promotion": lambda s, d: cl.promote(named_once(s, d), sources(s, d)),
    "m24_dimension_seed": seeds,
}

CLM = "'clm_' || left(sha256(concat_ws('|', transcript_version_id, candidate, claim_text)), 32)"
ORACLE = {
    "m1_required_fields": f"{CLAIMS} SELECT candidate, array_to_string(missing, ',') AS missing FROM v",
    "m2_model_statement": f"{CLAIMS} SELECT candidate, r10 FROM v", "m3_unknown_speaker": f"{CLAIMS} SELECT candidate, r4 FROM v", "m4_atomicity": f"{CLAIMS} SELECT candidate, r5 FROM v", "m5_segment_range": f"{CLAIMS} SELECT candidate, r3 FROM v",
    "m6_quote_in_segment": f"{CLAIMS} SELECT candidate, no_segment, r2 FROM v", "m7_first_failure": f"{CLAIMS} SELECT candidate, rule_id FROM v",
    "m8_edge_source": f"WITH {EDGES} SELECT o_orderkey, r6 FROM e",
    "m9_concept_source": f"WITH {CON} SELECT name, max(status) AS status FROM con GROUP BY name HAVING max(status) = 'canonical' AND count(*) FILTER (p_size > 20) = 0",
    "m10_evaluation_evidence": "SELECT event_id, event_type <> 'view' AND (value <= 5 OR value >= 40) AS r8 FROM events",
    "m11_forecast_criteria": f"SELECT o_orderkey, {R9} AS r9 FROM orders",
    "m12_bundle_validation": f"{CLAIMS} {BUNDLES}",
    "m13_cross_binding": f"{CLAIMS} SELECT candidate FROM v WHERE transcript_version_id IS NOT NULL AND n % 10 <> 0",
    "m14_accepted_claims": f"{CLAIMS} SELECT {CLM} AS claim_id, candidate, claim_text, claim_type, layer FROM v WHERE rule_id IS NULL",
    "m14_accepted_sources": f"{CLAIMS} SELECT {CLM} AS claim_id, transcript_version_id, segment_start_ordinal, segment_end_ordinal, exact_quote FROM v WHERE rule_id IS NULL",
    "m15_rejected_rows": f"{CLAIMS} SELECT candidate, '[rejected:' || rule_id || '] ' || claim_text AS text, 'system_evaluation' AS layer FROM v WHERE rule_id IS NOT NULL",
    "m16_concept_upsert": f"WITH {CON} SELECT name, 'cpt_' || left(sha256(name), 32) AS concept_id FROM con GROUP BY name HAVING max(status) <> 'canonical'",
    "m16_concept_domains": f"WITH {CON} SELECT DISTINCT name, unnest([p_brand, p_type]) AS domain FROM con",
    "m17_concept_anchors": f"""{CLAIMS} SELECT 'concept ' || candidate AS name, transcript_version_id, segment_start_ordinal AS ordinal, sha256(CASE WHEN n % 2 = 0 THEN exact_quote ELSE segment_text END) AS quote_sha256, CASE WHEN n % 7 = 0 THEN 'definition' ELSE 'mention' END AS role
        FROM v WHERE NOT no_segment AND CASE WHEN n % 2 = 0 THEN NOT r2 ELSE t <> '' END""",
    "m18_concept_links": f"{CLAIMS}, {LINKS} SELECT * FROM good",
    "m18_new_concepts": f"{CLAIMS}, {LINKS} SELECT DISTINCT name FROM good WHERE name NOT IN (SELECT l_returnflag || '-' || l_linestatus || '-' || l_linenumber FROM lineitem WHERE l_linenumber > 2)",
    "m19_evidence_mentions": "SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'unspecified' ELSE role END AS mention_type, sha256(text) AS text_sha256 FROM conversations WHERE trim(coalesce(text, '')) <> ''",
    "m20_forecast_rows": f"{CLAIMS} SELECT o_orderkey, candidate, o_orderpriority AS outcome_condition FROM orders JOIN v ON candidate = o_custkey % (SELECT count(*) FROM documents) * 1000000000 WHERE rule_id IS NULL AND NOT {R9}",
    "m21_reasoning_edges": f"{CLAIMS}, {EDGES}, i AS (SELECT candidate, {CLM} AS claim_id FROM v WHERE rule_id IS NULL) SELECT DISTINCT a.claim_id AS from_id, b.claim_id AS to_id, relation FROM e JOIN i a ON a.candidate = from_candidate JOIN i b ON b.candidate = to_candidate WHERE NOT r6",
    "m22_analysis_once": "SELECT o_custkey AS transcript_version_id, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS run_id FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING max(o_orderdate) >= '1999-01-01'",
    "m23_alias_merge": f"WITH {CON} SELECT DISTINCT name, p_brand AS alias FROM con EXCEPT SELECT name, p_brand FROM con WHERE p_type = 'ECONOMY'",
    "m23_canonical_promotion": f"WITH {CON} SELECT name, CASE WHEN max(status) = 'proposed' AND count(*) FILTER (p_size > 20) > 0 THEN 'canonical' ELSE max(status) END AS status FROM con GROUP BY 1",
    "m24_dimension_seed": "SELECT lower(r_name) AS slug, CASE WHEN lower(r_name) < 'b' OR lower(r_name) = 'europe' THEN r_name ELSE 'kept' END AS name FROM region UNION ALL SELECT DISTINCT lower(c_mktsegment), 'curated' FROM customer",
}
