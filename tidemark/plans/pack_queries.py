"""Queries H1-H6 and I1-I11: evidence and packs from orders, and one JSON document an order, each 16th kind of them flawed in its own way."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import gates, packs
from ..sources.tables import materialized, spread_out, table

def key_sql(x: str) -> str:
    """number_key of a value with at most two decimals."""
    c = f"(round(abs({x}) * 100))::BIGINT::VARCHAR"
    return f"CASE WHEN {x} = 0 THEN '0' WHEN {x} IS NOT NULL THEN CASE WHEN {x} < 0 THEN '-' ELSE '' END || rtrim({c}, '0') || 'e' || (len({c}) - len(rtrim({c}, '0')) - 2) END"


SQL = f"""ob AS (SELECT CASE o_orderstatus WHEN 'P' THEN 'private' ELSE 'orders' END AS source, o_orderpriority || '/' || o_orderstatus AS series, o_orderpriority AS pack_id,
        strftime(o_orderdate, '%Y-%m') AS period, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY ALL),
    hi AS (SELECT *, row_number() OVER (PARTITION BY source, series ORDER BY period DESC) AS r FROM ob QUALIFY r <= 24),
    ev AS (SELECT source, pack_id, series, 'evi_' || md5(source || ':' || series) AS evi_id, source || ':' || series AS metric_id, max(period) AS observed_period,
        arg_max(value, period) AS value, max(value) FILTER (r = 2) AS previous_value, 'EUR' AS unit, count(*) AS n_history,
        date_diff('month', (min(period) || '-01')::DATE, (max(period) || '-01')::DATE) + 1 - count(*) AS missing,
        CASE right(series, 1) WHEN 'F' THEN 'Bureau' WHEN 'P' THEN 'Agency' ELSE 'Order Office' END AS publisher, source = 'orders' AS official_primary,
        string_agg(period || '=' || value::DECIMAL(20, 2), ',' ORDER BY period) AS past, list({{'period': period, 'value': {key_sql('value')}}} ORDER BY period) AS history
        FROM hi GROUP BY source, pack_id, series),
    sp AS (SELECT a.pack_id, 'filled_less_open' AS id, a.metric_id || ' - ' || b.metric_id AS formula, a.value AS a, b.value AS b, round(a.value - b.value, 2) AS value, 'EUR' AS unit, CASE WHEN a.pack_id <> '2-HIGH' THEN 'both are flows' ELSE '' END AS note
        FROM ev a JOIN ev b ON a.pack_id = b.pack_id AND a.series = a.pack_id || '/F' AND b.series = b.pack_id || '/O' WHERE a.pack_id <> '5-LOW'),
    fl AS (SELECT DISTINCT o_orderpriority AS pack_id, 'flag ' || o_orderstatus AS flag FROM orders WHERE o_orderpriority <> '1-URGENT'),
    qg AS (SELECT pack_id, bool_and(official_primary) AS official_primary_only, count(*) FILTER (official_primary) AS official_evidence_count, count(DISTINCT publisher) FILTER (official_primary) AS independent_publisher_count,
        bool_and(official_primary) AS original_tables_first, true AS period_scope_unit_explicit, pack_id <> '2-HIGH' AS stock_flow_arithmetic_precomputed,
        count(DISTINCT publisher) FILTER (official_primary) >= 2 OR pack_id IN (SELECT pack_id FROM sp) AS cross_book_signal_present, pack_id IN (SELECT pack_id FROM fl) AS trigger_flags_are_leads FROM ev GROUP BY pack_id)"""
EV = f"WITH {SQL}"


def obs(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy(F.when(F.col("o_orderstatus") == "P", "private").otherwise("orders").alias("source"), F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("series"), F.date_format("o_orderdate", "yyyy-MM").alias("period")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))


def evidence(spark, d) -> DataFrame:
    o = obs(spark, d)
    latest = o.groupBy("source", "series").agg(F.max("period").alias("observed_period"), F.max_by("value", "period").alias("value"))
    metric = F.concat_ws(":", "source", "series")
    rows = latest.select(
        F.regexp_extract("series", "^([^/]*)/", 1).alias("pack_id"), F.concat(F.lit("evi_"), F.md5(metric)).alias("evi_id"), metric.alias("metric_id"), "observed_period", "value", F.lit("EUR").alias("unit"),
        F.when(F.col("series").endswith("F"), "Bureau").when(F.col("series").endswith("P"), "Agency").alias("publisher"),
    )
    # Series of open orders are kept as changes, under their key with _yoy.
    o = o.withColumn("series", F.when(F.col("series").endswith("/P"), F.concat("series", F.lit("_yoy"))).otherwise(F.col("series")))
    publishers = spark.createDataFrame([("orders", "Order Office", True), ("private", None, False)], "source string, source_publisher string, official boolean")
    return packs.enrich(rows, o, publishers)


def kept_evidence(spark, d) -> DataFrame:
    return materialized(evidence(spark, d), "pack-evidence")


def items(spark, d, e: DataFrame | None = None) -> DataFrame:
    """The items of packs. e: the evidence, if it is at hand."""
    e = evidence(spark, d) if e is None else e
    o = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("pack_id")).agg(F.min("o_custkey").alias("claim_id"), F.array(F.max("o_custkey"), F.lit(-1)).alias("requested"))
    return o.join(e.groupBy("pack_id").agg(F.collect_list("evi_id").alias("evidence_ids")), "pack_id")


def claims(spark, d) -> DataFrame:
    metric = F.concat(F.when(F.col("o_orderstatus") == "P", "private").otherwise("orders"), F.lit(":"), "o_orderpriority", F.lit("/"), "o_orderstatus")
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("claim_id")).agg(F.collect_set(F.concat(F.lit("evi_"), F.md5(metric))).alias("evidence_ids"))


def requested(spark, d):
    """Forecasts that a pack asks for: the last order of its priority, and one that there is not."""
    last = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("pack_id")).agg(F.max("o_orderkey").alias("last"))
    return last.select("pack_id", F.explode(F.array("last", F.lit(-2))).alias("forecast_id"))


def forecasts(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("forecast_id"), F.col("o_custkey").alias("claim_id"), F.col("o_orderstatus").alias("status"))


def h1(spark, d):
    past = F.array_join(F.transform("history", lambda x: F.concat_ws("=", x["period"], x["value"].cast("decimal(20,2)").cast("string"))), ",")
    return evidence(spark, d).select("evi_id", "metric_id", "observed_period", "value", "previous_value", "n_history", "publisher", "official_primary", past.alias("past"))


def spreads(spark, d, of: DataFrame) -> DataFrame:
    """The spread of filled and open orders of each priority but the lowest."""
    p = table(spark, d, "orders").select(F.col("o_orderpriority").alias("pack_id")).distinct().where("pack_id <> '5-LOW'")
    metric = lambda end: F.concat(F.lit("orders:"), "pack_id", F.lit(end))
    wanted = p.select("pack_id", F.lit("filled_less_open").alias("id"), metric("/F").alias("metric_a"), metric("/O").alias("metric_b"), F.lit("EUR").alias("unit"), F.when(F.col("pack_id") != "2-HIGH", "both are flows").otherwise("").alias("note"))
    return packs.derived(of, wanted)


def flags(spark, d) -> DataFrame:
    return table(spark, d, "orders").where("o_orderpriority <> '1-URGENT'").select(F.col("o_orderpriority").alias("pack_id"), F.concat(F.lit("flag "), "o_orderstatus").alias("flag")).distinct()


def h4(spark, d):
    e = evidence(spark, d)
    return packs.quality_gate(e, spreads(spark, d, e), flags(spark, d))


def h5(spark, d):
    e = kept_evidence(spark, d)
    known = materialized(claims(spark, d), "claims")
    related = materialized(packs.related_claims(materialized(items(spark, d, e), "pack-items"), known), "related-claims")
    research = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("pack_id")).agg(F.min("o_orderkey").alias("item_id"), F.count(F.lit(1)).alias("priority"))
    research = research.select("pack_id", F.concat(F.lit("rit_"), "item_id").alias("item_id"), F.lit("orders").alias("queue_source"), F.concat(F.lit("Orders of "), "pack_id").alias("title"), "priority")
    rested_on = materialized(packs.related_forecasts(related, forecasts(spark, d), requested(spark, d)), "related-forecasts")
    held = packs.members(research, e, materialized(related.join(known, "claim_id"), "pack-claims"), rested_on)
    return packs.canonical(research, e, held, spreads(spark, d, e), flags(spark, d))


def h6(spark, d):
    i = items(spark, d)
    asked = i.select("pack_id", F.lit("claim").alias("kind"), F.explode(F.col("requested").cast("array<string>")).alias("id")).unionByName(i.select("pack_id", F.lit("evidence").alias("kind"), F.explode(F.concat("evidence_ids", F.array(F.concat(F.lit("evi_"), "pack_id")))).alias("id")))
    asked = asked.unionByName(requested(spark, d).select("pack_id", F.lit("forecast").alias("kind"), F.col("forecast_id").cast("string").alias("id")))
    of = lambda kind, rows, key: rows.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"))
    known = of("claim", claims(spark, d), "claim_id").unionByName(of("evidence", evidence(spark, d), "evi_id")).unionByName(of("forecast", forecasts(spark, d), "forecast_id"))
    return packs.missing_members(asked, known)


NOBODY, NOWHERE = "evi_" + "1" * 32, "evi_" + "a" * 32


def documents(spark, d, e: DataFrame | None = None) -> DataFrame:
    """A document an order (doc_id, pack_id, k, body), k = its kind of flaw: 0 is none. e: the evidence, if it is at hand."""
    e = kept_evidence(spark, d) if e is None else e
    side = lambda end, p: e.where(F.col("metric_id").endswith(end)).select("pack_id", *[F.col(c).alias(p + c) for c in ("evi_id", "metric_id", "observed_period", "value", "previous_value", "publisher")])
    as_of = e.groupBy("pack_id").agg(F.max("observed_period").alias("as_of"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("pack_id"), (F.col("o_orderkey") % 16).alias("k"))
    # Gates take their time over each document, and the orders of a small table are one task.
    o = spread_out(o, "doc_id").join(F.broadcast(side("/F", "a_").join(side("/O", "b_"), "pack_id").join(as_of, "pack_id")), "pack_id")
    k, text = F.col("k"), lambda v: F.lit(v)
    shown = lambda c: F.col(c).cast("decimal(20,2)").cast("string")
    more = F.when(k == 7, " and 123456.789 more").when(k == 10, " which is guaranteed").when(k == 11, " see https://x.example").when(k == 6, f" and {NOWHERE}").otherwise("")
    row = lambda p: F.struct(F.col(p + "evi_id").alias("evidence_id"), F.col(p + "publisher").alias("publisher"), F.col(p + "observed_period").alias("period"), F.col(p + "metric_id").alias("metric"), text("EUR").alias("unit"))
    fields = {
        "headline": F.when(k == 2, "short").when(k != 1, "Orders moved this month"),
        "bottom_line": F.struct(F.concat(text("The latest reading is "), shown("a_value"), text(" after "), shown("a_previous_value"), text(" in the same series"), more).alias("text"), F.when(k == 15, "1990-01").otherwise(F.col("as_of")).alias("as_of")),
        "what_changed": F.array(F.struct(text("The value changed from the period before").alias("statement"), F.col("a_evi_id").alias("evidence_id"), (F.col("a_value") + F.when(k == 8, 1).otherwise(0)).alias("current_value"), F.col("a_previous_value").alias("previous_value"), text("EUR").alias("unit"), text("month on month").alias("comparison"))),
        "mechanism_chain": F.array(F.struct(F.when(k == 13, "derived").otherwise("observed").alias("kind"), text("Orders are recorded as they come").alias("statement"), F.array("a_evi_id").alias("supporting_ids"))),
        "supporting_evidence": F.array(F.struct(F.col("a_evi_id").alias("id"), text("The level is as the source reports it").alias("finding"))),
        "counter_evidence": F.array(F.struct(F.when(k == 5, NOBODY).when(k == 14, F.col("a_evi_id")).otherwise(F.col("b_evi_id")).alias("id"), text("The other series does not move alike").alias("finding"))),
        "alternative_explanations": F.array(F.struct(text("Seasonal effects may explain it").alias("explanation"), F.when(k == 12, " " * 10).otherwise("A seasonally adjusted series").alias("falsifier"))),
        "implications": F.array(F.struct(text("No action is needed for now").alias("statement"), text("near_term").alias("horizon"))),
        "next_checks": F.array(F.struct(text("order total").alias("metric"), F.col("a_value").alias("threshold"), text("above").alias("direction"), text("next").alias("target_period"), text("soon").alias("review_due_at"), F.col("a_evi_id").alias("source_id"))),
        "confidence": F.when(k == 3, "certain").when(k == 14, "high").otherwise("medium"),
        "limitations": F.array(text("Only totals are looked at here")),
        "source_table": F.when(k.isin(9, 14), F.array(row("a_"))).otherwise(F.array(row("a_"), row("b_"))),
        "extra": F.when(k == 4, "x"),
    }
    return o.select("doc_id", "pack_id", "k", F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()])).alias("body"))


def pack_table(e: DataFrame) -> DataFrame:
    return e.groupBy("pack_id").agg(F.collect_list("evi_id").alias("allowed_ids"), F.max("observed_period").alias("as_of"))


def numbers(e: DataFrame) -> DataFrame:
    values = F.concat(F.array("value", "previous_value"), F.transform("history", lambda x: x["value"]))
    return e.select("pack_id", F.explode(values).alias("v")).where("v is not null").select("pack_id", gates.number_key(F.col("v").cast("string")).alias("number")).distinct()


def gated(gate):
    """gate(documents, evidence), the evidence being worked out once."""
    def query(spark, d):
        e = kept_evidence(spark, d)
        return gate(documents(spark, d, e), e)

    return query


def fenced(spark, d):
    k = F.col("k")
    raw = F.when(k == 1, "[1, 2]").when(k == 2, "not json").when(k % 3 == 0, F.concat(F.lit("```json\n"), "body", F.lit("\n```\n"))).when(k % 3 == 1, F.concat(F.lit("\n"), "body", F.lit("  "))).otherwise(F.col("body"))
    docs = documents(spark, d).select("doc_id", "body", raw.alias("raw"))
    return docs.select("doc_id", gates.is_object(F.col("raw")).alias("is_object"), (gates.unfence(F.col("raw")) == F.col("body")).alias("same_as_sent"))


QUERIES = {
    "h1_evidence_enrichment": h1,
    "h2_related_claims": lambda s, d: packs.related_claims(items(s, d), claims(s, d)),
    "h3_related_forecasts": lambda s, d: packs.related_forecasts(items(s, d).select("pack_id", "claim_id"), forecasts(s, d), requested(s, d)).select("pack_id", "forecast_id", "status"),
    "h4_quality_gate": h4,
    "h5_canonical_pack": h5,
    "h6_missing_members": h6,
    "i1_shape_check": lambda s, d: gates.shape_errors(documents(s, d)),
    "i2_cited_ids": gated(lambda docs, e: gates.unknown_ids(docs, pack_table(e))),
    "i3_prose_ids": gated(lambda docs, e: gates.unknown_prose_ids(docs, pack_table(e))),
    "i4_number_traceability": gated(lambda docs, e: gates.untraceable_numbers(docs, numbers(e))),
    "i5_changed_values": gated(gates.changed_mismatch),
    "i6_source_table": gated(gates.source_table_errors),
    "i7_language_screen": lambda s, d: gates.language_errors(documents(s, d)),
    "i8_empty_narrative": lambda s, d: gates.empty_fields(documents(s, d)),
    "i9_causality_confidence": gated(lambda docs, e: gates.quality_errors(docs, e, pack_table(e))),
    "i10_verdict": gated(lambda docs, e: gates.verdicts(docs, pack_table(e), e, numbers(e))),
    "i11_fenced_json": fenced,
}

SHAPE = {1: ("$", "field is absent: headline"), 2: ("$.headline", "shorter than 8 characters"), 3: ("$.confidence", "none of the allowed values"), 4: ("$.extra", "field is not known")}
UNEVEN = "source_table and the evidence cited are not the same ids"
FLAWS = [
    (5, "I2", f"cites what the pack does not have: {NOBODY}"), (6, "I3", f"text names an id out of the pack: {NOWHERE}"), (7, "I4", "text has a number that the pack does not state: 123456.789"),
    (8, "I5", "what_changed[0].current_value differs from the evidence"), (5, "I6", UNEVEN), (6, "I6", UNEVEN), (9, "I6", UNEVEN),
    (10, "I7", "claims certainty: guaranteed"), (11, "I7", "has a link, an image or HTML"), (12, "I8", "falsifier has no text"),
    (13, "I9", "mechanism_chain[0] is derived from fewer than two pieces of evidence"), (14, "I9", "is confident with fewer than two publishers"), (15, "I9", "as_of is not that of the pack"),
]
quote = lambda x: "'" + x.replace("'", "''") + "'"
FLAW_ROWS = ", ".join(f"({k}, {quote(g)}, {quote(e)})" for k, g, e in FLAWS + [(k, "I1", f"{loc}: {e}") for k, (loc, e) in SHAPE.items()])
FLAWED = f"WITH f(k, gate, error) AS (VALUES {FLAW_ROWS})"
gate_sql = lambda g: f"{FLAWED} SELECT o_orderkey AS doc_id, gate, error FROM orders JOIN f ON k = o_orderkey % 16 WHERE gate = '{g}'"

ORACLE = {
    "h1_evidence_enrichment": f"{EV} SELECT evi_id, metric_id, observed_period, value, previous_value, n_history, publisher, official_primary, past FROM ev",
    "h2_related_claims": "SELECT DISTINCT o_orderpriority AS pack_id, o_custkey AS claim_id FROM orders",
    "h3_related_forecasts": "WITH m AS (SELECT o_orderpriority AS pack_id, min(o_custkey) AS claim_id FROM orders GROUP BY 1) SELECT pack_id, o_orderkey AS forecast_id, o_orderstatus AS status FROM m JOIN orders ON o_custkey = claim_id UNION SELECT o_orderpriority, o_orderkey, o_orderstatus FROM orders QUALIFY o_orderkey = max(o_orderkey) OVER (PARTITION BY o_orderpriority)",
    "h4_quality_gate": f"{EV} SELECT * FROM qg",
    "h5_canonical_pack": f"""{EV}, m AS (SELECT o_orderpriority AS pack_id, min(o_custkey) AS claim_id, min(o_orderkey) AS item, count(*) AS priority FROM orders GROUP BY 1),
        rel AS (SELECT DISTINCT o_orderpriority AS pack_id, o_custkey AS claim_id FROM orders),
        cited AS (
            SELECT o_custkey AS claim_id, list_sort(list(DISTINCT 'evi_' || md5(CASE o_orderstatus WHEN 'P' THEN 'private:' ELSE 'orders:' END || o_orderpriority || '/' || o_orderstatus))) AS evidence_ids
            FROM orders GROUP BY 1),
        fc AS (SELECT pack_id, o_orderkey, o_custkey, o_orderstatus FROM rel JOIN orders ON o_custkey = claim_id),
        mem AS (
            SELECT pack_id, 'claims' AS section, claim_id::VARCHAR AS id, to_json({{'id': claim_id::VARCHAR, 'evidence_ids': evidence_ids}})::VARCHAR AS json FROM rel JOIN cited USING (claim_id)
            UNION ALL SELECT pack_id, 'forecasts', o_orderkey::VARCHAR, to_json({{'id': o_orderkey::VARCHAR, 'claim_id': o_custkey::VARCHAR, 'status': o_orderstatus}})::VARCHAR FROM fc
            UNION ALL SELECT pack_id, 'allowed', id, id FROM (
                SELECT pack_id, evi_id AS id FROM ev UNION SELECT pack_id, claim_id::VARCHAR FROM rel UNION SELECT pack_id, o_orderkey::VARCHAR FROM fc UNION SELECT pack_id, 'rit_' || item FROM m)),
        chunked AS (SELECT *, ('0x' || left(md5(id), 8))::BIGINT % ((count(*) OVER (PARTITION BY pack_id, section) + 999) // 1000) AS chunk FROM mem),
        chunks AS (SELECT pack_id, section, chunk, count(*) AS c, sha256(string_agg(json, chr(10) ORDER BY id)) AS digest FROM chunked GROUP BY ALL),
        dig AS (SELECT pack_id, section, {{'n': sum(c)::BIGINT, 'sha256': sha256(string_agg(digest, chr(10) ORDER BY chunk))}} AS held FROM chunks GROUP BY ALL),
        seen AS (SELECT pack_id, max(observed_period) AS as_of FROM ev GROUP BY 1),
        es AS (SELECT pack_id, list({{'history': history, 'id': evi_id, 'metric_id': metric_id, 'official': official_primary, 'period': observed_period, 'previous_value': {key_sql('previous_value')}, 'publisher': publisher, 'unit': unit, 'value': {key_sql('value')}}} ORDER BY evi_id) AS evidence FROM ev GROUP BY 1),
        ds AS (SELECT pack_id, list({{'id': id, 'formula': formula, 'a': {key_sql('a')}, 'b': {key_sql('b')}, 'value': {key_sql('value')}, 'unit': unit, 'note': note}}) AS derived_values FROM sp GROUP BY 1),
        gs AS (SELECT pack_id, list(flag ORDER BY flag) AS flags FROM fl GROUP BY 1),
        j AS (SELECT m.pack_id, as_of, al.held.n AS n_allowed, to_json({{'allowed': al.held, 'as_of': as_of, 'claims': cl.held, 'derived_values': coalesce(derived_values, []), 'evidence': evidence,
            'flags': coalesce(flags, []), 'forecasts': fs.held, 'frameworks': {list(packs.FRAMEWORKS)}, 'quality_gate': {{{', '.join(f"'{c}': {c}" for c in sorted(("official_primary_only", "official_evidence_count", "independent_publisher_count", "original_tables_first", "period_scope_unit_explicit", "stock_flow_arithmetic_precomputed", "cross_book_signal_present", "trigger_flags_are_leads")))}}},
            'research_item': {{'id': 'rit_' || item, 'priority': priority, 'queue_source': 'orders', 'title': 'Orders of ' || m.pack_id}}, 'version': 1}})::VARCHAR AS pack_json
            FROM m JOIN (FROM dig WHERE section = 'claims') cl USING (pack_id) JOIN (FROM dig WHERE section = 'allowed') al USING (pack_id) JOIN (FROM dig WHERE section = 'forecasts') fs USING (pack_id)
            JOIN seen USING (pack_id) JOIN es USING (pack_id) JOIN qg USING (pack_id) LEFT JOIN ds USING (pack_id) LEFT JOIN gs USING (pack_id))
        SELECT *, sha256(pack_json) AS pack_sha256 FROM j""",
    "h6_missing_members": "SELECT DISTINCT o_orderpriority AS pack_id, 'claim' AS kind, '-1' AS id FROM orders UNION ALL SELECT DISTINCT o_orderpriority, 'evidence', 'evi_' || o_orderpriority FROM orders UNION ALL SELECT DISTINCT o_orderpriority, 'forecast', '-2' FROM orders",
    "i1_shape_check": f"WITH f(k, location, error) AS (VALUES {', '.join(f'({k}, {quote(loc)}, {quote(e)})' for k, (loc, e) in SHAPE.items())}) SELECT o_orderkey AS doc_id, location, error FROM orders JOIN f ON k = o_orderkey % 16",
    "i2_cited_ids": gate_sql("I2"), "i3_prose_ids": gate_sql("I3"), "i4_number_traceability": gate_sql("I4"), "i5_changed_values": gate_sql("I5"), "i6_source_table": gate_sql("I6"), "i7_language_screen": gate_sql("I7"), "i8_empty_narrative": gate_sql("I8"), "i9_causality_confidence": gate_sql("I9"),
    "i10_verdict": f"""{FLAWED}, g AS (SELECT k, string_agg(gate || ' ' || error, '; ' ORDER BY gate, error) AS errors, bool_or(gate = 'I1') AS misshapen FROM f GROUP BY 1), {SQL},
        lacking AS (SELECT DISTINCT pack_id FROM ev WHERE missing > 0)
        SELECT o_orderkey AS doc_id, errors IS NULL AS ok, coalesce(errors, '') AS errors, CASE WHEN NOT coalesce(misshapen, false) AND pack_id IS NOT NULL THEN 'evidence of the pack lacks metrics' ELSE '' END AS warnings
        FROM orders LEFT JOIN g ON k = o_orderkey % 16 LEFT JOIN lacking ON pack_id = o_orderpriority""",
    "i11_fenced_json": "SELECT o_orderkey AS doc_id, o_orderkey % 16 NOT IN (1, 2) AS is_object, o_orderkey % 16 NOT IN (1, 2) AS same_as_sent FROM orders",
}
