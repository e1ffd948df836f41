"""Queries C1-C6, A10, G1-G14 and J1-J7 over events and observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..operators import detect, ledger, queue
from ..sources.tables import observations, table
from ..streaming.intake import intake_stream, replay_stream
from .series_queries import OBS, sql_rows

SNAP = """day AS (SELECT event_type AS series, strftime(ts, '%Y-%m-%d') AS period, count(*) || ':' || sum(('0x' || left(md5(event_id::VARCHAR), 15))::BIGINT) AS ids, bool_or(event_id % 7 = 0) AS revised FROM events GROUP BY ALL),
    rev AS (SELECT series, period, ids AS content, 0 AS rev FROM day UNION ALL SELECT series, period, ids || ':again', 1 FROM day WHERE revised
        UNION ALL SELECT series, period, ids, 2 FROM day WHERE substr(period, 9) IN ('05', '12', '20')),
    snap AS (SELECT 'events' AS source, series, period, content, rev, sha256(content) AS digest,
        row_number() OVER (PARTITION BY series ORDER BY CASE WHEN rev = 2 THEN substr(period, 1, 8) || lpad((substr(period, 9)::INT + 2)::VARCHAR, 2, '0') ELSE period END, rev, period) AS seq FROM rev)"""
STATE = """state AS (SELECT source, series, period AS last_period, digest AS last_digest FROM snap WHERE rev = 0 AND series <> 'error'
    QUALIFY row_number() OVER (PARTITION BY series ORDER BY period) = (count(*) OVER (PARTITION BY series) + 1) // 2)"""
BATCH = "batch AS (SELECT source, series, period, digest, rev FROM snap WHERE rev < 2)"
CLASSED = """classed AS (SELECT b.*, CASE WHEN last_period IS NULL OR period > last_period THEN 'new' WHEN period = last_period AND last_digest <> '' AND digest <> last_digest THEN 'revision' ELSE 'same' END AS class
    FROM batch b LEFT JOIN state USING (source, series))"""
REPLAY = """rp AS (SELECT *, max(period) OVER (PARTITION BY series ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mp, lag(digest) OVER (PARTITION BY series, period ORDER BY seq) AS ld FROM snap),
    replayed AS (SELECT source, series, period, digest, seq, CASE WHEN mp IS NULL OR period > mp THEN 'new' WHEN period = mp AND digest <> ld THEN 'revision' ELSE 'same' END AS class FROM rp)"""
#: Status that an event of a type gives to an entity of a type.
KINDS = {
    "claim": {"view": "draft", "click": "active", "signup": "active", "purchase": "superseded", "error": "draft"},
    "forecast": {"view": "draft", "click": "active", "signup": "due", "purchase": "hit", "error": "closed"},
    "generated_insight": {"view": "queued", "click": "generating", "signup": "ready", "purchase": "published", "error": "needs_review"},
}
MAP_ROWS = [(k, e, s) for k, m in KINDS.items() for e, s in m.items()]
EV = f"""mp(entity_type, event_type, to_status) AS (VALUES {sql_rows(MAP_ROWS)}),
    e0 AS (SELECT event_id AS evt_id, CASE user_id % 3 WHEN 0 THEN 'claim' WHEN 1 THEN 'forecast' ELSE 'generated_insight' END AS entity_type, user_id AS entity_id, event_type, ts AS occurred_at FROM events),
    e1 AS (SELECT e0.*, to_status, lag(to_status) OVER (PARTITION BY entity_type, entity_id ORDER BY occurred_at, evt_id) AS before FROM e0 JOIN mp USING (entity_type, event_type)),
    ev AS (SELECT evt_id, entity_type, entity_id, CASE WHEN evt_id % 11 = 0 THEN 'draft' ELSE before END AS from_status, to_status, occurred_at, before AS current FROM e1),
    ent AS (SELECT CASE c_custkey % 3 WHEN 0 THEN 'claim' WHEN 1 THEN 'forecast' ELSE 'generated_insight' END AS entity_type, c_custkey AS entity_id,
        CASE c_custkey % 3 WHEN 2 THEN 'queued' ELSE 'draft' END AS initial_status, TIMESTAMP '2023-12-01' + to_hours(CAST((c_custkey * 37) % 500 AS INTEGER)) AS created_at FROM customer),
    st AS (SELECT ent.*, coalesce(l.last, initial_status) AS status FROM ent LEFT JOIN (SELECT entity_type, entity_id, arg_max(to_status, (occurred_at, evt_id)) AS last FROM ev GROUP BY ALL) l USING (entity_type, entity_id)),
    ins AS (SELECT entity_id, status, created_at FROM st WHERE entity_type = 'generated_insight')"""
ALLOWED_SQL = f"al(entity_type, current, to_status) AS (VALUES {sql_rows([(k, a, b) for k, p in ledger.ALLOWED.items() for a, b in p])})"


def snapshots(spark, d) -> DataFrame:
    """Daily snapshots of each event type in order seq, some given again with other content, some repeated late.

    The content of a snapshot is the number of its events and the sum of hashes of their ids: an aggregate, however many they are.
    """
    hashed = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 15), 16, 10).cast("decimal(20,0)")
    day = table(spark, d, "events").groupBy(F.col("event_type").alias("series"), F.date_format("ts", "yyyy-MM-dd").alias("period")).agg(
        F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(hashed).cast("string")).alias("ids"), F.max((F.col("event_id") % 7 == 0)).alias("revised"),
    )
    rev = (
        day.select("series", "period", F.col("ids").alias("content"), F.lit(0).alias("rev"))
        .unionByName(day.where("revised").select("series", "period", F.concat("ids", F.lit(":again")).alias("content"), F.lit(1).alias("rev")))
        .unionByName(day.where("substr(period, 9) in ('05', '12', '20')").select("series", "period", F.col("ids").alias("content"), F.lit(2).alias("rev")))
    )
    at = F.when(F.col("rev") == 2, F.concat(F.substring("period", 1, 8), F.lpad((F.substring("period", 9, 2).cast("int") + 2).cast("string"), 2, "0"))).otherwise(F.col("period"))
    seq = F.row_number().over(W.partitionBy("series").orderBy(at, "rev", "period")).cast("long")
    return rev.select(F.lit("events").alias("source"), "series", "period", "content", "rev", detect.content_address(F.col("content")).alias("digest"), seq.alias("seq"))


def state(spark, d):
    """What is known when a batch comes: the snapshot of each series' middle day; nothing of one series."""
    w = W.partitionBy("series")
    old = snapshots(spark, d).where("rev = 0 and series <> 'error'").withColumns({"r": F.row_number().over(w.orderBy("period")), "n": F.count(F.lit(1)).over(w)})
    return old.where("r = (n + 1) div 2").select("source", "series", F.col("period").alias("last_period"), F.col("digest").alias("last_digest"))


def batch(spark, d):
    """All snapshots and revisions: days before the known one, that day again, and new ones."""
    return snapshots(spark, d).where("rev < 2").select("source", "series", "period", "digest", "rev")


def classified(spark, d):
    return detect.classify(batch(spark, d), state(spark, d))


def events(spark, d) -> DataFrame:
    kinds = F.broadcast(spark.createDataFrame(MAP_ROWS, "entity_type string, event_type string, to_status string"))
    kind = F.when(F.col("user_id") % 3 == 0, "claim").when(F.col("user_id") % 3 == 1, "forecast").otherwise("generated_insight")
    rows = table(spark, d, "events").select(F.col("event_id").alias("evt_id"), kind.alias("entity_type"), F.col("user_id").alias("entity_id"), "event_type", F.col("ts").alias("occurred_at")).join(kinds, ["entity_type", "event_type"])
    before = F.lag("to_status").over(W.partitionBy(*ledger.ENTITY).orderBy(*ledger.ORDER))
    return rows.withColumn("current", before).select("evt_id", "entity_type", "entity_id", F.when(F.col("evt_id") % 11 == 0, "draft").otherwise(F.col("current")).alias("from_status"), "to_status", "occurred_at", "current")


def entities(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    kind = F.when(k % 3 == 0, "claim").when(k % 3 == 1, "forecast").otherwise("generated_insight")
    made = F.expr("timestamp'2023-12-01 00:00:00' + make_interval(0, 0, 0, 0, cast((c_custkey * 37) % 500 as int))")
    return table(spark, d, "customer").select(kind.alias("entity_type"), k.alias("entity_id"), F.when(k % 3 == 2, "queued").otherwise("draft").alias("initial_status"), made.alias("created_at"))


def after_tail(spark, d):
    """(state, violations) of a replay of the earlier half of the time that goes on with the later one; every 13th event comes late."""
    log, all_ = events(spark, d), entities(spark, d).select("entity_type", "entity_id", "initial_status")
    middle = log.agg((F.min("occurred_at") + (F.max("occurred_at") - F.min("occurred_at")) / 2).alias("m")).first().m
    first = (F.col("occurred_at") < F.lit(middle)) & (F.col("evt_id") % 13 != 0)
    before = log.where(first)
    state, violations, late = ledger.resumed(ledger.replayed(before), log.where(~first), log, all_)
    standing = ledger.chain_violations(before, all_).join(late, ["entity_type", "entity_id"], "left_anti")
    return state, standing.unionByName(violations)


def g4_resumed(spark, d):
    state = after_tail(spark, d)[0].select("entity_type", "entity_id", "status")
    rows = entities(spark, d).select("entity_type", "entity_id", "initial_status").join(state, ["entity_type", "entity_id"], "left")
    return rows.select("entity_type", "entity_id", F.coalesce("status", "initial_status").alias("status"))


def items(spark, d):
    return ledger.status(entities(spark, d), events(spark, d)).where("entity_type = 'generated_insight'").select("entity_id", "status", "created_at")


def evidence(spark, d):
    """Evidence rows from observations: metric, period, content hash and value."""
    text = F.concat_ws("|", "source", "series", "period", F.col("value").cast("decimal(20,2)").cast("string"))
    return observations(spark, d).select(F.concat_ws(":", "source", "series").alias("metric_id"), F.col("period").alias("observed_period"), F.sha2(text, 256).alias("content_sha256"), "value")


EVI = "evi AS (SELECT source || ':' || series AS metric_id, period AS observed_period, sha256(source || '|' || series || '|' || period || '|' || value::DECIMAL(20, 2)::VARCHAR) AS content_sha256, value FROM obs)"
CID = lambda prefix, *cols: f"'{prefix}_' || left(sha256(concat_ws('|', {', '.join(cols)})), 32)"


def g1(spark, d):
    evi = evidence(spark, d)
    revised = evi.where("observed_period > '2001-01'").withColumn("content_sha256", F.sha2(F.concat("content_sha256", F.lit("r")), 256))
    new = ledger.insert_new(evi.unionByName(evi).unionByName(revised), evi.where("observed_period < '1999-01'"), ["metric_id", "observed_period", "content_sha256"], "evi")
    return new.select("id", "metric_id", "observed_period", "content_sha256", "value", F.lit("recorded").alias("first_status"))


def provenance(spark, d):
    """Provenance of insights: line items of orders; each should cite exactly one of evidence, claim or forecast."""
    rows = table(spark, d, "lineitem")
    return rows.select(
        F.col("l_orderkey").alias("ins_id"), F.when(F.col("l_linenumber") != 3, F.col("l_partkey")).alias("evi_id"), F.when(F.col("l_linenumber").isin(3, 5), F.col("l_suppkey")).alias("claim_id"),
        F.lit(None).cast("long").alias("forecast_id"), F.when(F.col("l_linenumber") % 2 == 0, "context").otherwise("basis").alias("role"), F.col("l_linenumber").alias("ordinal"),
    )


PROV = """prov AS (SELECT l_orderkey AS ins_id, CASE WHEN l_linenumber <> 3 THEN l_partkey END AS evi_id, CASE WHEN l_linenumber IN (3, 5) THEN l_suppkey END AS claim_id, NULL::BIGINT AS forecast_id,
    CASE WHEN l_linenumber % 2 = 0 THEN 'context' ELSE 'basis' END AS role, l_linenumber AS ordinal FROM lineitem)"""


def g7(spark, d):
    cites = table(spark, d, "events").select(F.col("user_id").alias("ins_id"), F.concat(F.lit("m"), F.col("event_id") % 40).alias("metric_id")).distinct()
    wanted = spark.range(60).select(F.concat(F.lit("m"), "id").alias("metric_id"))
    return ledger.predecessor(items(spark, d), cites, wanted)


def g9(spark, d):
    part, supplier, orders = table(spark, d, "part"), table(spark, d, "supplier"), table(spark, d, "orders")
    claims = entities(spark, d).where("entity_type = 'claim'").select(F.col("entity_id").alias("claim_id"), F.expr("array(entity_id, entity_id * 3, entity_id * 11 + 1)").alias("evidence_ids"))
    evi = part.select(F.col("p_partkey").alias("evi_id"), F.col("p_brand").alias("metric_id"))
    forecasts = supplier.select((F.col("s_suppkey") * 3).alias("claim_id"), F.col("s_suppkey").alias("forecast_id"))
    implications = orders.select(F.col("o_custkey").alias("claim_id"), F.col("o_orderkey").alias("implication_id"))
    return ledger.dossier(claims, evi, forecasts, implications, events(spark, d))


def g11(spark, d):
    orders = table(spark, d, "orders")
    request = orders.select(F.sha2(F.col("o_custkey").cast("string"), 256).alias("input_sha256"), F.lit("p1").alias("prompt_version"), F.col("o_orderpriority").alias("model")).distinct()
    keys = ["input_sha256", "prompt_version", "model"]
    existing = orders.where("o_orderstatus = 'F'").select(F.sha2(F.col("o_custkey").cast("string"), 256).alias("input_sha256"), F.lit("p1").alias("prompt_version"), F.col("o_orderpriority").alias("model")).distinct()
    return ledger.enqueue(request, existing.withColumn("id", F.concat(F.lit("old_"), F.substring("input_sha256", 1, 8), "model")), keys, "ins")


def artifacts(spark, d):
    """Artifact versions of insights: orders of a customer, with a wrong stored hash for some."""
    content = F.concat_ws("/", "o_orderkey", "o_orderpriority")
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("ins_id"), F.col("o_orderkey").alias("artifact_id"), content.alias("content"), F.when(F.col("o_orderstatus") == "P", "bad").otherwise(F.sha2(content, 256)).alias("content_sha256"), F.col("o_orderdate").alias("created_at"),
    )


def results(spark, d):
    k = F.col("entity_id")
    return items(spark, d).select(
        k, F.sha2(k.cast("string"), 256).alias("pack_sha256"), F.when(k % 7 == 0, "changed").otherwise(F.sha2(k.cast("string"), 256)).alias("stored_sha256"),
        (k % 5 == 0).alias("retryable"), (k % 11 == 0).alias("fatal"), (k % 4 != 0).alias("valid"),
    )


def attempts(spark, d):
    return table(spark, d, "events").select(
        F.col("event_id").alias("attempt_id"), F.col("user_id").alias("entity_id"), F.lit("generate").alias("stage"), F.when(F.col("event_type") == "purchase", "ok").when(F.col("event_type") == "click", "needs_review").otherwise(F.col("event_type")).alias("outcome"),
        F.when(F.col("event_type") != "purchase", F.concat(F.lit("E"), F.col("event_id") % 9)).alias("error_class"), F.col("props").alias("detail"), F.col("ts").alias("attempted_at"),
    )


RESULTS = """res AS (SELECT entity_id, CASE WHEN entity_id % 7 = 0 THEN 'hash_mismatch' WHEN entity_id % 5 = 0 THEN 'retryable' WHEN entity_id % 11 = 0 THEN 'fatal' WHEN entity_id % 4 = 0 THEN 'invalid' ELSE 'ok' END AS outcome FROM ins),
    routed AS (SELECT *, CASE WHEN outcome IN ('hash_mismatch', 'retryable') THEN 'queued' WHEN outcome IN ('fatal', 'invalid') THEN 'needs_review' ELSE 'ready' END AS to_status FROM res)"""


def deliveries(spark, d):
    """Every series as a source that delivers twice: first all observations, then those from 1995 on with a higher value.

    The first delivery of 2-HIGH and the second ones of 5-LOW and N have rows that do not parse.
    """
    name = F.concat_ws("/", "source", "series").alias("source")
    rows = observations(spark, d).withColumn("step", F.explode(F.array(F.lit(0), F.lit(1)))).where("step = 0 or period >= '1995'")
    value = (F.col("value").cast("decimal(20,2)") + F.col("step")).cast("string")
    bad = (F.col("step") == 0) & (F.col("series") == "2-HIGH") | (F.col("step") == 1) & F.col("series").isin("5-LOW", "N")
    bad = bad & (F.substring("period", 6, 2) == "04")
    return rows.select(name, "series", "period", F.when(bad, "n/a").otherwise(value).alias("value"), F.col("step").cast("long").alias("seq"), "step")


def a10(spark, d):
    """Tables after the intake of all deliveries, three files a micro-batch."""
    intake = intake_stream(deliveries(spark, d), files_per_batch=3)
    total = F.sum(F.col("value").cast("decimal(20,2)")).alias("total")
    held = intake.observations().groupBy("source", "series").agg(F.count(F.lit(1)).alias("periods"), total)
    changes = intake.changes().groupBy("source", "series").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "seq", "class", "period"))), ",").alias("changes"))
    failures = intake.failures().groupBy("source").agg(F.sum("bad").alias("bad"), F.sum("rows").alias("put_aside"))
    return held.join(intake.state(), ["source", "series"]).join(changes, ["source", "series"]).join(failures, "source", "left").select(
        "source", "series", "periods", "total", "last_period", "changes", F.coalesce("bad", F.lit(0)).alias("bad"), F.coalesce("put_aside", F.lit(0)).alias("put_aside"))


def stepped(spark, d):
    """Snapshots with half: 0 for the earlier half of each series, else 1."""
    rows = snapshots(spark, d).select("source", "series", "period", "digest", "seq")
    return rows.withColumn("half", F.when(F.col("seq") * 2 <= F.count(F.lit(1)).over(W.partitionBy("source", "series")), 0).otherwise(1))


def c6_stream(spark, d):
    """Two steps of files, the earlier half of each series' snapshots in the first; several micro-batches."""
    return replay_stream(stepped(spark, d).withColumnRenamed("half", "step"), files_per_batch=3)


def c6_from_state(spark, d):
    """The later halves as a stream whose state starts from the table that the earlier halves leave."""
    rows = stepped(spark, d)
    none = spark.createDataFrame([], "source string, series string, last_period string, last_digest string")
    state = detect.advance(none, detect.replay(rows.where("half = 0").drop("half")))
    return replay_stream(rows.where("half = 1").drop("half"), files_per_batch=3, state=state)


QUERIES = {
    "a10_incremental_intake": a10,
    "c1_content_address": lambda s, d: snapshots(s, d).select("source", "series", "period", "rev", "digest"),
    "c2_new_period": lambda s, d: batch(s, d).join(state(s, d), ["source", "series"], "left").select("source", "series", "period", "rev", detect.is_new(F.col("period"), F.col("last_period")).alias("is_new")),
    "c3_revision": lambda s, d: batch(s, d).join(state(s, d), ["source", "series"], "left").select("source", "series", "period", "rev", detect.is_revision(F.col("period"), F.col("digest"), F.col("last_period"), F.col("last_digest")).alias("is_revision")),
    "c4_classify": classified,
    "c5_state_advance": lambda s, d: detect.advance(state(s, d), classified(s, d).withColumn("seq", F.col("rev"))),
    "c6_replay": lambda s, d: detect.replay(snapshots(s, d).select("source", "series", "period", "digest", "seq")),
    "c6_replay_stream": c6_stream,
    "c6_replay_from_state": c6_from_state,
    "g1_evidence_insert": g1,
    "g2_payload_hash": lambda s, d: table(s, d, "events").select("event_id", ledger.payload_hash(user_id="user_id", event_type="event_type", note=F.lit(None).cast("string")).alias("payload_sha256")),
    "g3_chain_validation": lambda s, d: ledger.chain_violations(events(s, d), entities(s, d).select("entity_type", "entity_id", "initial_status")),
    "g3_chain_resumed": lambda s, d: after_tail(s, d)[1],
    "g4_status_resumed": g4_resumed,
    "g4_status_by_replay": lambda s, d: ledger.status(entities(s, d), events(s, d)).select("entity_type", "entity_id", "status"),
    "g5_status_by_type": lambda s, d: ledger.status(entities(s, d), events(s, d)).groupBy("entity_type", "status").agg(F.count(F.lit(1)).alias("n")),
    "g6_transition_legality": lambda s, d: ledger.legality(events(s, d).where("current is not null").select("evt_id", "entity_type", "entity_id", "current", "to_status"), entities(s, d).where("created_at >= '2023-12-06'")),
    "g7_predecessor": g7,
    "g8_failure_events": lambda s, d: ledger.failure_events(table(s, d, "events").where("event_type = 'error'").select(F.lit("events").alias("source"), F.col("user_id").cast("string").alias("series"), F.lit("parse_failed").alias("error_class"), F.col("props").alias("detail"), F.col("ts").alias("occurred_at"))),
    "g9_claim_dossier": g9,
    "g10_integrity_audit": lambda s, d: ledger.audit(provenance(s, d), table(s, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("ins_id")), ["evi_id", "claim_id", "forecast_id"], ["ins_id", "role", "ordinal"]),
    "g11_idempotent_enqueue": g11,
    "g12_provenance_append": lambda s, d: ledger.provenance_rows(table(s, d, "conversations").select(F.col("conv_id").alias("ins_id"), F.coalesce("role", F.lit("")).alias("role"), F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+").alias("refs")).where("role = 'user'")),
    "g13_entity_creation": lambda s, d: ledger.created(entities(s, d).where("entity_type = 'forecast'"), "forecast"),
    "g14_attempt_log": lambda s, d: ledger.attempt_log(attempts(s, d)),
    "j1_fifo_pick": lambda s, d: queue.pick(items(s, d), "queued", 10),
    "j2_queue_summary": lambda s, d: queue.summary(items(s, d), attempts(s, d)),
    "j3_stuck_recovery": lambda s, d: queue.recover(items(s, d)),
    "j4_outcome_routing": lambda s, d: queue.route(results(s, d)),
    "j5_latest_artifact": lambda s, d: queue.newest_artifact(artifacts(s, d)),
    "j6_supersede": lambda s, d: queue.supersede(items(s, d).select("entity_id", (F.col("entity_id") - 3).alias("supersedes_id")), items(s, d)),
    "j7_drain_counts": lambda s, d: queue.drained(queue.route(results(s, d)), items(s, d).where("created_at < '2023-12-12'")),
}

ORACLE = {
    "a10_incremental_intake": f"""WITH {OBS},
        del AS (SELECT source || '/' || series AS source, series, period, value::DECIMAL(20, 2) + step AS value, step,
            series = '2-HIGH' AND step = 0 OR series IN ('5-LOW', 'N') AND step = 1 AS fails
            FROM obs CROSS JOIN (VALUES (0), (1)) AS s(step) WHERE step = 0 OR period >= '1995'),
        good AS (SELECT * FROM del WHERE NOT fails),
        held AS (SELECT source, series, period, arg_max(value, step) AS value FROM good GROUP BY ALL),
        newest AS (SELECT source, series, step, max(period) AS period FROM good GROUP BY ALL),
        classed AS (SELECT *, row_number() OVER (PARTITION BY source, series ORDER BY step) AS k FROM newest),
        ch AS (SELECT source, series, string_agg(step || ':' || CASE WHEN k = 1 THEN 'new' ELSE 'revision' END || ':' || period, ',' ORDER BY step) AS changes FROM classed GROUP BY ALL),
        f AS (SELECT source, count(*) FILTER (substr(period, 6, 2) = '04') AS bad, count(*) AS put_aside FROM del WHERE fails GROUP BY ALL)
        SELECT source, series, count(*) AS periods, sum(value) AS total, max(period) AS last_period, any_value(changes) AS changes,
            coalesce(any_value(bad), 0) AS bad, coalesce(any_value(put_aside), 0) AS put_aside
        FROM held JOIN ch USING (source, series) LEFT JOIN f USING (source) GROUP BY ALL""",
    "c1_content_address": f"WITH {SNAP} SELECT source, series, period, rev, digest FROM snap",
    "c2_new_period": f"WITH {SNAP}, {STATE}, {BATCH} SELECT source, series, period, rev, coalesce(period > last_period, true) AS is_new FROM batch LEFT JOIN state USING (source, series)",
    "c3_revision": f"WITH {SNAP}, {STATE}, {BATCH} SELECT source, series, period, rev, coalesce(period = last_period AND digest <> last_digest, false) AS is_revision FROM batch LEFT JOIN state USING (source, series)",
    "c4_classify": f"WITH {SNAP}, {STATE}, {BATCH}, {CLASSED} SELECT * FROM classed",
    "c5_state_advance": f"""WITH {SNAP}, {STATE}, {BATCH}, {CLASSED}, n AS (SELECT source, series, last_period, last_digest, -1 AS seq FROM state UNION ALL SELECT source, series, period, digest, rev FROM classed WHERE class <> 'same')
        SELECT source, series, max(last_period) AS last_period, arg_max(last_digest, (last_period, seq)) AS last_digest FROM n GROUP BY ALL""",
    "c6_replay": f"WITH {SNAP}, {REPLAY} SELECT * FROM replayed",
    "c6_replay_stream": f"WITH {SNAP}, {REPLAY} SELECT * FROM replayed",
    "c6_replay_from_state": f"WITH {SNAP}, {REPLAY} SELECT * FROM replayed QUALIFY seq * 2 > count(*) OVER (PARTITION BY source, series)",
    "g1_evidence_insert": f"""WITH {OBS}, {EVI}, b AS (SELECT * FROM evi UNION ALL SELECT metric_id, observed_period, sha256(content_sha256 || 'r'), value FROM evi WHERE observed_period > '2001-01')
        SELECT {CID('evi', 'metric_id', 'observed_period', 'content_sha256')} AS id, metric_id, observed_period, content_sha256, value, 'recorded' AS first_status FROM b
        ANTI JOIN (SELECT * FROM evi WHERE observed_period < '1999-01') t USING (metric_id, observed_period, content_sha256)""",
    "g2_payload_hash": """SELECT event_id, sha256('{"event_type":"' || event_type || '","note":null,"user_id":' || user_id || '}') AS payload_sha256 FROM events""",
    "g3_chain_validation": f"""WITH {EV}, w AS (SELECT ev.*, lag(to_status) OVER o AS expected, row_number() OVER o AS place FROM ev WINDOW o AS (PARTITION BY entity_type, entity_id ORDER BY occurred_at, evt_id))
        SELECT entity_type, entity_id, evt_id, place, expected, from_status, CASE WHEN from_status IS DISTINCT FROM expected THEN 'discontinuous' ELSE 'invalid_first' END AS problem FROM w LEFT JOIN ent USING (entity_type, entity_id)
        WHERE from_status IS DISTINCT FROM expected OR (place = 1 AND initial_status IS NOT NULL AND to_status <> initial_status)""",
    "g4_status_resumed": f"WITH {EV} SELECT entity_type, entity_id, status FROM st",
    "g4_status_by_replay": f"WITH {EV} SELECT entity_type, entity_id, status FROM st",
    "g5_status_by_type": f"WITH {EV} SELECT entity_type, status, count(*) AS n FROM st GROUP BY ALL",
    "g6_transition_legality": f"""WITH {EV}, {ALLOWED_SQL} SELECT evt_id, entity_type, entity_id, current, to_status, CASE WHEN (entity_type, current, to_status) NOT IN (FROM al) THEN 'illegal_transition'
        WHEN entity_type = 'generated_insight' AND to_status IN ('ready', 'published') AND entity_id NOT IN (SELECT entity_id FROM ent WHERE created_at >= '2023-12-06') THEN 'artifact_missing' ELSE 'accepted' END AS verdict FROM ev WHERE current IS NOT NULL""",
    "g7_predecessor": f"""WITH {EV}, c AS (SELECT DISTINCT user_id AS ins_id, 'm' || event_id % 40 AS metric_id FROM events)
        SELECT metric_id, arg_max(ins_id, (created_at, ins_id)) AS ins_id FROM c JOIN ins ON ins_id = entity_id AND status = 'published' GROUP BY 1""",
    "g8_failure_events": "SELECT 'intake' AS entity_type, 'events/' || user_id AS entity_id, NULL::VARCHAR AS from_status, 'failed' AS to_status, 'parse_failed: ' || props AS reason, ts AS occurred_at FROM events WHERE event_type = 'error'",
    "g9_claim_dossier": f"""WITH {EV}, cl AS (SELECT entity_id AS claim_id FROM ent WHERE entity_type = 'claim'),
        ci AS (SELECT claim_id, p, CASE p WHEN 0 THEN claim_id WHEN 1 THEN claim_id * 3 ELSE claim_id * 11 + 1 END AS evi_id FROM cl, (VALUES (0), (1), (2)) v(p)),
        a AS (SELECT claim_id, string_agg(evi_id || '=' || coalesce(p_brand, 'missing'), ',' ORDER BY p) AS evidence FROM ci LEFT JOIN part ON p_partkey = evi_id GROUP BY 1),
        f AS (SELECT s_suppkey * 3 AS claim_id, string_agg(s_suppkey::VARCHAR, ',' ORDER BY s_suppkey::VARCHAR) AS forecasts FROM supplier GROUP BY 1),
        i AS (SELECT o_custkey AS claim_id, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey::VARCHAR) AS implications FROM orders GROUP BY 1),
        h AS (SELECT entity_id AS claim_id, string_agg(to_status, '>' ORDER BY occurred_at, evt_id) AS history FROM ev WHERE entity_type = 'claim' GROUP BY 1)
        SELECT claim_id, coalesce(evidence, '') AS evidence, coalesce(forecasts, '') AS forecasts, coalesce(implications, '') AS implications, coalesce(history, '') AS history
        FROM cl LEFT JOIN a USING (claim_id) LEFT JOIN f USING (claim_id) LEFT JOIN i USING (claim_id) LEFT JOIN h USING (claim_id)""",
    "g10_integrity_audit": f"""WITH {PROV} SELECT 'orphan' AS problem, concat_ws('|', ins_id, role, ordinal) AS key FROM prov WHERE ins_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
        UNION ALL SELECT 'not_exactly_one', concat_ws('|', ins_id, role, ordinal) FROM prov WHERE (evi_id IS NOT NULL)::INT + (claim_id IS NOT NULL)::INT + (forecast_id IS NOT NULL)::INT <> 1
        UNION ALL SELECT 'repeated', concat_ws('|', ins_id, role, ordinal) FROM prov GROUP BY ins_id, role, ordinal HAVING count(*) > 1""",
    "g11_idempotent_enqueue": f"""WITH r AS (SELECT DISTINCT sha256(o_custkey::VARCHAR) AS input_sha256, 'p1' AS prompt_version, o_orderpriority AS model FROM orders),
        x AS (SELECT DISTINCT sha256(o_custkey::VARCHAR) AS input_sha256, o_orderpriority AS model FROM orders WHERE o_orderstatus = 'F')
        SELECT r.input_sha256, prompt_version, r.model, CASE WHEN x.model IS NULL THEN {CID('ins', 'r.input_sha256', 'prompt_version', 'r.model')} ELSE 'old_' || left(r.input_sha256, 8) || r.model END AS id, x.model IS NULL AS created
        FROM r LEFT JOIN x ON r.input_sha256 = x.input_sha256 AND r.model = x.model""",
    "g12_provenance_append": r"""WITH w AS (SELECT conv_id AS ins_id, role, regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') AS refs FROM conversations WHERE role = 'user'),
        x AS (SELECT ins_id, role, unnest(refs) AS ref, unnest(range(0, len(refs))) AS ordinal FROM w) SELECT ins_id, ref, role, min(ordinal) AS ordinal FROM x GROUP BY ALL""",
    "g13_entity_creation": f"WITH {EV} SELECT 'forecast' AS entity_type, entity_id, NULL::VARCHAR AS from_status, initial_status AS to_status, created_at AS occurred_at FROM ent WHERE entity_type = 'forecast'",
    "g14_attempt_log": "SELECT user_id AS entity_id, 'generate' AS stage, CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'click' THEN 'needs_review' ELSE event_type END AS outcome, CASE WHEN event_type <> 'purchase' THEN 'E' || event_id % 9 END AS error_class, sha256(props) AS detail_sha256 FROM events",
    "j1_fifo_pick": f"WITH {EV} SELECT * FROM ins WHERE status = 'queued' ORDER BY created_at, entity_id LIMIT 10",
    "j2_queue_summary": f"""WITH {EV} SELECT {', '.join(f"count(*) FILTER (status = '{s}') AS {s}" for s in queue.STATES)}, min(created_at) FILTER (status = 'queued') AS oldest_queued,
        (SELECT arg_max('E' || event_id % 9, (ts, event_id)) FROM events WHERE event_type IN ('error', 'click')) AS latest_error FROM ins""",
    "j3_stuck_recovery": f"WITH {EV} SELECT entity_id, 'generating' AS from_status, 'queued' AS to_status, 'recovered after restart' AS reason FROM ins WHERE status = 'generating'",
    "j4_outcome_routing": f"WITH {EV}, {RESULTS} SELECT * FROM routed",
    "j5_latest_artifact": "SELECT o_custkey AS ins_id, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS artifact_id, max_by(o_orderstatus, (o_orderdate, o_orderkey)) <> 'P' AS intact FROM orders GROUP BY 1",
    "j6_supersede": f"WITH {EV} SELECT o.entity_id, n.entity_id AS by_id, 'published' AS from_status, 'superseded' AS to_status FROM ins n JOIN ins o ON o.entity_id = n.entity_id - 3 WHERE o.status = 'published'",
    "j7_drain_counts": f"""WITH {EV}, {RESULTS} SELECT count(*) FILTER (to_status = 'ready' AND created_at < '2023-12-12') AS published, count(*) FILTER (to_status = 'needs_review') AS needs_review,
        count(*) FILTER (to_status = 'queued') AS requeued, count(*) FILTER (to_status = 'ready' AND created_at >= '2023-12-12') AS failed FROM routed JOIN ins USING (entity_id)""",
}
ORACLE["g3_chain_resumed"] = ORACLE["g3_chain_validation"]
