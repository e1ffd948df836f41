"""Queries K1-K14 and N1-N13: customer = video, market segment = collection, event = attempt, order = caption."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import corpus
from ..sources.tables import shared, table
from .transcript_queries import VERSIONS, analyze_attempts, versions

NOW = "2024-02-01 00:00:00"
#: Outcome that an event of a type stands for.
OUTCOMES = {"view": "success", "click": "retryable", "signup": "missing", "purchase": "tool_error", "error": "unavailable"}
OUT = "CASE event_type WHEN 'view' THEN 'success' WHEN 'click' THEN 'retryable' WHEN 'signup' THEN 'missing' WHEN 'purchase' THEN 'tool_error' ELSE 'unavailable' END"
VID = "vid AS (SELECT c_custkey AS video_id, TIMESTAMP '2023-01-01' + to_days(CAST(c_nationkey * 7 + c_custkey % 5 AS INTEGER)) AS discovered_at, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN 'unlisted' ELSE 'public' END AS availability, c_mktsegment AS collection_id FROM customer)"
CAP = "cap AS (SELECT DISTINCT o_custkey AS video_id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')"
ATT = f"att AS (SELECT event_id AS attempt_id, user_id AS video_id, CASE WHEN event_type = 'view' AND value > 20 THEN 'normalize' ELSE 'freeze' END AS stage, {OUT} AS outcome, CASE WHEN value < 30 THEN 'E' || (event_id % 13) END AS error_class, ts AS attempted_at FROM events)"
STATE = f"WITH {VID}, {CAP}, {ATT}, l AS (SELECT video_id, arg_max(outcome, (attempted_at, attempt_id)) AS outcome FROM att WHERE stage = 'freeze' GROUP BY 1), st AS (SELECT vid.*, CASE WHEN cap.video_id IS NOT NULL THEN 'frozen' ELSE coalesce(outcome, 'pending') END AS state FROM vid LEFT JOIN cap USING (video_id) LEFT JOIN l USING (video_id))"


def videos(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("video_id"), F.expr("timestamp'2023-01-01 00:00:00' + make_interval(0, 0, 0, cast(c_nationkey * 7 + c_custkey % 5 as int))").alias("discovered_at"),
        F.when(F.col("c_acctbal") >= 0, F.when(F.col("c_acctbal") < 3000, "unlisted").otherwise("public")).alias("availability"), F.col("c_mktsegment").alias("collection_id"),
    )


def captions(spark, d):
    return table(spark, d, "orders").where("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'").select(F.col("o_custkey").alias("video_id"))


def attempts(spark, d):
    outcome = F.create_map(*[F.lit(x) for kv in OUTCOMES.items() for x in kv])[F.col("event_type")]
    return table(spark, d, "events").select(
        F.col("event_id").alias("attempt_id"), F.col("user_id").alias("video_id"), F.when((F.col("event_type") == "view") & (F.col("value") > 20), "normalize").otherwise("freeze").alias("stage"), outcome.alias("outcome"),
        F.when(F.col("value") < 30, F.concat(F.lit("E"), F.col("event_id") % 13)).alias("error_class"), F.col("ts").alias("attempted_at"),
    )


def states(spark, d):
    return corpus.video_states(videos(spark, d), captions(spark, d), attempts(spark, d))


def k1(spark, d):
    c = table(spark, d, "customer")
    vid = F.when(F.col("c_nationkey") == 3, F.concat(F.lit("short"), "c_custkey")).otherwise(F.lpad(F.col("c_custkey").cast("string"), 11, "v"))
    old = c.where("c_acctbal < 5000").select(F.lpad(F.col("c_custkey").cast("string"), 11, "v").alias("video_id"), F.lit("old title").alias("title"), F.lit("private").alias("availability"), F.expr("timestamp'2023-05-05 00:00:00'").alias("discovered_at"), F.expr("timestamp'2023-05-06 00:00:00'").alias("last_seen_at"))
    seen = c.where("c_acctbal >= 0").select(vid.alias("video_id"), F.col("c_name").alias("title"), F.when(F.col("c_mktsegment") != "BUILDING", F.lower("c_mktsegment")).alias("availability"))
    return corpus.catalog_upsert(old, seen, NOW)


def k2(spark, d):
    p = table(spark, d, "pages")
    url = F.when(F.length("url") % 4 == 0, F.concat("url", F.lit("/shorts/x"))).otherwise(F.col("url"))
    live = F.when(F.col("url").contains("example.net"), "is_live").otherwise("none")
    return p.select("page_id", corpus.content_kind(url, live, F.col("url").startswith("https://m.")).alias("kind"))


def k4(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("video_id"), F.col("o_orderpriority").alias("collection_id"), "o_orderdate")
    return corpus.new_members(o.select("video_id", "collection_id"), o.where("o_orderdate < '1997-01-01'").select("video_id", "collection_id"))


def inventories(spark, d) -> DataFrame:
    """Track inventories as JSON, rendered from parts."""
    lang = F.lower(F.substring("p_type", 1, 2))
    ext = lambda x: F.struct(F.lit(x).alias("ext"))
    formats = F.when(F.col("p_size") % 3 == 0, F.array(ext("vtt"))).when(F.col("p_size") % 3 == 1, F.array(ext("json3"), ext("vtt"))).otherwise(F.array(ext("srv1"), ext("json3")))
    some = F.when(F.col("p_retailprice") > 1000, F.to_json(F.map_from_arrays(F.array(lang), F.array(formats)))).otherwise("{}")
    return table(spark, d, "part").select(F.col("p_partkey").alias("video_id"), some.alias("manual"), F.to_json(F.map_from_arrays(F.array(lang, F.lit("en")), F.array(formats, F.array(ext("json3"))))).alias("automatic"))


TRACK = """f0 AS (SELECT p_partkey AS video_id, lower(left(p_type, 2)) AS lang, p_retailprice > 1000 AS manual, CASE p_size % 3 WHEN 0 THEN ['vtt'] WHEN 1 THEN ['json3', 'vtt'] ELSE ['srv1', 'json3'] END AS exts FROM part),
    tr AS (SELECT video_id, 'manual' AS kind, lang AS language, unnest(exts) AS format FROM f0 WHERE manual UNION ALL SELECT video_id, 'auto', lang, unnest(exts) FROM f0 UNION ALL SELECT video_id, 'auto', 'en', 'json3' FROM f0)"""
PREFERRED = ("ec", "en", "la")


def k8(spark, d):
    """Error output rendered around whole documents."""
    n = F.length(F.coalesce("text", F.lit("")))
    said = F.concat(F.when(n % 5 == 0, "ERROR: Sign in to confirm ").when(n % 7 == 0, "ERROR: Private video ").otherwise("warning: "), F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").select("doc_id", corpus.exit_class(said, F.when(n % 3 == 0, 0).when(n % 3 == 1, 101).otherwise(1)).alias("class"))


def k9(spark, d):
    n = F.coalesce(F.length("text"), F.lit(0))
    said = F.concat(F.lit("open /home/user/data/file.txt at https://x.example/a?b=1 with Bearer abc.def-123 and api_key = s3cret-value; "), F.coalesce("text", F.lit("")), F.lit(" secret:hunter2hunter2 done"))
    return table(spark, d, "documents").select("doc_id", F.sha2(corpus.redact(said, 100_000_000), 256).alias("redacted_sha256"), corpus.redact(said, 120).alias("head"), n.alias("n"))


def k12(spark, d):
    """Files of up to 64 conversations written and read back as bytes, against a manifest made from the table that is wrong for some."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    c = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("video_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    body = F.regexp_replace(F.array_join(F.transform("turns", lambda x: x["text"]), " "), "[\r\n]", " ")
    c = c.select(F.call_function("div", F.col("video_id"), F.lit(64)).alias("shard"), body.alias("body"))
    folder = shared(spark, "frozen")
    c.repartition("shard").sortWithinPartitions("shard", "body").write.partitionBy("shard").text(folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(folder)
    files = files.withColumn("path", F.regexp_extract("path", "shard=([0-9-]+)", 1))
    whole = c.groupBy("shard").agg(F.concat(F.array_join(F.sort_array(F.collect_list("body")), "\n"), F.lit("\n")).alias("content"))
    k = F.col("shard")
    manifest = whole.select(
        F.when(k % 11 == 10, F.concat(k.cast("string"), F.lit("-lost"))).otherwise(k.cast("string")).alias("path"), (F.octet_length("content") + F.when(k % 5 == 4, 1).otherwise(0)).alias("byte_count"),
        F.when(k % 7 == 6, "bad").otherwise(F.sha2("content", 256)).alias("content_sha256"),
    )
    return corpus.frozen_audit(files, manifest)


def k13(spark, d):
    e = table(spark, d, "events")
    from pyspark.sql import Window as W

    outcome = F.when((F.col("event_type") == "view") & (F.col("value") < 5), "success").when((F.col("event_type") == "error") & (F.col("value") > 40), "auth_required").otherwise(F.col("event_type"))
    return corpus.fall_through(e.select(F.col("user_id").alias("video_id"), F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).alias("place"), outcome.alias("outcome")))


def runs(spark, d):
    tabs = F.to_json(F.map_from_arrays(F.array(F.lit("videos"), F.lit("shorts")), F.array(F.struct(F.when(F.col("o_orderpriority") == "2-HIGH", "failed").otherwise("ok").alias("status")), F.struct(F.when(F.col("o_totalprice") > 400000, "failed").otherwise("ok").alias("status")))))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"), F.lit("catalog").alias("kind"), F.when(F.col("o_orderstatus") == "P", "partial").otherwise("ok").alias("status"), tabs.alias("summary"))


def analyzed(spark, d):
    a, r = analyze_attempts(spark, d)
    return a.where("stage = 'analyze' and outcome = 'success'").join(r.where("status = 'success'").select("run_id"), "run_id", "left_semi").select("video_id").distinct()


def claims(spark, d):
    status = F.when(F.col("toxic") == 1, "rejected").when(F.col("quality") == 1, "accepted").otherwise("proposed")
    return table(spark, d, "labels").select(F.col("doc_id").alias("claim_id"), status.alias("status"))


def concepts(spark, d):
    return table(spark, d, "part").select(F.col("p_name").alias("name"), F.when(F.col("p_size") > 25, "canonical").otherwise("proposed").alias("status"))


def n1(s, d):
    return corpus.zero_filled(states(s, d).groupBy("state").agg(F.count(F.lit(1)).alias("n")), "state", corpus.STATES)


def n2(s, d):
    return corpus.transcript_states(videos(s, d), captions(s, d), versions(s, d))


def n3(s, d):
    return corpus.zero_filled(claims(s, d).groupBy("status").agg(F.count(F.lit(1)).alias("n")), "status", ("accepted", "needs_review", "rejected", "proposed"))


def n4(s, d):
    seeds = table(s, d, "region").agg(F.lit("seed").alias("status"), F.count(F.lit(1)).alias("n"))
    return corpus.zero_filled(concepts(s, d).groupBy("status").agg(F.count(F.lit(1)).alias("n")).unionByName(seeds), "status", ("seed", "proposed", "canonical", "deprecated"))


def n5(s, d):
    return corpus.scope_counts(versions(s, d), analyzed(s, d), "plain")


def n6(s, d):
    return corpus.count_by(videos(s, d), "availability")


def n7(s, d):
    collections = videos(s, d).select("collection_id").distinct().union(table(s, d, "region").select("r_name"))
    return corpus.collection_counts(collections, videos(s, d).select("collection_id", "video_id"))


def n11(s, d):
    scope = n5(s, d).select(F.inline(F.array(F.struct(F.lit("pending").alias("name"), F.col("pending").alias("n")), F.struct(F.lit("analyzed").alias("name"), F.col("analyzed").alias("n")))))
    return corpus.sections(captions=n1(s, d), transcripts=n2(s, d), claims=n3(s, d), concepts=n4(s, d), scope=scope, availability=n6(s, d), collections=n7(s, d))


def n12(s, d):
    from .transcript_queries import cues

    odd = cues(s, d).select(F.concat_ws("-", "video_id", "ordinal").alias("key"), "start_ms", "end_ms", "text")
    return corpus.violations(odd, "key", start_not_negative="start_ms >= 0", end_after_start="end_ms >= start_ms", text_not_empty="text <> ''")


QUERIES = {
    "k1_catalog_upsert": k1,
    "k2_content_kind": k2,
    "k3_metadata_fingerprint": lambda s, d: table(s, d, "customer").select("c_custkey", corpus.metadata_fingerprint(title="c_name", channel="c_mktsegment", nation="c_nationkey", note=F.lit(None).cast("string")).alias("fingerprint")),
    "k4_membership": k4,
    "k5_track_flatten": lambda s, d: corpus.flatten_tracks(inventories(s, d)),
    "k6_track_selection": lambda s, d: corpus.rank_tracks(corpus.flatten_tracks(inventories(s, d)).distinct(), PREFERRED),
    "k8_exit_classification": k8,
    "k9_secret_redaction": k9,
    "k10_video_state": states,
    "k11_pending_selection": lambda s, d: corpus.pending(states(s, d)),
    "k12_frozen_file_audit": k12,
    "k13_candidate_fall_through": k13,
    "k14_uncataloged": lambda s, d: corpus.uncataloged(table(s, d, "orders").select((F.col("o_custkey") + F.when(F.col("o_orderstatus") == "P", 1000).otherwise(0)).alias("video_id")), videos(s, d)),
    "n1_caption_states": n1,
    "n2_transcript_states": n2,
    "n3_claim_states": n3,
    "n4_concept_states": n4,
    "n5_analyze_scope_counts": n5,
    "n6_count_by_attribute": n6,
    "n7_count_by_collection": n7,
    "n8_oldest_pending": lambda s, d: corpus.pending(states(s, d)).agg(F.min("discovered_at").alias("oldest")),
    "n9_top_error_classes": lambda s, d: corpus.top_errors(attempts(s, d)),
    "n10_partial_run_gaps": lambda s, d: corpus.partial_gaps(runs(s, d)),
    "n11_coverage_report": n11,
    "n12_domain_audit": n12,
    "n13_analyzed_videos": lambda s, d: analyzed(s, d).agg(F.count_distinct("video_id").alias("videos")),
}

SECRET = "[A-Za-z0-9._~+/=%-]{8,}"
REDACT = rf"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({{x}}, 'https?://[^\s"''<>]+', '<redacted-url>', 'g'), '(?i)\bbearer\s+{SECRET.replace('{8,}', '{{8,}}')}', '<redacted>', 'g'), '(?i)\b(authorization|token|cookie|signature|sig|api[_-]?key|secret|access[_-]?key)\s*[:=]\s*{SECRET.replace('{8,}', '{{8,}}')}', '\1=<redacted>', 'g'), '(?:/Users|/home|/root|/private|/var|/tmp)/[^\s"''<>]+', '<redacted-path>', 'g')""".replace("{{8,}}", "{8,}")
SAID = "'open /home/user/data/file.txt at https://x.example/a?b=1 with Bearer abc.def-123 and api_key = s3cret-value; ' || coalesce(text, '') || ' secret:hunter2hunter2 done'"
DONE = "done AS (SELECT DISTINCT user_id AS video_id FROM events WHERE event_type <> 'view' AND value > 15 AND event_id % 60 % 4 <> 0)"
N = {
    "captions": f"SELECT state, coalesce(n, 0) AS n FROM (VALUES {', '.join(f'({s!r})' for s in corpus.STATES)}) v(state) FULL JOIN (SELECT state, count(*) AS n FROM st GROUP BY 1) x USING (state)",
    "transcripts": """SELECT state, coalesce(n, 0) AS n FROM (VALUES ('normalized'), ('pending_normalize'), ('no_caption')) v(state) LEFT JOIN (SELECT CASE WHEN c.video_id IS NULL THEN 'no_caption' WHEN status = 'ok' THEN 'normalized' ELSE 'pending_normalize' END AS state, count(*) AS n
        FROM vid LEFT JOIN cap c USING (video_id) LEFT JOIN (SELECT video_id, arg_max(status, (created_at, version_id)) AS status FROM ver GROUP BY 1) w USING (video_id) GROUP BY 1) x USING (state)""",
    "claims": "SELECT status, coalesce(n, 0) AS n FROM (VALUES ('accepted'), ('needs_review'), ('rejected'), ('proposed')) v(status) LEFT JOIN (SELECT CASE WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 THEN 'accepted' ELSE 'proposed' END AS status, count(*) AS n FROM labels GROUP BY 1) x USING (status)",
    "concepts": "SELECT CASE WHEN p_size > 25 THEN 'canonical' ELSE 'proposed' END AS status, count(*) AS n FROM part GROUP BY 1 UNION ALL SELECT 'seed', count(*) FROM region UNION ALL SELECT 'deprecated', 0",
    "scope": "SELECT count(*) FILTER (video_id NOT IN (FROM done)) AS pending, count(*) FILTER (video_id IN (FROM done)) AS analyzed FROM (SELECT video_id, arg_max(status, (created_at, version_id)) AS status FROM ver WHERE normalizer = 'plain' GROUP BY 1) WHERE status = 'ok'",
    "availability": "SELECT coalesce(availability, 'None') AS availability, count(*) AS n FROM vid GROUP BY 1",
    "collections": "SELECT collection_id, count(video_id) AS n FROM (SELECT DISTINCT collection_id FROM vid UNION ALL SELECT r_name FROM region) c LEFT JOIN vid USING (collection_id) GROUP BY 1",
}
FULL = f"{STATE}, {VERSIONS}, {DONE}"

from .transcript_queries import CUES  # noqa: E402

ORACLE = {
    "k1_catalog_upsert": f"""WITH s AS (SELECT lpad(c_custkey::VARCHAR, 11, 'v') AS video_id, c_name AS title, coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(c_mktsegment) END, 'public') AS availability FROM customer WHERE c_acctbal >= 0 AND c_nationkey <> 3
            UNION ALL SELECT 'short' || c_custkey, c_name, coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(c_mktsegment) END, 'public') FROM customer WHERE c_acctbal >= 0 AND c_nationkey = 3 AND length('short' || c_custkey) = 11),
        o AS (SELECT lpad(c_custkey::VARCHAR, 11, 'v') AS video_id FROM customer WHERE c_acctbal < 5000)
        SELECT video_id, coalesce(s.title, 'old title') AS title, coalesce(availability, 'private') AS availability, CASE WHEN o.video_id IS NULL THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '2023-05-05' END AS discovered_at,
            CASE WHEN s.video_id IS NULL THEN TIMESTAMP '2023-05-06' ELSE TIMESTAMP '{NOW}' END AS last_seen_at FROM s FULL JOIN o USING (video_id)""",
    "k2_content_kind": "SELECT page_id, CASE WHEN length(url) % 4 = 0 OR contains(url, '/shorts/') THEN 'short' WHEN contains(url, 'example.net') THEN 'stream' WHEN starts_with(url, 'https://m.') THEN 'live_replay' ELSE 'video' END AS kind FROM pages",
    "k3_metadata_fingerprint": """SELECT c_custkey, sha256('{"channel":"' || c_mktsegment || '","nation":' || c_nationkey || ',"note":null,"title":"' || c_name || '"}') AS fingerprint FROM customer""",
    "k4_membership": "SELECT DISTINCT o_custkey AS video_id, o_orderpriority AS collection_id FROM orders EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < '1997-01-01'",
    "k5_track_flatten": f"WITH {TRACK} SELECT * FROM tr",
    "k6_track_selection": f"""WITH {TRACK}, d AS (SELECT DISTINCT * FROM tr WHERE language IN ('ec', 'en', 'la'))
        SELECT video_id, kind, language, format, row_number() OVER (PARTITION BY video_id ORDER BY kind DESC, language, CASE format WHEN 'json3' THEN 0 WHEN 'vtt' THEN 1 ELSE 2 END) AS rank FROM d""",
    "k8_exit_classification": """WITH s AS (SELECT doc_id, length(coalesce(text, '')) AS n, lower(coalesce(text, '')) AS t FROM documents)
        SELECT doc_id, CASE WHEN n % 5 = 0 OR contains(t, 'sign in') OR contains(t, 'cookie') OR contains(t, 'authentication') THEN 'auth_required' WHEN n % 7 = 0 OR contains(t, 'video unavailable') OR contains(t, 'private video') OR contains(t, 'removed') THEN 'unavailable'
            WHEN n % 3 = 0 THEN 'success' WHEN n % 3 = 1 THEN 'retryable' ELSE 'tool_error' END AS class FROM s""",
    "k12_frozen_file_audit": r"""WITH c AS (SELECT conv_id // 64 AS shard, regexp_replace(string_agg(coalesce(text, ''), ' ' ORDER BY turn, coalesce(role, ''), coalesce(text, '')), '[\r\n]', ' ', 'g') AS body FROM conversations GROUP BY conv_id),
        w AS (SELECT shard, string_agg(body || chr(10), '' ORDER BY body) AS content FROM c GROUP BY 1)
        SELECT CASE WHEN shard % 11 = 10 THEN shard || '-lost' ELSE shard::VARCHAR END AS path, CASE WHEN shard % 11 = 10 THEN 'missing' WHEN shard % 5 = 4 THEN 'size' WHEN shard % 7 = 6 THEN 'content' ELSE 'ok' END AS result,
            CASE WHEN shard % 11 <> 10 THEN strlen(content) END AS found_bytes, CASE WHEN shard % 11 <> 10 THEN sha256(content) END AS found_sha256 FROM w""",
    "k9_secret_redaction": f"WITH r AS (SELECT doc_id, length(coalesce(text, '')) AS n, {REDACT.replace('{x}', SAID)} AS t FROM documents) SELECT doc_id, sha256(t) AS redacted_sha256, CASE WHEN length(t) > 120 THEN left(t, 120) || chr(10) || '[...stderr truncated; total ' || length(t) || ' bytes]' ELSE t END AS head, n FROM r",
    "k10_video_state": f"{STATE} SELECT * FROM st",
    "k11_pending_selection": f"{STATE} SELECT video_id, discovered_at, state FROM st WHERE state IN ('pending', 'retryable', 'tool_error')",
    "k13_candidate_fall_through": """WITH a AS (SELECT user_id AS video_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place, CASE WHEN event_type = 'view' AND value < 5 THEN 'success' WHEN event_type = 'error' AND value > 40 THEN 'auth_required' ELSE event_type END AS outcome FROM events),
        b AS (SELECT *, min(CASE WHEN outcome IN ('success', 'tool_missing', 'auth_required', 'unavailable', 'timeout') THEN place END) OVER (PARTITION BY video_id) AS stop FROM a)
        SELECT video_id, arg_max(outcome, place) AS outcome, max(place) AS place, count(*) AS tried FROM b WHERE place <= coalesce(stop, place) GROUP BY 1""",
    "k14_uncataloged": "SELECT DISTINCT o_custkey + CASE o_orderstatus WHEN 'P' THEN 1000 ELSE 0 END AS video_id FROM orders WHERE o_custkey + CASE o_orderstatus WHEN 'P' THEN 1000 ELSE 0 END NOT IN (SELECT c_custkey FROM customer)",
    "n1_caption_states": f"{FULL} {N['captions']}",
    "n2_transcript_states": f"{FULL} {N['transcripts']}",
    "n3_claim_states": N["claims"],
    "n4_concept_states": N["concepts"],
    "n5_analyze_scope_counts": f"{FULL} {N['scope']}",
    "n6_count_by_attribute": f"{FULL} {N['availability']}",
    "n7_count_by_collection": f"{FULL} {N['collections']}",
    "n8_oldest_pending": f"{FULL} SELECT min(discovered_at) AS oldest FROM st WHERE state IN ('pending', 'retryable', 'tool_error')",
    "n9_top_error_classes": f"{FULL} SELECT coalesce(error_class, 'unknown') AS error_class, count(*) AS n FROM att WHERE stage = 'freeze' AND outcome <> 'success' GROUP BY 1 ORDER BY n DESC, error_class LIMIT 10",
    "n10_partial_run_gaps": "SELECT o_orderkey AS run_id, 'videos' AS tab FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' UNION ALL SELECT o_orderkey, 'shorts' FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000",
    "n11_coverage_report": f"""{FULL}, sc AS ({N['scope']}), long AS (
        {' UNION ALL '.join(f"SELECT '{k}' AS section, * FROM ({N[k]}) x{i}(name, n)" for i, k in enumerate(N) if k != 'scope')} UNION ALL SELECT 'scope', 'pending', pending FROM sc UNION ALL SELECT 'scope', 'analyzed', analyzed FROM sc) SELECT section, name, n::BIGINT AS n FROM long""",
    "n12_domain_audit": f"WITH {CUES}, k AS (SELECT video_id || '-' || ordinal AS key, * FROM cues) SELECT 'start_not_negative' AS rule, key FROM k WHERE start_ms < 0 UNION ALL SELECT 'end_after_start', key FROM k WHERE end_ms < start_ms UNION ALL SELECT 'text_not_empty', key FROM k WHERE text = ''",
    "n13_analyzed_videos": f"{FULL} SELECT count(*) AS videos FROM done",
}
