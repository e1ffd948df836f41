"""Queries L1-L15 and K7 over conversations rendered as captions, a turn as a cue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import corpus, transcripts as tr
from ..sources.tables import table

#: Turns as cues: lengths and gaps follow from the text; some turns repeat a short text, some end before they start.
CUES = r"""c0 AS (SELECT conv_id AS video_id, turn AS ordinal, role, coalesce(text, '') AS body, length(coalesce(text, '')) AS n FROM conversations),
    c1 AS (SELECT *, CASE WHEN n % 5 = 0 THEN 'same words' WHEN n % 13 = 0 THEN '' WHEN n % 7 = 0 THEN '<i>' || body || '</i> &lt;ok&gt; &amp;amp; &copy;&#x2019;&hellip; <>' ELSE body END AS text,
        row_number() OVER w AS k, sum(500 + n % 1500) OVER w AS total, sum(n % 3 * 700) OVER w AS pause FROM c0 WINDOW w AS (PARTITION BY video_id ORDER BY ordinal, role, body)),
    cues AS (SELECT video_id, k - 1 AS ordinal, total + pause - (500 + n % 1500) AS start_ms, CASE WHEN n % 17 = 0 THEN 0 ELSE total + pause END AS end_ms, text FROM c1)"""
MARKUP = "regexp_replace({x}, '<[^>]+>', '', 'g')"
DECODED = "replace(replace(replace(replace(replace(replace(replace(replace(replace({x}, '&copy;', '©'), '&#x2019;', '’'), '&hellip;', '…'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')"
STRIPPED = DECODED.replace("{x}", MARKUP)
FOLDED = r"trim(regexp_replace(replace(nfc_normalize({x}), chr(65279), ''), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))"
USABLE = "us AS (SELECT video_id, ordinal, start_ms, end_ms, t AS text FROM (SELECT *, " + FOLDED.replace("{x}", STRIPPED.replace("{x}", "text")) + " AS t FROM cues) WHERE t <> '' AND end_ms >= start_ms)"
MERGED = """RECURSIVE_PART n AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ordinal) AS i FROM us),
    g AS (SELECT video_id, i, 1 AS grp, start_ms AS s, end_ms AS e, text, ordinal AS rs, ordinal AS re, text AS last_text FROM n WHERE i = 1
        UNION ALL SELECT n.video_id, n.i, CASE WHEN ok THEN grp ELSE grp + 1 END, CASE WHEN ok THEN s ELSE n.start_ms END, n.end_ms, CASE WHEN ok THEN g.text || ' ' || n.text ELSE n.text END, CASE WHEN ok THEN rs ELSE n.ordinal END, n.ordinal, n.text
        FROM (SELECT g.*, x.i AS ni, (x.start_ms - g.e > 0 AND x.start_ms - g.e <= 1500 AND NOT regexp_matches(g.last_text, '[。！？!?]$') AND x.end_ms - g.s <= 8000) AS ok FROM g JOIN n x ON x.video_id = g.video_id AND x.i = g.i + 1) g JOIN n ON n.video_id = g.video_id AND n.i = g.ni),
    mg AS (SELECT video_id, s AS start_ms, e AS end_ms, rs AS raw_cue_start, re AS raw_cue_end, text FROM g QUALIFY row_number() OVER (PARTITION BY video_id, grp ORDER BY i DESC) = 1),
    rn AS (SELECT *, sum(CASE WHEN text = prev THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY raw_cue_start) AS run FROM (SELECT *, lag(text) OVER (PARTITION BY video_id ORDER BY raw_cue_start) AS prev FROM mg)),
    col AS (SELECT video_id, start_ms, end_ms, raw_cue_start, raw_cue_end, text FROM (SELECT *, count(*) OVER (PARTITION BY video_id, run) AS n, row_number() OVER (PARTITION BY video_id, run ORDER BY raw_cue_start) AS nth FROM rn) WHERE nth = 1 OR (n > 5 AND nth <= 5)),
    seg AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY raw_cue_start) - 1 AS ordinal FROM col)""".replace("RECURSIVE_PART ", "")
BASE = f"WITH RECURSIVE {CUES}, {USABLE}, {MERGED}"
STAMP = "lpad((({x}) // 3600000)::VARCHAR, 2, '0') || ':' || lpad((({x}) // 60000 % 60)::VARCHAR, 2, '0') || ':' || lpad((({x}) // 1000 % 60)::VARCHAR, 2, '0') || '.' || lpad((({x}) % 1000)::VARCHAR, 3, '0')"


def cues(spark, d) -> DataFrame:
    from pyspark.sql import Window as W

    c = table(spark, d, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("ordinal"), "role", F.coalesce("text", F.lit("")).alias("body")).withColumn("n", F.length("body"))
    n = F.col("n")
    text = F.when(n % 5 == 0, "same words").when(n % 13 == 0, "").when(n % 7 == 0, F.concat(F.lit("<i>"), "body", F.lit("</i> &lt;ok&gt; &amp;amp; &copy;&#x2019;&hellip; <>"))).otherwise(F.col("body"))
    w = W.partitionBy("video_id").orderBy("ordinal", "role", "body")
    total, pause = F.sum(500 + n % 1500).over(w.rowsBetween(W.unboundedPreceding, 0)), F.sum(n % 3 * 700).over(w.rowsBetween(W.unboundedPreceding, 0))
    return c.select("video_id", (F.row_number().over(w) - 1).alias("ordinal"), (total + pause - (500 + n % 1500)).alias("start_ms"), F.when(n % 17 == 0, F.lit(0)).otherwise(total + pause).alias("end_ms"), text.alias("text"))


def stamped(ms) -> F:
    part = lambda x, k: F.lpad(F.floor(x).cast("string"), k, "0")
    return F.concat(part(ms / 3600000, 2), F.lit(":"), part(ms / 60000 % 60, 2), F.lit(":"), part(ms / 1000 % 60, 2), F.lit("."), part(ms % 1000, 3))


def vtt(spark, d) -> DataFrame:
    """WEBVTT bodies: every other cue has an id line, and a NOTE block stands in between."""
    block = F.concat(F.when(F.col("ordinal") % 2 == 0, F.concat(F.lit("cue "), "ordinal", F.lit("\n"))).otherwise(F.lit("")), stamped(F.col("start_ms")), F.lit(" --> "), stamped(F.col("end_ms")), F.lit(" align:start\n"), F.regexp_replace("text", "\n+", "\n"))
    packed = cues(spark, d).groupBy("video_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", block.alias("b")))), lambda x: x["b"]), "\n\nNOTE made here\n\n").alias("all"))
    return packed.select("video_id", F.concat(F.when(F.col("video_id") % 9 == 0, "BROKEN").when(F.col("video_id") % 4 == 1, "\n \t\n WEBVTT").otherwise("WEBVTT"), F.lit("\nKind: captions\n\n"), "all", F.lit("\n")).alias("body"))


def json3(spark, d) -> DataFrame:
    """JSON3 bodies: user turns open cues, others continue them, blank texts close them."""
    from pyspark.sql import Window as W

    c = table(spark, d, "conversations").select(F.col("conv_id").alias("video_id"), "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    at = F.row_number().over(W.partitionBy("video_id").orderBy("turn", "role", "text"))
    n = F.length("text")
    event = F.struct((at * 1000).alias("tStartMs"), (n % 900).alias("dDurationMs"), F.when(F.col("role") == "user", 0).otherwise(1).alias("aAppend"), F.array(F.struct(F.when(n % 11 == 0, "\n").otherwise(F.col("text")).alias("utf8"))).alias("segs"))
    rows = c.select("video_id", at.alias("at"), event.alias("e"))
    return rows.groupBy("video_id").agg(F.to_json(F.struct(F.transform(F.sort_array(F.collect_list(F.struct("at", "e"))), lambda x: x["e"]).alias("events"))).alias("body"))


def json3_files(spark, d) -> DataFrame:
    """JSON3 bodies, some as JSON Lines with an odd line, some no JSON."""
    b = json3(spark, d)
    events = F.from_json("body", tr.JSON3)["events"]
    lines = F.array_join(F.transform(events, lambda e: F.to_json(F.struct(F.array(e).alias("events")))), "\n{not json}\n\n")
    return b.select("video_id", F.when(F.col("video_id") % 5 == 1, lines).when(F.col("video_id") % 5 == 2, "{not json").otherwise(F.col("body")).alias("body"))


def segments(spark, d):
    return tr.normalize(cues(spark, d))


def quotes(spark, d) -> DataFrame:
    """Quotes of segments: exact, with other white space, and with one character changed."""
    seg = segments(spark, d)
    half = F.expr("substr(text, 1, cast(ceil(length(text) / 2) as int))")
    kinds = F.array(F.struct(F.lit("exact").alias("kind"), half.alias("quote")), F.struct(F.lit("space").alias("kind"), F.concat(F.lit("\u00a0 "), F.regexp_replace(half, " ", "  ")).alias("quote")), F.struct(F.lit("changed").alias("kind"), F.concat(half, F.lit("\u2603")).alias("quote")))
    return seg.select("video_id", "ordinal", F.inline(kinds)).withColumn("quote_id", F.concat_ws("-", "video_id", "ordinal", "kind"))


def versions(spark, d) -> DataFrame:
    """Transcript versions, from orders: customer = video, order = version."""
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("video_id"), F.col("o_orderkey").alias("version_id"), F.sha2(F.col("o_orderstatus"), 256).alias("caption_sha256"), F.when(F.col("o_orderpriority") == "5-LOW", "other").otherwise("plain").alias("normalizer"),
        F.lit("1").alias("normalizer_version"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("ok").alias("status"), F.col("o_orderdate").alias("created_at"),
    )


VERSIONS = """ver AS (SELECT o_custkey AS video_id, o_orderkey AS version_id, sha256(o_orderstatus) AS caption_sha256, CASE o_orderpriority WHEN '5-LOW' THEN 'other' ELSE 'plain' END AS normalizer, '1' AS normalizer_version,
    CASE o_orderstatus WHEN 'P' THEN 'failed' ELSE 'ok' END AS status, o_orderdate AS created_at FROM orders)"""


def analyze_attempts(spark, d):
    e = table(spark, d, "events")
    attempts = e.select(F.col("user_id").alias("video_id"), (F.col("event_id") % 60).alias("run_id"), F.when(F.col("event_type") == "view", "freeze").otherwise("analyze").alias("stage"), F.when(F.col("value") > 15, "success").otherwise("failed").alias("outcome"))
    return attempts, e.select((F.col("event_id") % 60).alias("run_id")).distinct().withColumn("status", F.when(F.col("run_id") % 4 == 0, "failed").otherwise("success"))


ATT = """att AS (SELECT user_id AS video_id, event_id % 60 AS run_id, CASE event_type WHEN 'view' THEN 'freeze' ELSE 'analyze' END AS stage, CASE WHEN value > 15 THEN 'success' ELSE 'failed' END AS outcome FROM events),
    done AS (SELECT DISTINCT video_id FROM att WHERE stage = 'analyze' AND outcome = 'success' AND run_id % 4 <> 0)"""


def texts(spark, d):
    """Texts with combining marks, odd spaces and byte order marks, from documents."""
    return table(spark, d, "documents").select("doc_id", F.concat(F.lit("\ufeff\u3000"), F.regexp_replace(F.coalesce("text", F.lit("")), "é", "e\u0301"), F.lit("\u2028 \u00a0")).alias("text"))


def l10(spark, d):
    v = versions(spark, d)
    return tr.new_versions(v, v.where("created_at < '1999-01-01'")).select("video_id", "version_id")


def l13(spark, d):
    captions = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("video_id"))
    return tr.normalize_scope(captions, versions(spark, d).where("created_at < '1997-01-01'"), "plain")


def l15(spark, d):
    titles = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("video_id")).agg(F.concat_ws("-", F.max("role"), F.count(F.lit(1))).alias("title"))
    return tr.input_bundle(segments(spark, d), titles)


QUERIES = {
    "k7_cue_counts": lambda s, d: corpus.cue_counts(json3_files(s, d), "json3").unionByName(corpus.cue_counts(vtt(s, d), "vtt")),
    "l1_vtt_cues": lambda s, d: tr.vtt_cues(vtt(s, d)),
    "l2_json3_cues": lambda s, d: tr.json3_cues(json3(s, d)),
    "l3_formatting_strip": lambda s, d: cues(s, d).select("video_id", "ordinal", tr.strip_markup(F.col("text")).alias("text")),
    "l4_compare_form": lambda s, d: texts(s, d).select("doc_id", F.sha2(tr.fold(F.col("text")), 256).alias("folded_sha256")),
    "l5_cue_filter": lambda s, d: tr.usable(cues(s, d)),
    "l6_bounded_merge": lambda s, d: tr.merge(tr.usable(cues(s, d))),
    "l7_repeat_collapse": lambda s, d: tr.collapse_repeats(tr.merge(tr.usable(cues(s, d)))),
    "l8_renumber": segments,
    "l9_transcript_fingerprint": lambda s, d: tr.fingerprint(segments(s, d)),
    "l10_version_idempotency": l10,
    "l11_quote_containment": lambda s, d: tr.quote_check(quotes(s, d), segments(s, d)).select("quote_id", "contained"),
    "l12_quote_coverage": lambda s, d: tr.quote_check(quotes(s, d), segments(s, d)).select("quote_id", "coverage"),
    "l13_normalize_scope": l13,
    "l14_analyze_scope": lambda s, d: tr.analyze_scope(versions(s, d), *analyze_attempts(s, d), "plain"),
    "l15_input_bundle": l15,
}

J3 = """j0 AS (SELECT conv_id AS video_id, role, coalesce(text, '') AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, coalesce(text, '')) AS pos FROM conversations),
    j1 AS (SELECT video_id, pos, pos * 1000 AS start_ms, pos * 1000 + length(body) % 900 AS end_ms, CASE WHEN length(body) % 11 = 0 THEN chr(10) ELSE body END AS text, role = 'user' AS fresh FROM j0),
    j2 AS (SELECT *, replace(text, chr(10), '') = '' AS closes FROM j1),
    j3 AS (SELECT *, sum(CASE WHEN NOT closes AND (fresh OR coalesce(lc, true)) THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY pos) AS island FROM (SELECT *, lag(closes) OVER (PARTITION BY video_id ORDER BY pos) AS lc FROM j2)),
    jc AS (SELECT video_id, island, min(start_ms) AS start_ms, arg_max(end_ms, pos) AS end_ms, trim(string_agg(text, '' ORDER BY pos), ' ') AS text FROM j3 WHERE NOT closes GROUP BY ALL)"""
HALF = "left(text, ceil(length(text) / 2)::INT)"
QUOTED = f"""q AS (SELECT video_id, ordinal, video_id || '-' || ordinal || '-exact' AS quote_id, text, {HALF} AS quote FROM seg
    UNION ALL SELECT video_id, ordinal, video_id || '-' || ordinal || '-space', text, {HALF} FROM seg UNION ALL SELECT video_id, ordinal, video_id || '-' || ordinal || '-changed', text, {HALF} || chr(9731) FROM seg),
    q2 AS (SELECT quote_id, text AS t, {FOLDED.replace('{x}', 'quote')} AS q FROM q)"""
VTT_ROWS = f"""v0 AS (SELECT video_id, ordinal, start_ms, end_ms, trim(regexp_replace(text, '\\n+', chr(10), 'g'), ' ' || chr(10) || chr(9)) AS text FROM cues WHERE video_id % 9 <> 0),
    v AS (SELECT * FROM v0 WHERE trim(text, chr(10) || ' ') <> '')"""

ORACLE = {
    "k7_cue_counts": f"""WITH {CUES}, {J3}, {VTT_ROWS} SELECT video_id, 'json3' AS format, count(*) FILTER (video_id % 5 <> 2 AND trim(text, chr(10) || chr(9) || chr(13) || ' ') <> '') AS cues, count(*) FILTER (video_id % 5 <> 2 AND trim(text, chr(10) || chr(9) || chr(13) || ' ') <> '') = 0 AS is_error FROM j1 GROUP BY 1
        UNION ALL SELECT video_id, 'vtt', coalesce(n, 0), coalesce(n, 0) = 0 FROM (SELECT DISTINCT video_id FROM cues) LEFT JOIN (SELECT video_id, count(*) AS n FROM v GROUP BY 1) USING (video_id)""",
    "l1_vtt_cues": f"WITH {CUES}, {VTT_ROWS} SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY ordinal) - 1 AS ordinal, start_ms, end_ms, text FROM v",
    "l2_json3_cues": f"WITH {J3} SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY island) - 1 AS ordinal, start_ms, end_ms, text FROM jc",
    "l3_formatting_strip": f"WITH {CUES} SELECT video_id, ordinal, {STRIPPED.replace('{x}', 'text')} AS text FROM cues",
    "l4_compare_form": "WITH t AS (SELECT doc_id, chr(65279) || chr(12288) || replace(coalesce(text, ''), 'é', 'e' || chr(769)) || chr(8232) || ' ' || chr(160) AS text FROM documents) SELECT doc_id, sha256(" + FOLDED.replace("{x}", "text") + ") AS folded_sha256 FROM t",
    "l5_cue_filter": f"WITH {CUES}, {USABLE} SELECT * FROM us",
    "l6_bounded_merge": f"{BASE} SELECT * FROM mg",
    "l7_repeat_collapse": f"{BASE} SELECT * FROM col",
    "l8_renumber": f"{BASE} SELECT * FROM seg",
    "l9_transcript_fingerprint": f"""{BASE}, p AS (SELECT video_id, count(*) AS n_segments, string_agg('{{"ordinal":' || ordinal || ',"end_ms":' || end_ms || ',"raw_cue_end":' || raw_cue_end || ',"raw_cue_start":' || raw_cue_start || ',"start_ms":' || start_ms || ',"text":' || to_json(text) || '}}', ',' ORDER BY ordinal) AS body FROM seg GROUP BY 1)
        SELECT video_id, n_segments, sha256('{{"segments":[' || body || '],"video_id":"' || video_id || '"}}') AS sha256 FROM p""",
    "l10_version_idempotency": f"WITH {VERSIONS} SELECT video_id, version_id FROM ver ANTI JOIN (SELECT * FROM ver WHERE created_at < '1999-01-01') x USING (video_id, caption_sha256, normalizer, normalizer_version)",
    "l11_quote_containment": f"{BASE}, {QUOTED} SELECT quote_id, q <> '' AND contains(t, q) AS contained FROM q2",
    "l12_quote_coverage": f"{BASE}, {QUOTED} SELECT quote_id, length(q) / length(t) AS coverage FROM q2",
    "l13_normalize_scope": f"WITH {VERSIONS} SELECT c_custkey AS video_id FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT video_id FROM ver WHERE created_at < '1997-01-01' AND status = 'ok' AND normalizer = 'plain')",
    "l14_analyze_scope": f"""WITH {VERSIONS}, {ATT}, l AS (SELECT video_id, arg_max(version_id, (created_at, version_id)) AS version_id, arg_max(status, (created_at, version_id)) AS status FROM ver WHERE normalizer = 'plain' GROUP BY 1)
        SELECT video_id, version_id FROM l WHERE status = 'ok' AND video_id NOT IN (FROM done)""",
    "l15_input_bundle": f"""{BASE}, t AS (SELECT conv_id AS video_id, max(role) || '-' || count(*) AS title FROM conversations GROUP BY 1),
        p AS (SELECT video_id, count(*) AS n_segments, string_agg('{{"ordinal":' || ordinal || ',"text":' || to_json(text) || '}}', ',' ORDER BY ordinal) AS body FROM seg GROUP BY 1)
        SELECT video_id, n_segments, sha256('{{"segments":[' || body || '],"title":"' || title || '"}}') AS bundle_sha256 FROM p JOIN t USING (video_id)""",
}
