"""Catalog, caption acquisition state, and the status aggregates of a transcript corpus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: The states of a video, the freeze outcomes that may be tried again, those that end all candidates, and the preferred tracks.
STATES = ("frozen", "pending", "missing", "auth_required", "unavailable", "retryable", "tool_error", "permanent_error", "raw_integrity_error")
RETRIED = ("retryable", "tool_error")
GLOBAL_ERRORS = ("tool_missing", "auth_required", "unavailable", "timeout")
KINDS = ("manual", "auto")
LANGUAGES = ("zh-Hans", "zh-CN", "zh", "zh-Hant", "zh-TW")
FORMATS = ("json3", "vtt", "srv3", "srv2", "srv1", "ttml")


def content_kind(url: Column, live_status: Column, was_live: Column) -> Column:
    return F.when(url.contains("/shorts/"), "short").when(live_status == "is_live", "stream").when(was_live, "live_replay").otherwise("video")


def metadata_fingerprint(**fields: Column | str) -> Column:
    """SHA-256 of the fields as JSON with sorted keys."""
    return F.sha2(F.to_json(F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in sorted(fields.items())]), {"ignoreNullFields": "false"}), 256)


def catalog_upsert(catalog: DataFrame, seen: DataFrame, now: str) -> DataFrame:
    """seen (video_id, title, availability) over catalog (.., discovered_at, last_seen_at): ids must have 11 characters of [A-Za-z0-9_-], unknown availability is public, discovered_at stays."""
    good = seen.where("video_id rlike '^[A-Za-z0-9_-]{11}$'").withColumn("availability", F.coalesce("availability", F.lit("public")))
    old = catalog.select("video_id", *[F.col(c).alias(f"old_{c}") for c in ("title", "availability", "discovered_at", "last_seen_at")])
    at, both = F.lit(now).cast("timestamp"), good.withColumn("now", F.lit(True)).join(old, "video_id", "full")
    pick = lambda c: F.when(F.col("now"), F.col(c)).otherwise(F.col(f"old_{c}")).alias(c)
    return both.select("video_id", pick("title"), pick("availability"), F.coalesce("old_discovered_at", at).alias("discovered_at"), F.when(F.col("now"), at).otherwise(F.col("old_last_seen_at")).alias("last_seen_at"))


def new_members(batch: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs (video_id, collection_id) that are not there yet, once each."""
    return batch.dropDuplicates(["video_id", "collection_id"]).join(table, ["video_id", "collection_id"], "left_anti")


TRACKS = "map<string,array<struct<ext:string>>>"


def flatten_tracks(inventories: DataFrame) -> DataFrame:
    """inventories (video_id, manual, automatic: JSON of language -> [{ext}]) to rows (video_id, kind, language, format)."""
    one = lambda col, kind: inventories.select("video_id", F.lit(kind).alias("kind"), F.explode(F.from_json(col, TRACKS)).alias("language", "exts")).select("video_id", "kind", "language", F.explode("exts").alias("e")).select("video_id", "kind", "language", F.col("e.ext").alias("format"))
    return one("manual", "manual").unionByName(one("automatic", "auto"))


def rank_tracks(tracks: DataFrame, languages: tuple[str, ...] = LANGUAGES, kinds: tuple[str, ...] = KINDS, formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """Tracks in preferred languages with their rank (1 is chosen) by kind, then language, then format; other kinds and formats come last."""
    place = lambda c, order: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(c)), F.lit(0)), F.lit(100))
    rows = tracks.where(F.col("language").isin(*languages)).withColumns({"k": place("kind", kinds), "l": place("language", languages), "f": place("format", formats)})
    return rows.select("video_id", "kind", "language", "format", F.row_number().over(W.partitionBy("video_id").orderBy("k", "l", "f", "kind", "format")).alias("rank"))


def cue_counts(captions: DataFrame, kind: str) -> DataFrame:
    """Cues of each caption body (video_id, body): JSON3 segments that are not blank, or VTT cues with text; none (bad JSON and null too) is an error.

    JSON3 is one object, or JSON Lines: objects one a line, of which those that do not parse count nothing.
    """
    from . import transcripts

    if kind == "json3":
        segments = "array<struct<utf8:string>>"

        def counted(body: Column) -> Column:
            events = F.coalesce(F.from_json(body, transcripts.JSON3)["events"], F.array())
            segs = F.flatten(F.transform(events, lambda e: F.coalesce(e["segs"], F.array().cast(segments))))
            return F.size(F.filter(segs, lambda x: F.regexp_replace(F.coalesce(x["utf8"], F.lit("")), "\\s+", "") != ""))

        lines = F.filter(F.split(F.coalesce("body", F.lit("")), "\\R"), lambda x: x.rlike("^\\s*\\{"))
        of_lines = F.aggregate(F.transform(lines, counted), F.lit(0), lambda a, b: a + b)
        # A reader of one object stops after the first line of JSON Lines; lines of one object have no events of their own.
        n = captions.select("video_id", F.greatest(counted(F.coalesce("body", F.lit(""))), of_lines).alias("cues"))
    else:
        found = transcripts.vtt_cues(captions).groupBy("video_id").agg(F.count(F.lit(1)).alias("n"))
        n = captions.select("video_id").join(found, "video_id", "left").select("video_id", F.coalesce("n", F.lit(0)).alias("cues"))
    return n.select("video_id", F.lit(kind).alias("format"), F.col("cues").cast("int").alias("cues"), (F.col("cues") == 0).alias("is_error"))


#: Phrases in a tool's error output, by class.
AUTH_PHRASES = ("sign in", "cookie", "authentication")
GONE_PHRASES = ("video unavailable", "private video", "removed")


def exit_class(stderr: Column, code: Column) -> Column:
    text = F.lower(stderr)
    has = lambda phrases: reduce(lambda a, b: a | b, [text.contains(p) for p in phrases])
    return F.when(has(AUTH_PHRASES), "auth_required").when(has(GONE_PHRASES), "unavailable").when(code == 0, "success").when(code == 101, "retryable").otherwise("tool_error")


#: What is taken out of a tool's output, what stands for it, and the mark of a cut text.
SECRET = "[A-Za-z0-9._~+/=%-]{8,}"
REDACTED = (
    ("https?://[^\\s\"'<>]+", "<redacted-url>"),
    (f"(?i)\\bbearer\\s+{SECRET}", "<redacted>"),
    (f"(?i)\\b(authorization|token|cookie|signature|sig|api[_-]?key|secret|access[_-]?key)\\s*[:=]\\s*{SECRET}", "$1=<redacted>"),
    ("(?:/Users|/home|/root|/private|/var|/tmp)/[^\\s\"'<>]+", "<redacted-path>"),
)
CUT_MARK = ("\n[...stderr truncated; total ", " bytes]")


def redact(text: Column, most: int = 4096) -> Column:
    """URLs, bearer tokens, secret assignments and absolute paths replaced; a text of over `most` characters is then cut to them and marked with its length."""
    for pattern, by in REDACTED:
        text = F.regexp_replace(text, pattern, by)
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(CUT_MARK[0]), F.length(text).cast("string"), F.lit(CUT_MARK[1]))).otherwise(text)


def video_states(videos: DataFrame, captions: DataFrame, attempts: DataFrame) -> DataFrame:
    """State of each video: frozen with a caption, else the outcome of its newest freeze attempt, else pending."""
    last = attempts.where("stage = 'freeze'").groupBy("video_id").agg(F.max_by("outcome", F.struct("attempted_at", "attempt_id")).alias("outcome"))
    have = captions.select("video_id").distinct().withColumn("frozen", F.lit(True))
    joined = videos.join(have, "video_id", "left").join(last, "video_id", "left")
    return joined.select(*videos.columns, F.when(F.col("frozen"), "frozen").otherwise(F.coalesce("outcome", F.lit("pending"))).alias("state"))


def pending(states: DataFrame) -> DataFrame:
    """Videos still to freeze, oldest first: never tried, or failed in a way that may pass."""
    return states.where(F.col("state").isin("pending", *RETRIED)).select("video_id", "discovered_at", "state")


def frozen_audit(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """manifest (path, byte_count, content_sha256) against files (path, length, content) as the binaryFile source gives them.

    Gives path, result, and what was found: found_bytes, found_sha256.
    """
    found = files.select("path", F.col("length").alias("found_bytes"), F.sha2("content", 256).alias("found_sha256"))
    joined = manifest.join(found, "path", "left")
    problem = F.when(F.col("found_bytes").isNull(), "missing").when(F.col("found_bytes") != F.col("byte_count"), "size").when(F.col("found_sha256") != F.col("content_sha256"), "content").otherwise("ok")
    return joined.select("path", problem.alias("result"), "found_bytes", "found_sha256")


def fall_through(attempts: DataFrame) -> DataFrame:
    """attempts (video_id, place, outcome) of ranked candidates: the first success up to the first global error, else the last outcome up to it."""
    w = W.partitionBy("video_id").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    stops = F.col("outcome").isin(*GLOBAL_ERRORS, "success")
    tried = attempts.withColumn("stopped", F.coalesce(F.max(stops).over(w), F.lit(False))).where("not stopped")
    return tried.groupBy("video_id").agg(F.max_by("outcome", "place").alias("outcome"), F.max("place").alias("place"), F.count(F.lit(1)).alias("tried"))


def uncataloged(requested: DataFrame, videos: DataFrame) -> DataFrame:
    return requested.select("video_id").distinct().join(videos, "video_id", "left_anti")


def zero_filled(counts: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """counts (column, n) with a row of 0 for each value that is absent; other values stay."""
    all_values = counts.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return all_values.join(counts, column, "full").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Rows for each value; null counts as 'None'."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("None")).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def collection_counts(collections: DataFrame, members: DataFrame) -> DataFrame:
    return collections.join(members, "collection_id", "left").groupBy("collection_id").agg(F.count("video_id").alias("n"))


def transcript_states(videos: DataFrame, captions: DataFrame, versions: DataFrame) -> DataFrame:
    """(state, n): normalized by the newest version, else pending_normalize with a caption, else no_caption."""
    newest = versions.groupBy("video_id").agg(F.max_by("status", F.struct("created_at", "version_id")).alias("newest"))
    joined = videos.select("video_id").join(captions.select("video_id").distinct().withColumn("frozen", F.lit(True)), "video_id", "left").join(newest, "video_id", "left")
    state = F.when(F.col("frozen").isNull(), "no_caption").when(F.col("newest") == "ok", "normalized").otherwise("pending_normalize")
    return zero_filled(joined.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n")), "state", ("normalized", "pending_normalize", "no_caption"))


def scope_counts(versions: DataFrame, analyzed: DataFrame, normalizer: str) -> DataFrame:
    """pending and analyzed videos, exclusive, among those whose newest version of the normalizer is ok."""
    newest = versions.where(F.col("normalizer") == normalizer).groupBy("video_id").agg(F.max_by("status", F.struct("created_at", "version_id")).alias("status")).where("status = 'ok'")
    joined = newest.join(analyzed.select("video_id").distinct().withColumn("done", F.lit(True)), "video_id", "left")
    return joined.agg(F.count_if(F.col("done").isNull()).alias("pending"), F.count_if(F.col("done")).alias("analyzed"))


def top_errors(attempts: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent error classes of failed freezes; null counts as unknown."""
    failed = attempts.where("stage = 'freeze' and outcome <> 'success'").groupBy(F.coalesce("error_class", F.lit("unknown")).alias("error_class")).agg(F.count(F.lit(1)).alias("n"))
    return failed.orderBy(F.desc("n"), "error_class").limit(n)


def partial_gaps(runs: DataFrame) -> DataFrame:
    """Tabs with status failed in the JSON summaries (tab -> {status}) of partial catalog runs."""
    tabs = runs.where("kind = 'catalog' and status = 'partial'").select("run_id", F.explode(F.from_json("summary", "map<string,struct<status:string>>")).alias("tab", "t"))
    return tabs.where("t.status = 'failed'").select("run_id", "tab")


def sections(**parts: DataFrame) -> DataFrame:
    """Counts (name, n) of several reports in one long table (section, name, n)."""
    named = [df.toDF("name", "n").select(F.lit(section).alias("section"), F.col("name").cast("string").alias("name"), F.col("n").cast("long").alias("n")) for section, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


def violations(df: DataFrame, key: str, **rules: str) -> DataFrame:
    """(rule, key) for each row that breaks one of the rules (SQL conditions); null conditions count as kept."""
    broken = F.filter(F.array(*[F.when(~F.expr(f"coalesce({cond}, true)"), F.lit(name)) for name, cond in rules.items()]), lambda x: x.isNotNull())
    return df.select(F.explode(broken).alias("rule"), F.col(key).alias("key"))
