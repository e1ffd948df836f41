"""Caption cues to transcript segments, for all captions at once.

Cues are rows (video_id, ordinal, start_ms, end_ms, text). Sequential rules are
windows over a video where a rule looks at neighbours only; the one rule that
depends on what was merged before (the cap on a merged span) is a fold over
chains that windows have cut first.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import StringType

from ..sources.tables import materialized
from .pages import unescape

MERGE_GAP_MS, MERGE_SPAN_MS, REPEATS_KEPT = 1500, 8000, 5
TERMINATORS = "[。！？!?]$"
TIMING = "^([0-9]{2,}):([0-9]{2}):([0-9]{2})\\.([0-9]{3})[ \\t]+-->[ \\t]+([0-9]{2,}):([0-9]{2}):([0-9]{2})\\.([0-9]{3})"


#: Where all unsettled characters are, in few ranges: neither in Latin letters nor, but for a few marks, among ideographs and kana.
ELSEWHERE = "[\\x{300}-\\x{2fff}\\x{302a}-\\x{302f}\\x{3099}\\x{309a}\\x{a000}-\\x{10ffff}]"


@F.pandas_udf(StringType())
def nfc_in_python(texts: pd.Series) -> pd.Series:
    """Spark has no Unicode normalisation; this one step is done in Arrow batches."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@cache
def unsettled() -> str:
    """Pattern of the characters that NFC may change or move: those it replaces, combining marks, and those that join with one before them.

    It says what ELSEWHERE has to cover. On texts it is slow: a class of so many ranges tries them one by one for each character.
    """
    second = {0x1161 + k for k in range(21)} | {0x11A8 + k for k in range(27)}  # vowels and finals of Hangul
    found = set()
    for c in map(chr, (*range(0xD800), *range(0xE000, 0x30000))):
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(int(parts[1], 16))
        if unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c:
            found.add(ord(c))
    points = sorted(found | second)
    starts = [p for k, p in enumerate(points) if k == 0 or points[k - 1] != p - 1]
    ends = [p for k, p in enumerate(points) if k == len(points) - 1 or points[k + 1] != p + 1]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True)) + "]"


def unsettling(text: Column) -> Column:
    """Whether a text has a character where unsettled ones are. ASCII has none, and is told by its length in bytes."""
    return (F.octet_length(text) > F.length(text)) & text.rlike(ELSEWHERE)


def nfc(text: Column) -> Column:
    """Text in NFC. Only texts with a character where unsettled ones are go to Python; for all others nothing is handed over."""
    return F.coalesce(nfc_in_python(F.when(unsettling(text), text)), text)


def fold(text: Column) -> Column:
    """Form in which texts are compared: NFC, no byte order mark, runs of Unicode white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(nfc(text), "\ufeff", ""), "(?U)\\s+", " "))


def strip_markup(text: Column) -> Column:
    """Without <..> tags (of one character or more), and with all character references decoded."""
    return unescape(F.regexp_replace(text, "<[^>]+>", ""))


def vtt_cues(captions: DataFrame) -> DataFrame:
    """captions (video_id, body) to cues; captions without the WEBVTT header (after white space, if any) give none."""
    body = F.regexp_replace("body", "\r\n?", "\n")
    blocks = captions.where(F.col("body").rlike("^\ufeff?\\s*WEBVTT")).select("video_id", F.posexplode(F.split(body, "\n[ \\t]*\n+")).alias("at", "block"))
    lines = blocks.where(~F.col("block").rlike("^\ufeff?\\s*(WEBVTT|NOTE)")).withColumn("lines", F.split("block", "\n"))
    timed = lines.withColumn("place", F.when(F.col("lines")[0].rlike(TIMING), 0).when(F.get("lines", F.lit(1)).rlike(TIMING), 1)).where("place is not null")
    stamp = F.get("lines", F.col("place"))
    part = lambda k: F.regexp_extract(stamp, TIMING, k).cast("long")
    ms = lambda k: ((part(k) * 60 + part(k + 1)) * 60 + part(k + 2)) * 1000 + part(k + 3)
    text = F.btrim(F.array_join(F.slice("lines", F.col("place") + 2, F.size("lines")), "\n"), F.lit(" \t\n"))
    cues = timed.select("video_id", "at", ms(1).alias("start_ms"), ms(5).alias("end_ms"), text.alias("text")).where("text <> ''")
    return cues.select("video_id", (F.row_number().over(W.partitionBy("video_id").orderBy("at")) - 1).alias("ordinal"), "start_ms", "end_ms", "text")


JSON3 = "events array<struct<tStartMs:bigint,dDurationMs:bigint,aAppend:int,segs:array<struct<utf8:string>>>>"


def json3_cues(captions: DataFrame) -> DataFrame:
    """captions (video_id, body) in JSON3 to cues: an event of only line ends (or of none) closes the open cue, aAppend continues it, any other opens one."""
    events = captions.select("video_id", F.posexplode(F.from_json("body", JSON3)["events"]).alias("at", "e"))
    text = F.array_join(F.transform(F.coalesce("e.segs", F.array().cast("array<struct<utf8:string>>")), lambda s: F.coalesce(s["utf8"], F.lit(""))), "")
    rows = events.select("video_id", "at", F.coalesce("e.tStartMs", F.lit(0)).alias("start_ms"), (F.coalesce("e.tStartMs", F.lit(0)) + F.coalesce("e.dDurationMs", F.lit(0))).alias("end_ms"), text.alias("text"), F.coalesce("e.aAppend", F.lit(0)).alias("append"))
    w = W.partitionBy("video_id").orderBy("at")
    rows = rows.withColumn("closes", F.regexp_replace("text", "\n", "") == "")
    opens = ~F.col("closes") & ((F.col("append") != 1) | F.coalesce(F.lag("closes").over(w), F.lit(True)))
    rows = rows.withColumn("island", F.sum(F.when(opens, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0))).where("not closes")
    cues = rows.groupBy("video_id", "island").agg(F.min("start_ms").alias("start_ms"), F.max_by("end_ms", "at").alias("end_ms"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "").alias("text"))
    return cues.select("video_id", (F.row_number().over(W.partitionBy("video_id").orderBy("island")) - 1).alias("ordinal"), "start_ms", "end_ms", F.trim("text").alias("text"))


def usable(cues: DataFrame) -> DataFrame:
    """Cues whose text is left after folding and that do not end before they start."""
    return cues.withColumn("text", fold(strip_markup(F.col("text")))).where("text <> '' and end_ms >= start_ms")


CHAIN = ["video_id", "chain"]


def segment_starts(chained: DataFrame, span_ms: int) -> DataFrame:
    """(video_id, chain, at): places of the cues that start a segment, apart from a chain's first, in chains longer than span_ms.

    A cue's segment, if it starts one, ends before the first cue of its chain that ends more than
    span_ms after its start. That cue is found by one sorted pass over ends and limits together;
    which cues the first one leads to is found by doubling: with the steps over 1, 2, 4, .. segments
    at hand, the starts reached so far go each step once, longest first. No chain is held as a whole.
    """
    long = materialized(chained.where("last_ms - first_ms > " + str(span_ms)).select(*CHAIN, "at", "n", "start_ms", "end_ms"), "chains")
    ends = long.select(*CHAIN, F.col("end_ms").alias("value"), F.lit(0).alias("limit"), "at", "n")
    limits = long.select(*CHAIN, (F.col("start_ms") + span_ms).alias("value"), F.lit(1).alias("limit"), "at", "n")
    within = F.sum(F.when(F.col("limit") == 0, 1).otherwise(0)).over(W.partitionBy(*CHAIN).orderBy("value", "limit").rowsBetween(W.unboundedPreceding, 0))
    after = F.greatest(F.col("within"), F.col("at")) + 1
    steps = ends.unionByName(limits).withColumn("within", within).where("limit = 1").withColumn("to", after).where("to <= n")
    jumps = [materialized(steps.select(*CHAIN, F.col("at").cast("long").alias("at"), F.col("to").cast("long").alias("to")), "steps")]
    while True:
        last = jumps[-1]
        further = last.join(last.select(*CHAIN, F.col("at").alias("to"), F.col("to").alias("beyond")), [*CHAIN, "to"]).select(*CHAIN, "at", F.col("beyond").alias("to"))
        further = materialized(further, "steps")
        if further.isEmpty():
            break
        jumps.append(further)
    reached = jumps[0].select(*CHAIN, F.lit(1).cast("long").alias("at")).distinct()
    for jump in reversed(jumps):
        reached = materialized(reached.unionByName(reached.join(jump, [*CHAIN, "at"]).select(*CHAIN, F.col("to").alias("at"))), "starts")
    return reached.where("at > 1")


def merge(cues: DataFrame, gap_ms: int = MERGE_GAP_MS, span_ms: int = MERGE_SPAN_MS) -> DataFrame:
    """Joins a cue to the one before it when the gap is over 0 and at most gap_ms, that one ends no sentence, and the merged span stays within span_ms.

    Windows cut a video into chains by the first two rules. Chains within span_ms are segments;
    longer ones are cut at their segment starts. A segment holds cues of span_ms at most.
    """
    w = W.partitionBy("video_id").orderBy("ordinal")
    gap = F.col("start_ms") - F.lag("end_ms").over(w)
    joins = (gap > 0) & (gap <= gap_ms) & ~F.lag("text").over(w).rlike(TERMINATORS)
    up_to = w.rowsBetween(W.unboundedPreceding, 0)
    chained = cues.withColumn("chain", F.sum(F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).over(up_to))
    chain = W.partitionBy(*CHAIN)
    chained = chained.withColumns({
        "at": F.row_number().over(chain.orderBy("ordinal")).cast("long"), "n": F.count(F.lit(1)).over(chain),
        "first_ms": F.min("start_ms").over(chain), "last_ms": F.max("end_ms").over(chain),
    })
    chained = materialized(chained.select(*CHAIN, "at", "n", "first_ms", "last_ms", "ordinal", "start_ms", "end_ms", "text"), "chained")
    rows = chained
    if not chained.where(f"n > 1 and last_ms - first_ms > {span_ms}").isEmpty():
        starts = segment_starts(chained, span_ms).withColumn("starts", F.lit(1))
        rows = chained.join(starts, [*CHAIN, "at"], "left")
    else:
        rows = chained.withColumn("starts", F.lit(None).cast("int"))
    of_chain = W.partitionBy(*CHAIN).orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    segments = rows.withColumn("segment", F.count("starts").over(of_chain)).groupBy(*CHAIN, "segment").agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.min("ordinal").cast("bigint").alias("raw_cue_start"),
        F.max("ordinal").cast("bigint").alias("raw_cue_end"), F.array_sort(F.collect_list(F.struct("at", "text"))).alias("cues"),
    )
    return segments.select("video_id", "start_ms", "end_ms", "raw_cue_start", "raw_cue_end", F.array_join(F.transform("cues", lambda x: x["text"]), " ").alias("text"))


def collapse_repeats(segments: DataFrame, kept: int = REPEATS_KEPT) -> DataFrame:
    """Of a run of equal texts: the first, or the first `kept` of a longer run than that."""
    w = W.partitionBy("video_id").orderBy("raw_cue_start")
    new = F.coalesce(F.col("text") != F.lag("text").over(w), F.lit(True))
    runs = segments.withColumn("run", F.sum(new.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    run = W.partitionBy("video_id", "run")
    rows = runs.withColumns({"n": F.count(F.lit(1)).over(run), "nth": F.row_number().over(run.orderBy("raw_cue_start"))})
    return rows.where((F.col("nth") == 1) | ((F.col("n") > kept) & (F.col("nth") <= kept))).drop("run", "n", "nth")


def renumber(segments: DataFrame) -> DataFrame:
    return segments.withColumn("ordinal", F.row_number().over(W.partitionBy("video_id").orderBy("raw_cue_start")) - 1)


def normalize(cues: DataFrame) -> DataFrame:
    """cues to numbered segments: filter, merge, collapse, renumber."""
    return renumber(collapse_repeats(merge(usable(cues))))


def fingerprint(segments: DataFrame) -> DataFrame:
    """(video_id, segments, sha256): a hash of the canonical JSON of a transcript."""
    item = F.struct("ordinal", "end_ms", "raw_cue_end", "raw_cue_start", "start_ms", "text")
    packed = segments.groupBy("video_id").agg(F.sort_array(F.collect_list(item)).alias("segments"))
    payload = F.to_json(F.struct("segments", F.col("video_id").cast("string").alias("video_id")), {"ignoreNullFields": "false"})
    return packed.select("video_id", F.size("segments").alias("n_segments"), F.sha2(payload, 256).alias("sha256"))


def new_versions(versions: DataFrame, present: DataFrame) -> DataFrame:
    """Versions whose (video_id, caption_sha256, normalizer, normalizer_version) is not there yet."""
    return versions.join(present, ["video_id", "caption_sha256", "normalizer", "normalizer_version"], "left_anti")


def quote_check(quotes: DataFrame, segments: DataFrame) -> DataFrame:
    """quotes (quote_id, video_id, ordinal, quote) with contained, and coverage: the quote's share of the segment's length; both folded."""
    joined = quotes.join(segments.select("video_id", "ordinal", "text"), ["video_id", "ordinal"], "left")
    q, t = fold(F.col("quote")), fold(F.col("text"))
    joined = joined.withColumns({"q": q, "t": t})
    inside = F.coalesce((F.col("q") != "") & F.contains("t", "q"), F.lit(False))
    share = F.when(F.length("t") > 0, F.length("q") / F.length("t")).otherwise(0.0)
    return joined.select("quote_id", "video_id", "ordinal", inside.alias("contained"), F.coalesce(share, F.lit(0.0)).alias("coverage"))


def normalize_scope(captions: DataFrame, versions: DataFrame, normalizer: str) -> DataFrame:
    """Frozen captions without an ok version of this normalizer, in order of fetching."""
    done = versions.where((F.col("status") == "ok") & (F.col("normalizer") == normalizer)).select("video_id").distinct()
    return captions.join(done, "video_id", "left_anti")


def analyze_scope(versions: DataFrame, attempts: DataFrame, runs: DataFrame, normalizer: str) -> DataFrame:
    """Videos whose newest version is ok and that no successful run has analysed with success."""
    newest = versions.where(F.col("normalizer") == normalizer).groupBy("video_id").agg(F.max_by(F.struct("version_id", "status"), F.struct("created_at", "version_id")).alias("v"))
    good = attempts.where("stage = 'analyze' and outcome = 'success'").join(runs.where("status = 'success'").select("run_id"), "run_id", "left_semi").select("video_id").distinct()
    return newest.where("v.status = 'ok'").select("video_id", "v.version_id").join(good, "video_id", "left_anti")


def input_bundle(segments: DataFrame, videos: DataFrame) -> DataFrame:
    """(video_id, n_segments, bundle_sha256): ordered segments with the video's title as canonical JSON, hashed."""
    packed = segments.groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("ordinal", "text"))).alias("segments"))
    payload = F.to_json(F.struct("segments", "title"), {"ignoreNullFields": "false"})
    return packed.join(videos.select("video_id", "title"), "video_id").select("video_id", F.size("segments").alias("n_segments"), F.sha2(payload, 256).alias("bundle_sha256"))
