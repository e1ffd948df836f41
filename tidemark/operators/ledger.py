"""An append-only ledger of events and entities, with status by replay.

Events are (evt_id, entity_type, entity_id, from_status, to_status,
occurred_at); order within an entity is (occurred_at, evt_id). Nothing is
updated: inserts are anti-joins against what is there, and every check lists
its violations as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.tables import materialized

ENTITY = ["entity_type", "entity_id"]
ORDER = ["occurred_at", "evt_id"]

#: The allowed changes of status of each entity type.
ALLOWED = {
    "research_item": [("queued", "claimed"), ("claimed", "completed"), ("queued", "blocked"), ("blocked", "claimed")],
    "claim": [("draft", "active"), ("active", "superseded")],
    "forecast": [
        ("draft", "active"), ("active", "due"), ("due", "hit"), ("due", "miss"), ("due", "partial"), ("due", "indeterminate"),
        ("hit", "closed"), ("miss", "closed"), ("partial", "closed"), ("indeterminate", "closed"), ("active", "closed"),
    ],
    "client_implication": [("draft", "active"), ("active", "superseded")],
    "review": [("open", "completed")],
    "generated_insight": [
        ("queued", "generating"), ("generating", "ready"), ("generating", "needs_review"), ("generating", "queued"), ("needs_review", "queued"),
        ("needs_review", "ready"), ("ready", "published"), ("ready", "needs_review"), ("published", "superseded"),
    ],
}


def content_id(prefix: str, *columns: str) -> Column:
    """An identifier that follows from the key columns, so a replay makes the same one."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(F.concat_ws("|", *columns), 256), 1, 32))


def insert_new(batch: DataFrame, table: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """The batch's rows, one for each key, whose key the table lacks, with `id` made from the key."""
    same = W.partitionBy(*keys).orderBy(*[c for c in batch.columns if c not in keys])
    once = batch.withColumn("nth_", F.row_number().over(same)).where("nth_ = 1").drop("nth_")
    return once.join(table.select(*keys).distinct(), keys, "left_anti").withColumn("id", content_id(prefix, *keys))


def payload_hash(**fields: Column | str) -> Column:
    """SHA-256 of compact JSON with sorted keys."""
    return F.sha2(F.to_json(F.struct(*[F.col(v).alias(k) if isinstance(v, str) else v.alias(k) for k, v in sorted(fields.items())]), {"ignoreNullFields": "false"}), 256)


def chain_violations(events: DataFrame, entities: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Events that do not continue their entity's chain, or first ones that do not start at its initial_status.

    With a state (see `replayed`) the events are those after it, and chains go on from there.
    """
    w = W.partitionBy(*ENTITY).orderBy(*ORDER)
    rows = events.select(*ENTITY, *ORDER, "from_status", "to_status", F.lit(None).cast("long").alias("events"))
    if state is not None:
        start = state.select(*ENTITY, F.col("last_at").alias("occurred_at"), F.col("last_evt").alias("evt_id"), F.col("status").alias("to_status"), "events")
        rows = rows.unionByName(start.join(events.select(*ENTITY).distinct(), ENTITY, "left_semi"), allowMissingColumns=True)
    before = F.coalesce(F.max("events").over(W.partitionBy(*ENTITY)) - 1, F.lit(0))  # the state is a row itself
    rows = rows.withColumns({"expected": F.lag("to_status").over(w), "place": (F.row_number().over(w) + before).cast("int")})
    rows = rows.where("events is null").join(entities, ENTITY, "left")
    gap = ~F.col("from_status").eqNullSafe(F.col("expected"))
    start = (F.col("place") == 1) & F.col("initial_status").isNotNull() & (F.col("to_status") != F.col("initial_status"))
    return rows.where(gap | start).select(*ENTITY, "evt_id", "place", "expected", "from_status", F.when(gap, "discontinuous").otherwise("invalid_first").alias("problem"))


def replayed(events: DataFrame) -> DataFrame:
    """What replay leaves of each entity: status, the order (last_at, last_evt) of its last event, and their number."""
    last = F.max(F.struct(*ORDER, "to_status")).alias("e")
    return events.groupBy(*ENTITY).agg(last, F.count(F.lit(1)).alias("events")).select(
        *ENTITY, F.col("e.to_status").alias("status"), F.col("e.occurred_at").alias("last_at"), F.col("e.evt_id").alias("last_evt"), "events")


def resumed(state: DataFrame, tail: DataFrame, log: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(state, violations, late) after the events of tail, which the state does not know; log: all events, tail's too.

    Only the tail is replayed, on top of the state. An entity with an event in the tail that is not after
    the last one of its state is late: all of its events are replayed from the log, and its violations are
    all it has; those of other entities are the tail's.
    """
    known = state.select(*ENTITY, F.struct(F.col("last_at").alias("occurred_at"), F.col("last_evt").alias("evt_id")).alias("known"))
    late = tail.join(known, ENTITY).where(F.struct(*ORDER) <= F.col("known")).select(*ENTITY).distinct()
    late = materialized(late, "late")
    again = log.join(late, ENTITY, "left_semi")
    on_time = tail.join(late, ENTITY, "left_anti")
    standing = state.join(late, ENTITY, "left_anti")
    violations = chain_violations(again, entities).unionByName(chain_violations(on_time, entities, standing))
    newest = F.max(F.struct("last_at", "last_evt", "status")).alias("e")
    both = standing.unionByName(replayed(on_time)).groupBy(*ENTITY).agg(newest, F.sum("events").alias("events"))
    after = both.select(*ENTITY, "e.status", "e.last_at", "e.last_evt", "events").unionByName(replayed(again))
    return after, violations, late


def status(entities: DataFrame, events: DataFrame) -> DataFrame:
    """entities with their status: that of the last event, or the initial one."""
    last = events.groupBy(*ENTITY).agg(F.max_by("to_status", F.struct(*ORDER)).alias("last"))
    return entities.join(last, ENTITY, "left").withColumn("status", F.coalesce("last", "initial_status")).drop("last")


def allowed_pairs(spark) -> DataFrame:
    rows = [(kind, a, b) for kind, pairs in ALLOWED.items() for a, b in pairs]
    return spark.createDataFrame(rows, "entity_type string, current string, to_status string")


def legality(proposed: DataFrame, artifacts: DataFrame) -> DataFrame:
    """proposed (entity_type, entity_id, current, to_status, ..) with verdict: accepted, illegal_transition or artifact_missing."""
    pairs = F.broadcast(allowed_pairs(proposed.sparkSession)).withColumn("legal", F.lit(True))
    have = artifacts.select("entity_id").distinct().withColumn("has_artifact", F.lit(True))
    needs = (F.col("entity_type") == "generated_insight") & F.col("to_status").isin("ready", "published")
    joined = proposed.join(pairs, ["entity_type", "current", "to_status"], "left").join(have, "entity_id", "left")
    verdict = F.when(F.col("legal").isNull(), "illegal_transition").when(needs & F.col("has_artifact").isNull(), "artifact_missing").otherwise("accepted")
    return joined.withColumn("verdict", verdict).select(*proposed.columns, "verdict")


def predecessor(insights: DataFrame, provenance: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each metric in wanted: the newest insight now published (entity_id, status, created_at) that cites it (ins_id, metric_id)."""
    newest = F.struct("created_at", "entity_id")
    return wanted.join(provenance, "metric_id").join(insights.where("status = 'published'").withColumnRenamed("entity_id", "ins_id").withColumn("entity_id", F.col("ins_id")), "ins_id").groupBy("metric_id").agg(F.max_by("ins_id", newest).alias("ins_id"))


def failure_events(failures: DataFrame) -> DataFrame:
    """failures (source, series, error_class, detail, occurred_at) as events of the virtual entity source/series."""
    return failures.select(F.lit("intake").alias("entity_type"), F.concat_ws("/", "source", "series").alias("entity_id"), F.lit(None).cast("string").alias("from_status"), F.lit("failed").alias("to_status"), F.concat_ws(": ", "error_class", "detail").alias("reason"), "occurred_at")


def dossier(claims: DataFrame, evidence: DataFrame, forecasts: DataFrame, implications: DataFrame, events: DataFrame) -> DataFrame:
    """One row for each claim: cited evidence (missing marked), forecasts, implications and its statuses in order."""
    cited = claims.select("claim_id", F.posexplode("evidence_ids").alias("pos", "evi_id")).join(evidence.select("evi_id", "metric_id"), "evi_id", "left")
    cited = cited.groupBy("claim_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.concat_ws("=", "evi_id", F.coalesce("metric_id", F.lit("missing"))).alias("x")))), lambda r: r["x"]), ",").alias("evidence"))
    listed = lambda df, col, out: df.groupBy("claim_id").agg(F.array_join(F.sort_array(F.collect_set(F.col(col).cast("string"))), ",").alias(out))
    past = events.where("entity_type = 'claim'").groupBy(F.col("entity_id").alias("claim_id")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*ORDER, "to_status"))), lambda r: r["to_status"]), ">").alias("history"))
    joined = claims.select("claim_id")
    for part in (cited, listed(forecasts, "forecast_id", "forecasts"), listed(implications, "implication_id", "implications"), past):
        joined = joined.join(part, "claim_id", "left")
    return joined.fillna("", ["evidence", "forecasts", "implications", "history"])


def audit(provenance: DataFrame, insights: DataFrame, references: list[str], keys: list[str]) -> DataFrame:
    """(problem, key): provenance without its insight, without exactly one reference, or with a repeated key."""
    held = sum((F.col(r).isNotNull().cast("int") for r in references), F.lit(0))
    name = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    orphans = provenance.join(insights.select("ins_id"), "ins_id", "left_anti").select(F.lit("orphan").alias("problem"), name.alias("key"))
    loose = provenance.where(held != 1).select(F.lit("not_exactly_one").alias("problem"), name.alias("key"))
    twice = provenance.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("repeated").alias("problem"), name.alias("key"))
    return orphans.unionByName(loose).unionByName(twice)


def enqueue(requests: DataFrame, existing: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Each request's id: the existing one of its key, or a new one; created tells which."""
    found = requests.join(existing.select(*keys, F.col("id").alias("old")), keys, "left")
    return found.select(*requests.columns, F.coalesce("old", content_id(prefix, *keys)).alias("id"), F.col("old").isNull().alias("created"))


def provenance_rows(artifacts: DataFrame, refs: str = "refs") -> DataFrame:
    """(ins_id, ref, role, ordinal) of each artifact's list of references; of a repeated (ref, role) the first place."""
    rows = artifacts.select("ins_id", "role", F.posexplode(refs).alias("ordinal", "ref"))
    return rows.groupBy("ins_id", "ref", "role").agg(F.min("ordinal").alias("ordinal"))


def created(entities: DataFrame, entity_type: str) -> DataFrame:
    """First events (None -> initial_status) of new entities (entity_id, initial_status, created_at)."""
    return entities.select(F.lit(entity_type).alias("entity_type"), "entity_id", F.lit(None).cast("string").alias("from_status"), F.col("initial_status").alias("to_status"), F.col("created_at").alias("occurred_at"))


def attempt_log(attempts: DataFrame) -> DataFrame:
    """Attempts with their detail kept only as a hash."""
    return attempts.select("entity_id", "stage", "outcome", "error_class", F.sha2("detail", 256).alias("detail_sha256"))
