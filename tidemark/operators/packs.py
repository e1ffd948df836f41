"""Fact packs: the evidence, claims and forecasts that a document may rest on, in one canonical, hashed form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..sources.tables import materialized, salted_join
from .numbers import number_key, subtracted
from .series import history


#: Rows of evidence, or of sections, up to which they go to every task whole.
FEW = 100_000


def enrich(evidence: DataFrame, obs: DataFrame, publishers: DataFrame, limit: int = 24) -> DataFrame:
    """evidence (evi_id, metric_id `source:series`, publisher, ..) with its last `limit` observations, the value before the last, publisher, official flag and missing_metrics, the months that these observations leave out.

    A series without observations has those of its change (`series_yoy`), under which metrics that are only a change are kept.
    The publisher is the evidence's own, else that of its source, else the source. publishers: source, source_publisher, official.
    """
    split = evidence.withColumns({"source": F.regexp_extract("metric_id", "^([^:]*):", 1), "series": F.regexp_extract("metric_id", "^[^:]*:(.*)$", 1)})
    past = history(obs, limit).groupBy("source", "series").agg(F.sort_array(F.collect_list(F.struct("period", "value"))).alias("history"))
    changes = past.select("source", F.regexp_replace("series", "_yoy$", "").alias("series"), F.col("history").alias("change_history")).where(past["series"].endswith("_yoy"))
    joined = split.join(past, ["source", "series"], "left").join(changes, ["source", "series"], "left").join(publishers, "source", "left")
    joined = joined.withColumn("history", F.coalesce("history", "change_history")).drop("change_history")
    month = lambda k: F.concat(F.try_element_at("history", F.lit(k))["period"], F.lit("-01")).try_cast("date")
    months = F.round(F.months_between(month(-1), month(1)))
    return joined.withColumns({
        "previous_value": F.try_element_at("history", F.lit(-2))["value"], "n_history": F.coalesce(F.size("history"), F.lit(0)),
        "missing_metrics": F.coalesce(months + 1 - F.size("history"), F.lit(0)).cast("long"), "publisher": F.coalesce("publisher", "source_publisher", "source"), "official_primary": F.coalesce("official", F.lit(False)),
    }).drop("source_publisher", "official")


def related_claims(items: DataFrame, claims: DataFrame) -> DataFrame:
    """(pack_id, claim_id): an item's own claim, the requested ones, and claims that cite any of its evidence.

    items: pack_id, claim_id, requested array, evidence_ids array; claims: claim_id, evidence_ids array.
    """
    own = items.select("pack_id", "claim_id").where("claim_id is not null").unionByName(items.select("pack_id", F.explode("requested").alias("claim_id")))
    cited = claims.select("claim_id", F.explode("evidence_ids").alias("evi_id"))
    wanted = items.select("pack_id", F.explode("evidence_ids").alias("evi_id")).distinct()
    # Evidence that very many claims cite is dealt out, unless all that packs rest on is little; few packs rest on one piece of evidence.
    by_evidence = salted_join(cited, wanted, ["evi_id"], F.col("claim_id"), to_broadcast=FEW).select("pack_id", "claim_id")
    return own.join(claims.select("claim_id"), "claim_id", "left_semi").select("pack_id", "claim_id").unionByName(by_evidence).distinct()


def related_forecasts(pack_claims: DataFrame, forecasts: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """(pack_id, forecast_id, claim_id, status) of all forecasts of a pack's claims, and of the requested ones (pack_id, forecast_id) that there are.

    forecasts: forecast_id, claim_id, status. Each row comes once: both sides are made distinct before they meet, as packs share
    most claims and what they make is many times either, and requested ones come in where the pack does not have their claim.
    """
    columns = ["pack_id", "forecast_id", "claim_id", "status"]
    pairs = pack_claims.select("pack_id", "claim_id").distinct()
    rows = salted_join(pairs, forecasts.select(*columns[1:]).distinct(), ["claim_id"], F.col("pack_id")).select(*columns)
    if requested is not None:
        asked = salted_join(forecasts, requested.select("pack_id", "forecast_id"), ["forecast_id"], F.col("claim_id"), to_broadcast=FEW).select(*columns).distinct()
        rows = rows.unionByName(asked.join(pairs, ["pack_id", "claim_id"], "left_anti").select(*columns))
    return rows


def derived(evidence: DataFrame, spreads: DataFrame) -> DataFrame:
    """(pack_id, id, formula, a, b, value, unit, note): spreads between two metrics of a pack, where both have a value.

    spreads: pack_id, id, metric_a, metric_b, unit, note.
    """
    side = lambda c: evidence.select("pack_id", F.col("metric_id").alias(f"metric_{c}"), F.col("value").alias(c)).where(F.col(c).isNotNull())
    both = spreads.join(side("a"), ["pack_id", "metric_a"]).join(side("b"), ["pack_id", "metric_b"])
    return both.select("pack_id", "id", F.concat_ws(" - ", "metric_a", "metric_b").alias("formula"), "a", "b", subtracted(F.col("a"), F.col("b")).alias("value"), "unit", "note")


def quality_gate(evidence: DataFrame, spreads: DataFrame, flags: DataFrame) -> DataFrame:
    """One row for each pack_id: what its evidence is worth, and the checklist of a pack that rests on several books.

    spreads: derived values (pack_id, note); flags: pack_id, flag. all() of nothing is true.
    """
    official = F.col("official_primary")
    rows = evidence.groupBy("pack_id").agg(
        F.bool_and("official_primary").alias("official_primary_only"), F.count_if("official_primary").alias("official_evidence_count"),
        F.count_distinct(F.when(official, F.col("publisher"))).alias("independent_publisher_count"),
        F.bool_and((F.coalesce("observed_period", F.lit("")) != "") & F.col("unit").isNotNull()).alias("period_scope_unit_explicit"),
    )
    notes = spreads.groupBy("pack_id").agg(F.bool_and(F.coalesce("note", F.lit("")) != "").alias("noted"))
    flagged = flags.select("pack_id").distinct().withColumn("flagged", F.lit(True))
    return rows.join(notes, "pack_id", "left").join(flagged, "pack_id", "left").select(
        "pack_id", "official_primary_only", "official_evidence_count", "independent_publisher_count", F.col("official_primary_only").alias("original_tables_first"), "period_scope_unit_explicit",
        F.coalesce("noted", F.lit(True)).alias("stock_flow_arithmetic_precomputed"), ((F.col("independent_publisher_count") >= 2) | F.col("noted").isNotNull()).alias("cross_book_signal_present"),
        F.coalesce("flagged", F.lit(False)).alias("trigger_flags_are_leads"),
    )


#: What a reader of a pack is asked to apply; a parameter of canonical().
FRAMEWORKS = ("separate stocks from flows", "compare like periods", "look for the counter case")


def members(items: DataFrame, evidence: DataFrame, claims: DataFrame, forecasts: DataFrame) -> DataFrame:
    """(pack_id, section, id, json): the claims and forecasts of each pack, and (allowed) all ids that a document on it may name, each once, whose json is null.

    Claims and forecasts come with each row once, and as tables: their JSON is written anew for each use, which is less than to keep it.
    """
    text = lambda c: F.col(c).cast("string")
    row = lambda of, section, key, body: of.select("pack_id", F.lit(section).alias("section"), text(key).alias("id"), body.alias("json"))
    claim = F.to_json(F.struct(text("claim_id").alias("id"), F.array_sort("evidence_ids").alias("evidence_ids")))
    forecast = F.to_json(F.struct(text("forecast_id").alias("id"), text("claim_id").alias("claim_id"), "status"), {"ignoreNullFields": "false"})
    named = [of.select("pack_id", text(key).alias("id")) for of, key in ((claims, "claim_id"), (forecasts, "forecast_id"), (evidence, "evi_id"), (items, "item_id"))]
    allowed = materialized(reduce(DataFrame.unionByName, named).distinct(), "pack-allowed")
    return row(claims, "claims", "claim_id", claim).unionByName(row(forecasts, "forecasts", "forecast_id", forecast)).unionByName(row(allowed, "allowed", "id", F.lit(None).cast("string")))


def digested(rows: DataFrame, each: int = 1000) -> DataFrame:
    """(pack_id, section, n, sha256): one digest for the members (pack_id, section, id, json) of a section, however many. A null json stands for the id itself.

    Members are dealt over chunks of about `each` by a hash of their id; a chunk's digest is over
    its members in order of id, and the section's over the digests of its chunks in order.
    """
    keys = ["pack_id", "section"]
    sizes = materialized(rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / each).alias("chunks_")), "pack-sections")
    total = sizes.agg(F.sum("chunks_")).first()[0] or 0
    chunk = F.conv(F.substring(F.md5("id"), 1, 8), 16, 10).cast("long") % F.col("chunks_")
    dealt = salted_join(rows, sizes, keys, F.col("id"), to_broadcast=FEW).select(*keys, chunk.alias("chunk"), "id", "json")
    # Collecting in each task before members meet would only sort them once more. Some 60 chunks a task are grouped without a sort.
    dealt = dealt.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // 60)), *keys, "chunk")
    # No element is null, so sort_array gives the order of array_sort, without a function called for each comparison.
    in_order = lambda by, what: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(by, what))), lambda x: F.coalesce(x[what], x[by].cast("string"))), "\n")
    digests = dealt.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("c"), F.sha2(in_order("id", "json"), 256).alias("digest"))
    return digests.groupBy(*keys).agg(F.sum("c").alias("n"), F.sha2(in_order("chunk", "digest"), 256).alias("sha256"))


def canonical(items: DataFrame, evidence: DataFrame, held: DataFrame, spreads: DataFrame, flags: DataFrame, frameworks: tuple[str, ...] = FRAMEWORKS, version: int = 1) -> DataFrame:
    """(pack_id, as_of, n_allowed, pack_json, pack_sha256): each pack as JSON with sorted keys and members.

    items: pack_id, item_id, queue_source, title, priority (one research item a pack); held: the `members` of packs. As claims and
    forecasts of a pack have no bound, it has their number and digest; so its hash covers them, and no task holds them together.
    Numbers are exact, as number_key writes them. Packs without evidence are left out.
    """
    exact = lambda c: number_key(c.cast("string"))
    past = F.transform("history", lambda x: F.struct(x["period"].alias("period"), exact(x["value"]).alias("value")))
    piece = F.struct(
        past.alias("history"), F.col("evi_id").alias("id"), "metric_id", F.col("official_primary").alias("official"), F.col("observed_period").alias("period"),
        exact(F.col("previous_value")).alias("previous_value"), "publisher", "unit", exact(F.col("value")).alias("value"),
    )
    listed = lambda df, of, out: df.groupBy("pack_id").agg(F.array_sort(F.collect_set(of)).alias(out))
    evi = evidence.groupBy("pack_id").agg(F.array_sort(F.collect_set(F.struct(F.col("evi_id").alias("id"), piece.alias("piece")))).alias("evidence"), F.max("observed_period").alias("as_of"))
    # A section has one digest, so max only picks it.
    digest = digested(held).groupBy("pack_id").agg(*[F.max(F.when(F.col("section") == name, F.struct("n", "sha256"))).alias(name) for name in ("allowed", "claims", "forecasts")])
    spread = F.struct("id", "formula", exact(F.col("a")).alias("a"), exact(F.col("b")).alias("b"), exact(F.col("value")).alias("value"), "unit", "note")
    gate = quality_gate(evidence, spreads, flags)
    gate = gate.select("pack_id", F.struct(*sorted(c for c in gate.columns if c != "pack_id")).alias("quality_gate"))
    parts = [digest, listed(spreads, spread, "derived_values"), listed(flags, F.col("flag"), "flags"), gate]
    joined = reduce(lambda x, y: x.join(y, "pack_id", "left"), parts, evi.join(items, "pack_id"))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.sha2(F.lit(""), 256).alias("sha256"))
    joined = joined.withColumns({c: F.coalesce(F.col(c), none) for c in ("allowed", "claims", "forecasts")})
    joined = joined.withColumns({c: F.coalesce(F.col(c), F.array().cast(joined.schema[c].dataType)) for c in ("derived_values", "flags")})
    joined = joined.withColumns({
        "evidence": F.transform("evidence", lambda x: x["piece"]), "frameworks": F.array(*map(F.lit, frameworks)), "version": F.lit(version),
        "research_item": F.struct(F.col("item_id").cast("string").alias("id"), "priority", "queue_source", "title"),
    })
    names = ("allowed", "as_of", "claims", "derived_values", "evidence", "flags", "forecasts", "frameworks", "quality_gate", "research_item", "version")
    body = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return joined.select("pack_id", "as_of", F.col("allowed.n").alias("n_allowed"), body.alias("pack_json"), F.sha2(body, 256).alias("pack_sha256"))


def missing_members(requested: DataFrame, known: DataFrame) -> DataFrame:
    """requested (pack_id, kind, id) that no known (kind, id) has."""
    return requested.distinct().join(known, ["kind", "id"], "left_anti").select("pack_id", "kind", "id")
