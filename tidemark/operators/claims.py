"""Validation of quoted claim candidates against transcript segments, and what accepted ones become."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tables import materialized, once
from .ledger import content_id
from .transcripts import fold, unsettling

#: The fields a claim needs, and those that are numbers.
REQUIRED = ("claim_text", "claim_type", "layer", "transcript_version_id", "segment_start_ordinal", "segment_end_ordinal", "start_ms", "end_ms", "exact_quote", "timestamp_url", "raw_caption_sha256")
NUMBERS = ("transcript_version_id", "segment_start_ordinal", "segment_end_ordinal", "start_ms", "end_ms")
#: Words that couple judgements, sentence ends, and speakers that are none.
COUPLING_CN = "(因为|所以|然而|但是|尽管|虽然|并且|同时|此外)"
COUPLING_EN, SENTENCE_ENDS = "(?i)\\b(because|therefore|however|but|although|though|and also|additionally|furthermore|moreover)\\b", "[。！？!?；;]"
#: What a text has that any match of the two patterns is in, once in lower case ("although" has "though"), and the single sentence ends.
COUPLING_WORDS = (*COUPLING_CN.strip("()").split("|"), "because", "therefore", "however", "but", "though", "and also", "additionally", "furthermore", "moreover")
ENDS = SENTENCE_ENDS.strip("[]")
NO_SPEAKER = ("", "unknown", "none", "n/a")
RELATIONS = ("defines", "uses", "exemplifies", "qualifies", "relates")


def missing_fields(fields: tuple[str, ...] = REQUIRED) -> Column:
    """Names of the fields that are null or empty (0 is a value)."""
    return F.filter(F.array(*[F.when(F.col(f).isNull() | (F.col(f).cast("string") == ""), F.lit(f)) for f in fields]), lambda x: x.isNotNull())


def model_statement(from_model: Column) -> Column:
    return from_model & (F.col("layer") == "speaker_statement")


def unknown_speaker() -> Column:
    return (F.col("layer") == "speaker_statement") & F.lower(F.trim(F.coalesce("speaker", F.lit("")))).isin(*NO_SPEAKER)


def not_atomic() -> Column:
    """Whether a claim couples judgements. The patterns, slow on long texts, are counted only where one of their words is at all."""
    text = F.coalesce("claim_text", F.lit(""))
    ends = reduce(lambda a, b: a + b, [F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in ENDS])
    low = F.lower(text)
    words = reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in COUPLING_WORDS])
    return (ends >= 3) | F.when(words, F.regexp_count(text, F.lit(COUPLING_CN)) + F.regexp_count(text, F.lit(COUPLING_EN)) >= 2).otherwise(False)


def bad_range() -> Column:
    a, b = F.col("segment_start_ordinal"), F.col("segment_end_ordinal")
    return F.coalesce((a < 0) | (b < a) | (b >= F.col("total")) | (F.col("end_ms") < F.col("start_ms")), F.lit(True))


def judged(claims: DataFrame, segments: DataFrame) -> DataFrame:
    """claims with the outcome of each rule (missing, r10, r4, r5, r3, r2) and `rule_id`, the first that fails, in that order; null if accepted.

    segments: transcript_version_id, ordinal, text. A quote whose start segment is absent or empty fails R1.
    """
    total = segments.groupBy("transcript_version_id").agg((F.max("ordinal") + 1).alias("total"))
    start = segments.select("transcript_version_id", F.col("ordinal").alias("segment_start_ordinal"), F.col("text").alias("segment_text"))
    rows = claims.join(total, "transcript_version_id", "left").join(start, ["transcript_version_id", "segment_start_ordinal"], "left")
    rows = rows.withColumns({"q_": fold(F.col("exact_quote")), "t_": fold(F.col("segment_text"))})
    rows = rows.withColumns({
        "missing": missing_fields(), "r10": F.coalesce(model_statement(F.col("from_model")), F.lit(False)), "r4": F.coalesce(unknown_speaker(), F.lit(False)), "r5": not_atomic(), "r3": bad_range(),
        "no_segment": F.coalesce("segment_text", F.lit("")) == "", "r2": ~F.coalesce((F.col("q_") != "") & F.contains("t_", "q_"), F.lit(False)),
    })
    first = F.when(F.size("missing") > 0, "R1").when(F.col("r10"), "R10").when(F.col("r4"), "R4").when(F.col("r5"), "R5").when(F.col("r3"), "R3").when(F.col("no_segment"), "R1").when(F.col("r2"), "R2")
    return rows.withColumn("rule_id", first).drop("q_", "t_", "total", "segment_text")


def accepted(claims: DataFrame, segments: DataFrame) -> DataFrame:
    """The claims that `judged` gives no rule_id, by the same rules, the cheaper ones first.

    What a claim's own fields decide is decided before its transcript is looked up, and only quotes that are left are folded
    and searched; so the texts of claims that fail early are neither moved nor read.
    """
    has = lambda f: F.col(f).isNotNull() & (F.col(f).cast("string") != "")
    a, b, quote, text = map(F.col, ("segment_start_ordinal", "segment_end_ordinal", "exact_quote", "segment_text"))
    own = claims.where(reduce(lambda x, y: x & y, map(has, REQUIRED)) & ~F.coalesce(model_statement(F.col("from_model")), F.lit(False)) & ~F.coalesce(unknown_speaker(), F.lit(False)))
    own = own.where((a >= 0) & (b >= a) & (F.col("end_ms") >= F.col("start_ms"))).where(~not_atomic())
    total = segments.groupBy("transcript_version_id").agg((F.max("ordinal") + 1).alias("total"))
    start = segments.where("text <> ''").select("transcript_version_id", F.col("ordinal").alias("segment_start_ordinal"), F.col("text").alias("segment_text"))
    rows = own.where(quote.rlike("(?U)[^\\s\ufeff]")).join(total, "transcript_version_id").where(b < F.col("total")).join(start, ["transcript_version_id", "segment_start_ordinal"])
    # In a text that NFC leaves alone, what is in it as it stands is in it folded too.
    as_it_stands = F.contains(text, quote) & ~unsettling(text)
    return rows.where(as_it_stands | F.contains(fold(text), fold(quote))).select(*claims.columns)


def edge_without_source() -> Column:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    return F.coalesce((F.col("layer") == "speaker_reasoning") & (blank("transcript_version_id") | blank("exact_quote")), F.lit(False))


def concept_without_source(concepts: DataFrame, sources: DataFrame) -> DataFrame:
    """Canonical concepts (name, status) that no source row names."""
    return concepts.where("status = 'canonical'").join(sources.select("name").distinct(), "name", "left_anti")


def evaluation_without_evidence(evaluator: Column, *fields: str) -> Column:
    return (evaluator == "macro_bridge") & (F.size(missing_fields(fields)) > 0)


def forecast_without_criteria() -> Column:
    none = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    return none("outcome_condition") | (none("time_window_start") & none("time_window_end"))


BUNDLE = "claims array<string>, concepts array<string>, evaluations array<string>, edges array<string>, forecasts array<string>"
ITEMS = {
    "claims": ", ".join(f"{f} {'string' if f not in NUMBERS else 'bigint'}" for f in (*REQUIRED, "speaker")),
    "concepts": "status string, concept_source string",
    "evaluations": "evaluator string, external_evidence struct<publisher:string,observed_period:string,content_sha256:string>",
    "edges": "layer string, transcript_version_id string, exact_quote string",
    "forecasts": "outcome_condition string, time_window_start string, time_window_end string",
}
#: The rule that an item of a kind fails if it is no object at all.
SHAPE_RULE = {"claims": "R1", "concepts": "R7", "evaluations": "R8", "edges": "R6", "forecasts": "R9"}


def bundle_items(bundles: DataFrame, segments: DataFrame) -> DataFrame:
    """(bundle_id, kind, index, verdict) of each item of bundles (bundle_id, from_model, body: JSON of five arrays).

    Each kind goes through its own rules: claims through all of `judged` (with the bundle's from_model), concepts,
    evaluations, edges and forecasts through theirs. The verdict is the rule that fails, or `accepted`.
    Bundles are read once, and kept as the arrays of their items, of which each kind is read by itself.
    """
    parsed = materialized(bundles.select("bundle_id", "from_model", F.from_json("body", BUNDLE).alias("b")), "bundles")
    key = ["bundle_id", "kind", "index"]

    def items(kind: str) -> tuple[DataFrame, DataFrame]:
        """The items of a kind that are objects, with their fields, and the verdicts of those that are none."""
        rows = parsed.select("bundle_id", "from_model", F.lit(kind).alias("kind"), F.posexplode(F.col(f"b.{kind}")).alias("index", "item"))
        is_object = F.coalesce(F.ltrim("item").startswith("{"), F.lit(False))
        fields = once(rows.where(is_object), x=F.from_json("item", ITEMS[kind])).select(*key, "from_model", "x.*")
        return fields, rows.where(~is_object).select(*key, F.lit(SHAPE_RULE[kind]).alias("rule_id"))

    claims, *odd = items("claims")
    concepts, other = items("concepts")
    named = concepts.withColumn("name", F.struct("bundle_id", "index"))
    sourced = named.where("coalesce(concept_source, '') <> ''").select("name")
    bare = concept_without_source(named, sourced).select(*key, F.lit("R7").alias("rule_id"))
    concepts = concepts.select(*key).join(bare, key, "left")
    by_rule = [judged(claims, segments).select(*key, "rule_id"), concepts, *odd, other]
    checks = {
        "evaluations": ("R8", evaluation_without_evidence(F.col("evaluator"), *(f"external_evidence.{f}" for f in ("publisher", "observed_period", "content_sha256")))),
        "edges": ("R6", edge_without_source()), "forecasts": ("R9", forecast_without_criteria()),
    }
    for kind, (rule, fails) in checks.items():
        rows, other = items(kind)
        by_rule += [rows.select(*key, F.when(F.coalesce(fails, F.lit(False)), rule).alias("rule_id")), other]
    verdicts = reduce(DataFrame.unionByName, by_rule)
    return verdicts.select(*key, F.coalesce("rule_id", F.lit("accepted")).alias("verdict"))


def fan_out(accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted candidates as claim rows and claim_source rows, under one content-derived id."""
    named = accepted.withColumn("claim_id", content_id("clm", "transcript_version_id", "candidate", "claim_text"))
    return named.select("claim_id", "candidate", "claim_text", "claim_type", "layer"), named.select("claim_id", "transcript_version_id", "segment_start_ordinal", "segment_end_ordinal", "exact_quote")


def rejected_rows(rejected: DataFrame) -> DataFrame:
    return rejected.select("candidate", F.concat(F.lit("[rejected:"), "rule_id", F.lit("] "), F.coalesce("claim_text", F.lit(""))).alias("text"), F.lit("system_evaluation").alias("layer"))


def upsert_concepts(proposed: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new concepts (name, concept_id), all pairs (name, domain)) of proposed (name, domain_slugs)."""
    names = proposed.select("name").distinct().join(existing.select("name"), "name", "left_anti").withColumn("concept_id", content_id("cpt", "name"))
    return names, proposed.select("name", F.explode("domain_slugs").alias("domain")).where("domain <> ''").distinct()


def anchor_sources(concepts: DataFrame, segments: DataFrame) -> DataFrame:
    """Source rows of concepts (name, transcript_version_id, ordinal, quote, role) whose quote is in its segment; role and quote default."""
    rows = concepts.join(segments.select("transcript_version_id", "ordinal", "text"), ["transcript_version_id", "ordinal"])
    rows = rows.withColumn("quote", F.coalesce("quote", "text")).withColumns({"q_": fold(F.col("quote")), "t_": fold(F.col("text"))})
    return rows.where((F.col("q_") != "") & F.contains("t_", "q_")).select("name", "transcript_version_id", "ordinal", F.sha2("quote", 256).alias("quote_sha256"), F.coalesce("role", F.lit("mention")).alias("role"))


def concept_links(links: DataFrame, accepted: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links of accepted claims with a valid relation, once a pair; names that no concept has yet)."""
    good = links.join(accepted.select("candidate"), "candidate", "left_semi").where(F.col("relation").isin(*RELATIONS))
    pairs = good.groupBy("candidate", "name").agg(F.min("relation").alias("relation"))
    return pairs, pairs.select("name").distinct().join(known.select("name"), "name", "left_anti")


def reasoning_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges (from_candidate, to_candidate, relation, ..) whose ends are both resolved and that have their source, once a triple."""
    end = lambda c, out: ids.select(F.col("candidate").alias(c), F.col("claim_id").alias(out))
    rows = edges.where(~edge_without_source()).join(end("from_candidate", "from_id"), "from_candidate").join(end("to_candidate", "to_id"), "to_candidate")
    return rows.select("from_id", "to_id", "relation").distinct()


def unanalysed(runs: DataFrame, claims: DataFrame) -> DataFrame:
    """The newest successful analysis (run_id) of each transcript, unless claims of that run exist."""
    newest = runs.where("status = 'ok'").groupBy("transcript_version_id").agg(F.max_by("run_id", F.struct("finished_at", "run_id")).alias("run_id"))
    return newest.join(claims.select("run_id").distinct(), "run_id", "left_anti")


def merge_aliases(aliases: DataFrame, existing: DataFrame) -> DataFrame:
    """New (name, alias) pairs."""
    return aliases.select("name", "alias").where("alias <> ''").distinct().join(existing, ["name", "alias"], "left_anti")


def promote(concepts: DataFrame, sources: DataFrame) -> DataFrame:
    """concepts (name, status) with proposed ones made canonical that have a source of their name."""
    have = sources.select("name").distinct().withColumn("sourced", F.lit(True))
    return concepts.join(have, "name", "left").select("name", F.when((F.col("status") == "proposed") & F.col("sourced"), "canonical").otherwise(F.col("status")).alias("status"))


def seed_dimension(current: DataFrame, seed: DataFrame) -> DataFrame:
    """(slug, name): seed rows that are absent come in, blank names are filled, curated names stay."""
    return seed.withColumnRenamed("name", "seed_name").join(current, "slug", "full").select("slug", F.coalesce(F.nullif(F.col("name"), F.lit("")), "seed_name").alias("name"))
