"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Targets. Sources in order of code point (null last) weigh `weights`,
   repeating, and share all words of the corpus by weight. A target stops at
   `max_repeat` times its source's size and the excess goes to the others by
   weight until none is above.
2. Quotas. Targets are handed out in equal blocks of `block` words by highest
   quotients target / (2k - 1), first from all words to sources, then from each
   source's blocks to its shards. Seats that any divisor in question would
   give are counted in closed form; only the few contested seats of each party
   are ranked, so the work follows the number of parties, not of blocks.
3. Selection. A shard's documents, in an order seeded by `seed`, form one line
   of words, cut in blocks. Full passes over the line are taken first; of the
   remaining quota, blocks are drawn systematically: at equal steps along the
   line from a seeded start, exactly as many as the quota asks for. A document's
   share is its words in drawn blocks, so it is never above `max_repeat` times
   its size, and equal runs give equal rows.

A source has as many shards as its size asks for, up to `most_shards`; beyond
that its shards grow, which only narrow rows (doc_id and size) sort by. Sources
are ranked by ranges, so any number of them will do. Null text has size 0. Ties
in the seeded order are ordered by doc_id, then size. Columns beyond doc_id,
text and source are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, bounded, ranked, salted_join, stage


def _sure_and_most(parties: DataFrame, vote: str) -> DataFrame:
    """parties (s_ parties, v_ votes and seats_ of their group) with the seats that are sure and the most that can come.

    With S parties and n seats, the divisor that deals exactly n lies between
    votes/(n + S/2) and votes/(n - S/2); seats above the upper one are sure and
    seats between the two are contested: O(S) in all.
    """
    seats_at = lambda d: F.when(F.col("v_") > 0, F.floor(F.col(vote) / d + 0.5)).otherwise(F.lit(0)).cast("long")
    fewer = F.col("seats_") - F.col("s_") / 2 - 1
    sure = F.when(fewer > 0, seats_at(F.col("v_") / F.greatest(fewer, F.lit(0.25)))).otherwise(F.lit(0).cast("long"))
    most = seats_at(F.col("v_") / (F.col("seats_") + F.col("s_") / 2 + 1))
    return parties.withColumn("sure_", sure).withColumn("most_", F.greatest("sure_", most))


def _with_won(parties: DataFrame, won: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    won = won.groupBy(*keys).agg(F.count(F.lit(1)).alias("won_")).select("won_", *[F.col(c).alias(f"{c}_won_") for c in keys])
    joined = parties.join(won, [F.col(c).eqNullSafe(F.col(f"{c}_won_")) for c in keys], "left")
    return joined.select(*columns, (F.col("sure_") + F.coalesce("won_", F.lit(0))).alias("quota"))


def contested() -> Column:
    return F.explode(F.sequence(F.col("sure_") + 1, F.col("most_")))


def quotient(vote: str) -> Column:
    return F.col(vote) / (2 * F.col("seat_") - 1)


def apportion(parties: DataFrame, seats: int, keys: list[str], vote: str = "votes") -> DataFrame:
    """parties (any number, keys distinct) with `quota`: `seats` dealt to all by Sainte-Lague to votes."""
    s, v = parties.agg(F.count(F.lit(1)), F.sum(vote)).first()
    sized = parties.withColumns({"s_": F.lit(s), "v_": F.lit(float(v or 0)), "seats_": F.lit(float(seats))})
    sized = stage(_sure_and_most(sized, vote), "seats")
    open_ = seats - (sized.agg(F.sum("sure_")).first()[0] or 0)
    seat = sized.where("most_ > sure_").select(*keys, contested().alias("seat_"), vote)
    won = ranked(seat.withColumn("less_", -quotient(vote)), F.col("less_"), *[F.col(c).asc() for c in keys], F.col("seat_"), into="rank_").where(F.col("rank_") <= open_)
    return _with_won(sized, won, keys, parties.columns)


def apportion_within(parties: DataFrame, group: str, seats: str, keys: list[str], vote: str = "votes") -> DataFrame:
    """parties with `quota`: in each group the column `seats` dealt by Sainte-Lague to votes; groups have bounded sizes."""
    of = W.partitionBy(group)
    sized = parties.withColumns({"s_": F.count(F.lit(1)).over(of), "v_": F.sum(vote).over(of), "seats_": F.col(seats).cast("double")})
    sized = _sure_and_most(sized, vote).withColumn("open_", F.col("seats_") - F.sum("sure_").over(of))
    seat = sized.where("most_ > sure_").select(group, *keys, "open_", contested().alias("seat_"), vote)
    won = seat.withColumn("rank_", F.row_number().over(of.orderBy(F.desc(quotient(vote)), *keys, "seat_"))).where("rank_ <= open_")
    return _with_won(sized, won, [group, *keys], parties.columns)


def source_targets(sized: DataFrame, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """source, source_size, n_ (rows), target, from source and size: weighted shares under caps. One row per source.

    Each round is one aggregate: the words left over the weights left are the
    level, and sources whose weight asks for more than their cap at this level get
    their cap. The level only rises, so no source comes back.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_"))
    place = ranked(sources, F.col("source").asc_nulls_last(), into="place")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("double")
    sources = stage(place.select("source", "source_size", "n_", weight.alias("w"), (max_repeat * F.col("source_size")).cast("double").alias("cap")), "sources")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = -1.0
    while True:
        capped = F.col("w") * level > F.col("cap")
        kept, weighed, n = sources.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("w"))), F.count_if(capped)).first()
        if not weighed or level >= 0 and n == before:
            break
        level, before = (total - kept) / weighed, n if level >= 0 else -1
    return sources.select("source", "source_size", "n_", F.least("cap", F.col("w") * max(level, 0.0)).alias("target"))


def drawn(words: Column, line: Column, quota: Column, start: Column, block: int) -> Column:
    """How many of the first `words` words of a line lie in the `quota` blocks drawn at equal steps from block `start` on.

    Counted along the circle of B blocks that begins at `start`, block i is drawn where floor((i + 1) quota / B) exceeds floor(i quota / B).
    """
    blocks = F.ceil(line / F.lit(block)).cast("long")
    up_to = lambda i: F.call_function("div", i * quota, blocks)
    along = lambda j: F.when(j + start <= blocks, up_to(j + start) - up_to(start)).otherwise(quota - up_to(start) + up_to(j + start - blocks))
    whole, part = F.floor(words / F.lit(block)).cast("long"), words % block
    return along(whole) * block + part * (along(whole + 1) - along(whole))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeat: int = 3, block: int = 4, shard_words: int = 1_000_000, most_shards: int = 10_000, seed: int = 20, sources_to_broadcast: int = 10_000,
) -> DataFrame:
    """doc_id, size, source_size, target, taken; one row for each of docs."""
    size = F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit(WORD))).cast("long")
    sized = stage(docs.select("doc_id", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("its"), size.alias("size")), "sizes")
    targets = stage(source_targets(sized, weights, max_repeat).withColumn("votes", F.col("target")), "targets")
    blocks = int((targets.agg(F.sum("target")).first()[0] or 0.0) / block + 1e-6)
    quotas = apportion(targets, blocks, ["source"]).withColumn("shards", F.least(F.lit(most_shards), F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))).cast("long"))
    quotas = stage(quotas.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("its"), "source_size", "n_", "target", "quota", "shards"), "source-quotas")
    small = bounded(quotas.drop("n_"), sources_to_broadcast)
    lined = sized.join(small, "its") if quotas.count() <= sources_to_broadcast else salted_join(sized, quotas.drop("n_"), ["its"], quotas, F.col("doc_id"))
    lined = lined.withColumns({"order": F.xxhash64("doc_id", F.lit(seed)), "shard": F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.col("shards"))})
    shards = lined.groupBy("its", "shard").agg(F.sum("size").alias("line"), F.first("quota").alias("of_source"))
    shards = apportion_within(shards.withColumn("votes", F.col("line").cast("double")), "its", "of_source", ["shard"])
    wanted = F.col("quota") * block
    passes = F.least(F.lit(max_repeat), F.floor(wanted / F.nullif(F.col("line"), F.lit(0)))).cast("long")
    of_line = F.ceil(F.col("line") / block).cast("long")
    shards = shards.where("line > 0").withColumn("passes", passes).select(
        "its", "shard", "line", "passes",
        F.when(F.col("passes") < max_repeat, F.least(of_line, F.round((wanted - F.col("passes") * F.col("line")) / block).cast("long"))).otherwise(F.lit(0)).alias("draw"),
        F.pmod(F.xxhash64("its", "shard", F.lit(seed + 2)), of_line).alias("start"),
    )
    shards = bounded(stage(shards, "shard-quotas"), sources_to_broadcast)
    along = W.partitionBy("its", "shard").orderBy("order", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(W.unboundedPreceding, 0)
    up_to = lambda words: drawn(words, F.col("line"), F.col("draw"), F.col("start"), block)
    taken = F.col("passes") * F.col("size") + up_to(F.col("end")) - up_to(F.col("end") - F.col("size"))
    return (
        lined.withColumn("end", F.sum("size").over(along)).join(shards, ["its", "shard"], "left")
        .select("doc_id", "size", "source_size", "target", F.when(F.col("line") > 0, taken).otherwise(F.lit(0)).cast("long").alias("taken"))
    )
