"""The latest reading of each series, and reports made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.tables import ranked
from .rules import fixed

KEY = ["source", "series"]


def refresh(cache: DataFrame, updates: DataFrame) -> DataFrame:
    """An update replaces the whole entry of its key."""
    return cache.join(updates.select(*KEY).distinct(), KEY, "left_anti").unionByName(updates)


def gaps(config: DataFrame, cache: DataFrame, stats: DataFrame) -> DataFrame:
    """Entries computed for configured series that have observations but no reading."""
    return config.select(*KEY).distinct().join(cache.select(*KEY), KEY, "left_anti").join(stats, KEY)


def shown_value(value: Column, yoy: Column) -> Column:
    """Thousands without decimals from 1000 on, else two decimals; without a value, the reported change."""
    large, small = F.format_number(value, 0), fixed(value, 2)
    return F.when(value.isNotNull(), F.when(F.abs(value) >= 1000, large).otherwise(small)).when(yoy.isNotNull(), F.concat(fixed(yoy, 2), F.lit("% 同比"))).otherwise("—")


def shown_pct(pct: Column) -> Column:
    return F.when(pct.isNull(), "—").otherwise(fixed(pct, 2))


def report(readings: DataFrame) -> DataFrame:
    """Display rows in order of economy (us, cn, others), then name; `place` is that order."""
    rank = F.when(F.col("economy") == "us", 0).when(F.col("economy") == "cn", 1).otherwise(9)
    rows = ranked(readings.withColumn("rank_", rank), F.col("rank_"), F.col("name"), F.col("source"), F.col("series"), into="place")
    yoy = F.when(F.col("value").isNull(), "—").otherwise(shown_pct(F.col("yoy_pct")))
    value, mom = shown_value(F.col("value"), F.col("yoy_pct")), shown_pct(F.col("mom_pct"))
    return rows.select(
        "place", "economy", "name", value.alias("value_cell"), yoy.alias("yoy_cell"), mom.alias("mom_cell"),
        F.coalesce("trend", F.lit("—")).alias("trend"), F.coalesce("period", F.lit("—")).alias("period"),
    )


def brief(updates: DataFrame, flags: DataFrame) -> DataFrame:
    """One row for each source: number of updates, first economy, flags, and a log line of its first six readings."""
    rows = updates.groupBy("source").agg(
        F.count(F.lit(1)).alias("updates"), F.min_by("economy", "series").alias("economy"),
        F.sort_array(F.collect_list(F.struct("series", F.concat_ws("=", "name", shown_value(F.col("value"), F.col("yoy_pct"))).alias("text")))).alias("rows"),
    )
    said = flags.groupBy("source").agg(F.array_join(F.sort_array(F.collect_set("text")), "\n").alias("flags"), F.count_distinct("text").alias("n_flags"))
    line = F.array_join(F.transform(F.slice("rows", 1, 6), lambda r: r["text"]), "; ")
    return rows.join(said, "source", "left").select("source", "updates", "economy", F.coalesce("n_flags", F.lit(0)).alias("n_flags"), F.coalesce("flags", F.lit("")).alias("flags"), line.alias("line"))


def run_summary(updates: DataFrame, cross_flags: DataFrame) -> DataFrame:
    """Totals of a run, the names of its first four updates, and the number of cross flags."""
    first = updates.orderBy("source", "series").limit(4).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("source", "series", "name"))), lambda r: r["name"]), ", ").alias("names"))
    totals = updates.agg(F.count(F.lit(1)).alias("updates"), F.count_distinct("source").alias("sources"))
    return totals.join(first).join(cross_flags.agg(F.count(F.lit(1)).alias("cross_flags")))
