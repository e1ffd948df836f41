"""Time series of observations (source, series, period, value): intake, history, statistics.

Periods are sortable strings. A key is (source, series). Everything is a window
or an aggregate over the key, so a hot series is one sorted group and never a
list on the driver; histories are cut by rank before statistics are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .numbers import subtracted

KEY = ["source", "series"]


def parse_csv_rows(lines: DataFrame) -> DataFrame:
    """Columns `keys.., pos, line` of CSV text (pos 0 is the header) to `keys.., pos, period, value`; odd rows go."""
    cells = F.transform(F.split("line", ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    return (
        lines.where("pos > 0").withColumn("cells", cells).where(F.size("cells") >= 2)
        .withColumns({"period": F.col("cells")[0], "value": F.expr("try_cast(cells[1] as double)")})
        .where("value is not null and period <> ''").drop("cells", "line")
    )


def upsert(base: DataFrame, delta: DataFrame, seq: str = "seq") -> DataFrame:
    """Last writer wins on (source, series, period): the row of the highest seq, of base and delta together."""
    rows = base.unionByName(delta)
    last = F.max_by("value", seq)
    return rows.groupBy(*KEY, "period").agg(last.alias("value"), F.max(seq).alias(seq))


def history(obs: DataFrame, limit: int = 30) -> DataFrame:
    """The newest `limit` observations of each key."""
    newest = W.partitionBy(*KEY).orderBy(F.desc("period"))
    return obs.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= limit).drop("rank")


def latest(obs: DataFrame) -> DataFrame:
    return obs.groupBy(*KEY).agg(F.max("period").alias("period"), F.max_by("value", "period").alias("value"))


def pct_change(new: Column, old: Column) -> Column:
    """Null if either is null or old is 0."""
    return F.try_divide(new - old, old) * 100.0


def with_stats(obs: DataFrame) -> DataFrame:
    """obs with prev, quarterly, mom_pct, yoy_base_period, yoy_pct, trend and steps as of each row of its history."""
    w = W.partitionBy(*KEY).orderBy("period")
    months = F.collect_set(F.expr("try_cast(split(period, '-')[1] as int)")).over(w.rowsBetween(-3, 0))
    steps = F.row_number().over(w)
    base = lambda c: F.when(F.col("quarterly"), F.lag(c, 4).over(w)).otherwise(F.lag(c, 12).over(w))
    first = F.coalesce(F.lag("value", 2).over(w), F.lag("value", 1).over(w))
    rows = obs.withColumns({"steps": steps, "prev": F.lag("value", 1).over(w), "months": months, "first": first})
    quarters = F.array(*map(F.lit, (1, 4, 7, 10)))
    rows = rows.withColumn("quarterly", (F.col("steps") >= 2) & (F.size("months") > 0) & (F.size(F.array_except("months", quarters)) == 0))
    rows = rows.withColumns({"base": base("value"), "yoy_base_period": base("period")})
    both = (F.col("base") > 0) & (F.col("value") > 0)
    return rows.select(
        *KEY, "period", "value", "prev", "quarterly", pct_change(F.col("value"), F.col("prev")).alias("mom_pct"), "yoy_base_period",
        F.when(both, pct_change(F.col("value"), F.col("base"))).alias("yoy_pct"),
        F.when(F.col("first").isNull(), "—").when(F.col("value") > F.col("first"), "↑").when(F.col("value") < F.col("first"), "↓").otherwise("→").alias("trend"), "steps",
    )


def stats_summary(obs: DataFrame, limit: int = 30) -> DataFrame:
    """One row of statistics for each key, over its newest `limit` observations."""
    rows = with_stats(history(obs, limit))
    newest = W.partitionBy(*KEY).orderBy(F.desc("period"))
    return rows.withColumn("rank", F.row_number().over(newest)).where("rank = 1").drop("rank")


def calendar_yoy(obs: DataFrame) -> DataFrame:
    """Change against the first earlier row whose period starts with last year's period; rows without one (or with base 0) go."""
    numbered = obs.where("period rlike '^[0-9]{4}-[0-9]{2}'")
    now = numbered.withColumn("wanted", F.concat((F.substring("period", 1, 4).cast("int") - 1).cast("string"), F.substring("period", 5, 100)))
    # A target "2023-04" is met by "2023-04" and "2023-04-15": bases are offered under each length of prefix that a period may ask for.
    offered = numbered.select(*KEY, F.col("period").alias("base_period"), F.col("value").alias("base"), F.explode(F.array_distinct(F.array(F.substring("period", 1, 7), F.col("period")))).alias("wanted"))
    offered = offered.groupBy(*KEY, "wanted").agg(F.min("base_period").alias("base_period"), F.min_by("base", "base_period").alias("base"))
    return now.join(offered, [*KEY, "wanted"]).where("base <> 0 and base_period < period").select(*KEY, "period", "base_period", ((F.col("value") - F.col("base")) / F.col("base") * 100).alias("value"))


def level_or_rate(obs: DataFrame, bound: float = 100.0) -> DataFrame:
    """Series with a magnitude over `bound` as calendar changes, others as they are."""
    large = obs.groupBy(*KEY).agg((F.max(F.abs("value")) > bound).alias("is_level"))
    tagged = obs.join(large, KEY)
    changed = calendar_yoy(tagged.where("is_level").drop("is_level")).select(*KEY, "period", "value", F.lit(True).alias("is_level"))
    return changed.unionByName(tagged.where("not is_level").select(*KEY, "period", "value", "is_level"))


def chart_feed(obs: DataFrame, config: DataFrame) -> DataFrame:
    """config (indicator, economy, source, series) with every period's value after level_or_rate; absent series give nothing."""
    return config.join(level_or_rate(obs), KEY).select("indicator", "economy", *KEY, "period", "value")


def cross_economy(obs: DataFrame, config: DataFrame) -> DataFrame:
    """The newest value of each indicator and economy."""
    return chart_feed(obs, config).groupBy("indicator", "economy").agg(F.max("period").alias("period"), F.max_by("value", "period").alias("value"))


def derived_spread(readings: DataFrame, pairs: DataFrame) -> DataFrame:
    """a - b of two readings, subtracted as decimals of any size; pairs: id, a_source, a_series, b_source, b_series. Missing inputs give no row."""
    side = lambda p: readings.select(*[F.col(k).alias(f"{p}_{k}") for k in KEY], F.col("value").alias(f"{p}_value"))
    both = pairs.join(side("a"), ["a_source", "a_series"]).join(side("b"), ["b_source", "b_series"]).where("a_value is not null and b_value is not null")
    formula = F.concat_ws(" - ", F.concat_ws(".", "a_source", "a_series"), F.concat_ws(".", "b_source", "b_series"))
    return both.select("id", formula.alias("formula"), "a_value", "b_value", subtracted(F.col("a_value"), F.col("b_value")).alias("value"))
