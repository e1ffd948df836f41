"""Threshold and cross-series rules over statistics and readings.

Rules are small tables with one row a rule; they are joined to readings on
their keys, so no reading is compared with a rule of another series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FIELDS = ("value", "prev", "mom_pct", "yoy_pct")


def fixed(x: Column, digits: int) -> Column:
    """x with so many decimals, rounded by its exact binary value (half to even), without separators."""
    return F.replace(F.format_number(x, digits), F.lit(","), F.lit(""))


def field_of(name: str, prefix: str = "") -> Column:
    """The statistic that column `name` of a rule asks for; null for an unknown one."""
    pick = F.lit(None).cast("double")
    for f in FIELDS:
        pick = F.when(F.col(name) == f, F.col(prefix + f)).otherwise(pick)
    return pick


def single_rules(updates: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules (rule_id, source, series, field, op, lo, hi, invert, flag, note) that fire on this batch's updates.

    op: gt, lt, eq against lo; range is lo <= value <= hi, outside it if invert. Unknown ops never fire.
    """
    hit = (
        F.when(F.col("op") == "gt", F.col("reading") > F.col("lo")).when(F.col("op") == "lt", F.col("reading") < F.col("lo")).when(F.col("op") == "eq", F.col("reading") == F.col("lo"))
        .when(F.col("op") == "range", F.col("reading").between(F.col("lo"), F.col("hi")) != F.coalesce("invert", F.lit(False))).otherwise(False)
    )
    said = F.format_string("**%s** — %s（%s=%s）", "flag", F.coalesce("note", F.lit("")), "field", fixed(F.col("reading"), 2))
    return rules.join(updates, ["source", "series"]).withColumn("reading", field_of("field")).where(F.col("reading").isNotNull() & hit).select("rule_id", "source", "series", "field", "reading", said.alias("text"))


def cross_rules(readings: DataFrame, rules: DataFrame, updated: DataFrame) -> DataFrame:
    """Rules (rule_id, a_source, a_series, a_field, how, b_.., op, threshold, flag, note) with at least one operand in `updated`.

    how: minus, or ratio (nothing when b is 0); compared by gt or lt.
    """
    side = lambda p: readings.select(*[F.col(c).alias(f"{p}_{c}") for c in ("source", "series", *FIELDS)])
    keys = lambda p: updated.select(F.col("source").alias(f"{p}_source"), F.col("series").alias(f"{p}_series")).distinct()
    fresh = rules.join(keys("a"), ["a_source", "a_series"], "left_semi").select("rule_id").union(rules.join(keys("b"), ["b_source", "b_series"], "left_semi").select("rule_id")).distinct()
    both = rules.join(fresh, "rule_id", "left_semi").join(side("a"), ["a_source", "a_series"]).join(side("b"), ["b_source", "b_series"])
    both = both.withColumns({"va": field_of("a_field", "a_"), "vb": field_of("b_field", "b_")}).where("va is not null and vb is not null")
    computed = F.when(F.col("how") == "minus", F.col("va") - F.col("vb")).when(F.col("how") == "ratio", F.try_divide("va", "vb"))
    hit = F.when(F.col("op") == "gt", F.col("computed") > F.col("threshold")).when(F.col("op") == "lt", F.col("computed") < F.col("threshold")).otherwise(False)
    tenths = lambda c: fixed(F.col(c), 1)
    said = F.format_string("**%s** — %s（%s(%s) %s %s(%s) = %s）", "flag", F.coalesce("note", F.lit("")), "a_series", tenths("va"), "how", "b_series", tenths("vb"), tenths("computed"))
    return both.withColumn("computed", computed).where(F.col("computed").isNotNull() & hit).select("rule_id", "va", "vb", "computed", said.alias("text"))
