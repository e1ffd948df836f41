"""Queries A1-A4, D1-D11, E1-E4 and F1-F5 over order and lineitem series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import readings, rules, series
from ..sources.tables import config, observations, table

OBS = """obs AS (
    SELECT 'orders' AS source, o_orderpriority AS series, strftime(o_orderdate, '%Y-%m') AS period, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY ALL
    UNION ALL SELECT 'lineitem', l_returnflag, strftime(date_trunc('quarter', l_shipdate), '%Y-%m'), sum(l_quantity) FROM lineitem GROUP BY ALL)"""
CONFIG = """config AS (SELECT DISTINCT source, series, source || ' ' || series AS name,
    CASE WHEN series IN ('1-URGENT', 'A') THEN 'us' WHEN series IN ('2-HIGH', 'N') THEN 'cn' ELSE 'jp' END AS economy FROM obs)"""


def stats_sql(obs: str) -> str:
    """CTEs h, s: the newest 30 rows of each key, and statistics as of each of them."""
    return f"""h AS (SELECT * FROM {obs} QUALIFY row_number() OVER (PARTITION BY source, series ORDER BY period DESC) <= 30),
    m AS (SELECT *, row_number() OVER w AS steps, lag(value) OVER w AS prev, coalesce(lag(value, 2) OVER w, lag(value) OVER w) AS first,
            list_filter(list(try_cast(split_part(period, '-', 2) AS INT)) OVER (PARTITION BY source, series ORDER BY period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL) AS months,
            lag(value, 4) OVER w AS v4, lag(value, 12) OVER w AS v12, lag(period, 4) OVER w AS p4, lag(period, 12) OVER w AS p12
        FROM h WINDOW w AS (PARTITION BY source, series ORDER BY period)),
    b AS (SELECT *, steps >= 2 AND len(months) > 0 AND list_has_all([1, 4, 7, 10], months) AS quarterly FROM m),
    b2 AS (SELECT *, CASE WHEN quarterly THEN v4 ELSE v12 END AS base, CASE WHEN quarterly THEN p4 ELSE p12 END AS yoy_base_period FROM b),
    s AS (SELECT source, series, period, value, prev, quarterly, CASE WHEN prev <> 0 THEN (value - prev) / prev * 100.0 END AS mom_pct, yoy_base_period,
            CASE WHEN base > 0 AND value > 0 THEN (value - base) / base * 100.0 END AS yoy_pct,
            CASE WHEN first IS NULL THEN '—' WHEN value > first THEN '↑' WHEN value < first THEN '↓' ELSE '→' END AS trend, steps FROM b2)"""


STATS = f"WITH {OBS}, {CONFIG}, {stats_sql('obs')}"
LAST = f"{STATS}, last AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY source, series ORDER BY period DESC) = 1)"
YOY = """y AS (SELECT n.source, n.series, n.period, min(b.period) AS base_period, arg_min(b.value, b.period) AS base, any_value(n.value) AS now FROM obs n JOIN obs b
    ON n.source = b.source AND n.series = b.series AND b.period < n.period AND starts_with(b.period, (left(n.period, 4)::INT - 1)::VARCHAR || substr(n.period, 5)) GROUP BY ALL),
    lv AS (SELECT source, series, max(abs(value)) > 1500000 AS is_level FROM obs GROUP BY ALL),
    lr AS (SELECT y.source, y.series, y.period, (now - base) / base * 100 AS value, true AS is_level FROM y JOIN lv USING (source, series) WHERE is_level AND base <> 0
        UNION ALL SELECT source, series, period, value, false FROM obs JOIN lv USING (source, series) WHERE NOT is_level)"""
CHARTS = [("orders", "us", "orders", "1-URGENT"), ("orders", "cn", "orders", "2-HIGH"), ("orders", "jp", "orders", "5-LOW"), ("quantity", "us", "lineitem", "A"), ("quantity", "cn", "lineitem", "N"), ("absent", "us", "lineitem", "none")]
PAIRS = [("urgent_low", "orders", "1-URGENT", "orders", "5-LOW"), ("a_r", "lineitem", "A", "lineitem", "R"), ("missing", "lineitem", "A", "lineitem", "none")]
SINGLE = [
    ("up", "orders", "1-URGENT", "value", "gt", 1.0, None, False, "level", "above one"), ("down", "orders", "2-HIGH", "mom_pct", "lt", 0.0, None, False, "fall", None),
    ("same", "lineitem", "A", "value", "eq", -1.0, None, False, "equal", "never"), ("odd", "lineitem", "A", "value", "like", 1.0, None, False, "odd", "unknown op"),
    ("gone", "lineitem", "none", "value", "gt", 1.0, None, False, "gone", "absent series"),
]
RANGES = [
    ("in", "orders", "3-MEDIUM", "mom_pct", "range", -1000.0, 1000.0, False, "inside", "window"), ("out", "orders", "5-LOW", "mom_pct", "range", -0.001, 0.001, True, "outside", "window"),
    ("out2", "lineitem", "N", "mom_pct", "range", -1e6, 1e6, True, "outside", "never"), ("yoy", "lineitem", "R", "yoy_pct", "range", -100.0, 1e9, False, "change", "window"),
]
RULE = "rule_id string, source string, series string, field string, op string, lo double, hi double, invert boolean, flag string, note string"
CROSS = [
    ("gap", "orders", "1-URGENT", "value", "minus", "orders", "5-LOW", "value", "gt", -1e12, "gap", "urgent - low"), ("share", "lineitem", "A", "value", "ratio", "lineitem", "R", "value", "lt", 100.0, "share", None),
    ("none", "orders", "1-URGENT", "value", "minus", "lineitem", "none", "value", "gt", 0.0, "none", "absent"), ("stale", "lineitem", "N", "value", "ratio", "lineitem", "R", "value", "gt", 0.0, "stale", "not updated"),
]
CROSS_RULE = "rule_id string, a_source string, a_series string, a_field string, how string, b_source string, b_series string, b_field string, op string, threshold double, flag string, note string"


def sql_rows(rows: list[tuple]) -> str:
    show = lambda x: "NULL" if x is None else ("true" if x else "false") if isinstance(x, bool) else f"'{x}'" if isinstance(x, str) else f"{x!r}::DOUBLE"
    return ", ".join("(" + ", ".join(map(show, r)) + ")" for r in rows)


def names(schema: str) -> str:
    return ", ".join(x.split()[0] for x in schema.split(", "))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each series as CSV text, a line a row: a header, quoted dates, '.' for every fifth value, short and odd rows."""
    obs = observations(spark, sf_dir)
    n = F.substring("period", 6, 2).cast("int")
    line = F.when(n == 5, F.concat('period', F.lit(",."))).when(n == 7, F.col("period")).when(n == 9, F.concat("period", F.lit(",n/a"))).otherwise(F.concat(F.lit('"'), "period", F.lit('",'), F.col("value").cast("decimal(20,2)").cast("string")))
    body = obs.select("source", "series", F.expr("cast(substr(period, 1, 4) as int) * 12 + cast(substr(period, 6, 2) as int)").alias("pos"), line.alias("line"))
    return body.unionByName(obs.select("source", "series").distinct().selectExpr("source", "series", "0 as pos", "'DATE,VALUE' as line"))


def a1(spark, d):
    return series.parse_csv_rows(csv_lines(spark, d))


def batches(spark, d):
    obs = observations(spark, d)
    return obs.withColumn("seq", F.lit(1)), obs.where("period >= '1999-01'").select("source", "series", "period", (F.col("value") + 1).alias("value"), F.lit(2).alias("seq"))


def rules_of(spark, rows):
    return spark.createDataFrame(rows, RULE)


def stats(spark, d):
    return series.stats_summary(observations(spark, d))


def updates(spark, d):
    """Statistics of this batch's series: all but lineitem N and R."""
    return stats(spark, d).where("source = 'orders' or series = 'A'").join(config(spark, d), ["source", "series"])


def charts(spark):
    return spark.createDataFrame(CHARTS, "indicator string, economy string, source string, series string")


def levels(spark, d):
    return series.level_or_rate(observations(spark, d), 1_500_000)


def cache(spark, d):
    """Readings as of an earlier run: without 3-MEDIUM, and with older values."""
    return series.stats_summary(observations(spark, d).where("period < '2000-01'")).where("series <> '3-MEDIUM'")


QUERIES = {
    "a1_csv_series_scan": a1,
    "a2_keyed_upsert": lambda s, d: series.upsert(*batches(s, d)),
    "a3_bounded_history": lambda s, d: series.history(observations(s, d), 24),
    "a4_latest_observation": lambda s, d: series.latest(observations(s, d)),
    "d1_cadence": lambda s, d: series.with_stats(series.history(observations(s, d))).select("source", "series", "period", "quarterly"),
    "d2_safe_pct_change": lambda s, d: observations(s, d).select("source", "series", "period", series.pct_change(F.col("value"), F.when(F.substring("period", 6, 2) == "01", 0.0).otherwise(F.lit(1000.0))).alias("pct")),
    "d3_period_over_period": lambda s, d: series.with_stats(series.history(observations(s, d))).select("source", "series", "period", "prev", "mom_pct"),
    "d4_yoy_positional": lambda s, d: series.with_stats(series.history(observations(s, d))).select("source", "series", "period", "yoy_base_period", "yoy_pct"),
    "d5_trend": lambda s, d: series.with_stats(series.history(observations(s, d))).select("source", "series", "period", "trend"),
    "d6_stats_summary": stats,
    "d7_calendar_yoy": lambda s, d: series.calendar_yoy(observations(s, d)),
    "d8_level_or_rate": levels,
    "d9_cross_economy": lambda s, d: charts(s).join(levels(s, d), ["source", "series"]).groupBy("indicator", "economy").agg(F.max("period").alias("period"), F.max_by("value", "period").alias("value")),
    "d10_chart_feed": lambda s, d: series.chart_feed(observations(s, d), charts(s)),
    "d11_derived_spread": lambda s, d: series.derived_spread(series.latest(observations(s, d)), s.createDataFrame(PAIRS, "id string, a_source string, a_series string, b_source string, b_series string")),
    "e1_single_rules": lambda s, d: rules.single_rules(updates(s, d), rules_of(s, SINGLE)),
    "e2_range_rules": lambda s, d: rules.single_rules(stats(s, d), rules_of(s, RANGES)),
    "e3_cross_rules": lambda s, d: rules.cross_rules(stats(s, d), s.createDataFrame(CROSS, CROSS_RULE), stats(s, d)),
    "e4_cross_rules_fresh": lambda s, d: rules.cross_rules(stats(s, d), s.createDataFrame(CROSS, CROSS_RULE), updates(s, d)),
    "f1_readings_upsert": lambda s, d: readings.refresh(cache(s, d), stats(s, d).where("series in ('1-URGENT', 'A', '3-MEDIUM')")),
    "f2_gap_bootstrap": lambda s, d: readings.gaps(config(s, d), cache(s, d), stats(s, d)),
    "f3_latest_readings": lambda s, d: readings.report(stats(s, d).join(config(s, d), ["source", "series"])),
    "f4_update_brief": lambda s, d: readings.brief(updates(s, d), rules.single_rules(updates(s, d), rules_of(s, SINGLE + RANGES))),
    "f5_run_summary": lambda s, d: readings.run_summary(updates(s, d), rules.cross_rules(stats(s, d), s.createDataFrame(CROSS, CROSS_RULE), updates(s, d))),
}

FIELD = lambda c, p="": f"CASE {c} WHEN 'value' THEN {p}value WHEN 'prev' THEN {p}prev WHEN 'mom_pct' THEN {p}mom_pct WHEN 'yoy_pct' THEN {p}yoy_pct END"
UPDATED = "u AS (SELECT * FROM last JOIN config USING (source, series) WHERE source = 'orders' OR series = 'A')"


def single_sql(rows: list[tuple], of: str) -> str:
    return f"""r({names(RULE)}) AS (VALUES {sql_rows(rows)}),
    f AS (SELECT r.*, {FIELD('field', 'x.')} AS reading FROM r JOIN {of} x USING (source, series)),
    fired AS (SELECT rule_id, source, series, field, reading, printf('**%s** — %s（%s=%.2f）', flag, coalesce(note, ''), field, reading) AS text FROM f
        WHERE reading IS NOT NULL AND CASE op WHEN 'gt' THEN reading > lo WHEN 'lt' THEN reading < lo WHEN 'eq' THEN reading = lo WHEN 'range' THEN (reading BETWEEN lo AND hi) <> invert ELSE false END)"""


def cross_sql(fresh: str) -> str:
    return f"""r({names(CROSS_RULE)}) AS (VALUES {sql_rows(CROSS)}),
    f AS (SELECT r.*, {FIELD('a_field', 'a.')} AS va, {FIELD('b_field', 'b.')} AS vb FROM r JOIN last a ON a_source = a.source AND a_series = a.series JOIN last b ON b_source = b.source AND b_series = b.series
        WHERE EXISTS (FROM {fresh} x WHERE (x.source = a_source AND x.series = a_series) OR (x.source = b_source AND x.series = b_series))),
    g AS (SELECT *, CASE how WHEN 'minus' THEN va - vb WHEN 'ratio' THEN CASE WHEN vb <> 0 THEN va / vb END END AS computed FROM f),
    crossed AS (SELECT rule_id, va, vb, computed, printf('**%s** — %s（%s(%.1f) %s %s(%.1f) = %.1f）', flag, coalesce(note, ''), a_series, va, how, b_series, vb, computed) AS text FROM g
        WHERE CASE op WHEN 'gt' THEN computed > threshold WHEN 'lt' THEN computed < threshold ELSE false END)"""


CHARTS_SQL = f"c(indicator, economy, source, series) AS (VALUES {sql_rows(CHARTS)})"
SHOWN = "CASE WHEN value IS NOT NULL THEN CASE WHEN abs(value) >= 1000 THEN format('{:,}', round_even(value, 0)::BIGINT) ELSE printf('%.2f', value) END WHEN yoy_pct IS NOT NULL THEN printf('%.2f%% 同比', yoy_pct) ELSE '—' END"
CACHE = f"{stats_sql('(SELECT * FROM obs WHERE period < {q}2000-01{q})')}, cache AS (SELECT * FROM s WHERE series <> '3-MEDIUM' QUALIFY row_number() OVER (PARTITION BY source, series ORDER BY period DESC) = 1)".replace("{q}", "'")
NOW = "now AS (SELECT * FROM (WITH " + stats_sql("obs") + " SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY source, series ORDER BY period DESC) = 1))"

ORACLE = {
    "a1_csv_series_scan": f"""WITH {OBS} SELECT source, series, left(period, 4)::INT * 12 + substr(period, 6, 2)::INT AS pos, period, value::DECIMAL(20, 2)::DOUBLE AS value FROM obs
        WHERE substr(period, 6, 2)::INT NOT IN (5, 7, 9)""",
    "a2_keyed_upsert": f"WITH {OBS} SELECT source, series, period, CASE WHEN period >= '1999-01' THEN value + 1 ELSE value END AS value, CASE WHEN period >= '1999-01' THEN 2 ELSE 1 END AS seq FROM obs",
    "a3_bounded_history": f"WITH {OBS} SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY source, series ORDER BY period DESC) <= 24",
    "a4_latest_observation": f"WITH {OBS} SELECT source, series, max(period) AS period, arg_max(value, period) AS value FROM obs GROUP BY ALL",
    "d1_cadence": f"{STATS} SELECT source, series, period, quarterly FROM s",
    "d2_safe_pct_change": f"WITH {OBS} SELECT source, series, period, CASE WHEN substr(period, 6, 2) = '01' THEN NULL ELSE (value - 1000.0::DOUBLE) / 1000.0::DOUBLE * 100.0 END AS pct FROM obs",
    "d3_period_over_period": f"{STATS} SELECT source, series, period, prev, mom_pct FROM s",
    "d4_yoy_positional": f"{STATS} SELECT source, series, period, yoy_base_period, yoy_pct FROM s",
    "d5_trend": f"{STATS} SELECT source, series, period, trend FROM s",
    "d6_stats_summary": f"{LAST} SELECT * FROM last",
    "d7_calendar_yoy": f"WITH {OBS}, {YOY} SELECT source, series, period, base_period, (now - base) / base * 100 AS value FROM y WHERE base <> 0",
    "d8_level_or_rate": f"WITH {OBS}, {YOY} SELECT * FROM lr",
    "d9_cross_economy": f"WITH {OBS}, {YOY}, {CHARTS_SQL} SELECT indicator, economy, max(period) AS period, arg_max(value, period) AS value FROM c JOIN lr USING (source, series) GROUP BY ALL",
    "d10_chart_feed": f"WITH {OBS}, {YOY.replace('1500000', '100')}, {CHARTS_SQL} SELECT indicator, economy, source, series, period, value FROM c JOIN lr USING (source, series)",
    "d11_derived_spread": f"""WITH {OBS}, l AS (SELECT source, series, arg_max(value, period) AS value FROM obs GROUP BY ALL), p(id, a_source, a_series, b_source, b_series) AS (VALUES {sql_rows(PAIRS)})
        SELECT id, a_source || '.' || a_series || ' - ' || b_source || '.' || b_series AS formula, a.value AS a_value, b.value AS b_value, (a.value::DECIMAL(28, 10) - b.value::DECIMAL(28, 10))::DOUBLE AS value
        FROM p JOIN l a ON a_source = a.source AND a_series = a.series JOIN l b ON b_source = b.source AND b_series = b.series""",
    "e1_single_rules": f"{LAST}, {UPDATED}, {single_sql(SINGLE, 'u')} SELECT * FROM fired",
    "e2_range_rules": f"{LAST}, {single_sql(RANGES, 'last')} SELECT * FROM fired",
    "e3_cross_rules": f"{LAST}, {cross_sql('last')} SELECT * FROM crossed",
    "e4_cross_rules_fresh": f"{LAST}, {UPDATED}, {cross_sql('u')} SELECT * FROM crossed",
    "f1_readings_upsert": f"WITH {OBS}, {CACHE}, {NOW}, n AS (SELECT * FROM now WHERE series IN ('1-URGENT', 'A', '3-MEDIUM')) SELECT * FROM n UNION ALL SELECT * FROM cache ANTI JOIN n USING (source, series)",
    "f2_gap_bootstrap": f"WITH {OBS}, {CACHE}, {NOW} SELECT * FROM now ANTI JOIN cache USING (source, series)",
    "f3_latest_readings": f"""{LAST} SELECT row_number() OVER (ORDER BY CASE economy WHEN 'us' THEN 0 WHEN 'cn' THEN 1 ELSE 9 END, name, source, series) AS place, economy, name, {SHOWN} AS value_cell,
        CASE WHEN value IS NULL OR yoy_pct IS NULL THEN '—' ELSE printf('%.2f', yoy_pct) END AS yoy_cell, CASE WHEN mom_pct IS NULL THEN '—' ELSE printf('%.2f', mom_pct) END AS mom_cell, trend, period FROM last JOIN config USING (source, series)""",
    "f4_update_brief": f"""{LAST}, {UPDATED}, {single_sql(SINGLE + RANGES, 'u')}, t AS (SELECT source, count(DISTINCT text) AS n_flags, string_agg(DISTINCT text, chr(10) ORDER BY text) AS flags FROM fired GROUP BY 1),
        k AS (SELECT *, {SHOWN} AS shown, row_number() OVER (PARTITION BY source ORDER BY series) AS rn FROM u)
        SELECT k.source, count(*) AS updates, arg_min(economy, series) AS economy, coalesce(any_value(n_flags), 0) AS n_flags, coalesce(any_value(flags), '') AS flags,
            string_agg(name || '=' || shown, '; ' ORDER BY series) FILTER (rn <= 6) AS line FROM k LEFT JOIN t USING (source) GROUP BY k.source""",
    "f5_run_summary": f"""{LAST}, {UPDATED}, {cross_sql('u')} SELECT count(*) AS updates, count(DISTINCT source) AS sources,
        (SELECT string_agg(name, ', ' ORDER BY source, series) FROM (SELECT * FROM u ORDER BY source, series LIMIT 4)) AS names, (SELECT count(*) FROM crossed) AS cross_flags FROM u""",
}
