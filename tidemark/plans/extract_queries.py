"""Queries A5-A9 and B1-B18: releases rendered from orders (one an order), documents and pages."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import DataFrame, functions as F

from ..operators import extract as ex, pages as pg, statements as st
from ..sources.tables import spread_out, table
from .series_queries import sql_rows

SOURCES = ["cn_mof", "cn_stats_inv", "cn_stats_cpi", "cn_stats_ppi", "cn_stats_pmi", "cn_pbc", "jp_ppi", "jp_cpi", "jp_unrate", "jp_policy", "jp_gdp", "de_cpi", "de_ppi", "de_unrate", "de_gdp"]
YEAR_NOW = 2021


#: Title and text of each source's releases; {..} are filled from the order.
TEMPLATES = [
    ("cn_mof", "{y}年{span}", "全国一般公共预算收入{amount}亿元{tail}全国一般公共预算支出{amount}亿元{tail}国有土地使用权出让收入{amount}亿元{tail}"),
    ("cn_stats_inv", "{y}年{span}", "全国固定资产投资（不含农户）{amount}亿元{tail}其中，基础设施投资同比{cn}；民间固定资产投资同比{cn}"),
    ("cn_stats_cpi", "{y}年{span}", "全国居民消费价格同比{cn}"), ("cn_stats_ppi", "{y}年{span}", "工业生产者出厂价格同比{cn}"), ("cn_stats_pmi", "{y}年{span}", "制造业采购经理指数（PMI）为{plus50}%，"),
    ("cn_pbc", "{y}年{span}", "广义货币(M2)余额{amount}万亿元{tail}狭义货币(M1)余额{amount}万亿元{tail}社会融资规模存量为{amount}万亿元{tail}"),
    ("jp_ppi", "Release for {month}, {y}", "The Producer Price Index {en} from the previous month"), ("jp_cpi", "Release for {month}, {y}", "The Consumer Price Index {en}; the core CPI {en}"),
    ("jp_unrate", "Release for {month}, {y}", "The unemployment rate was {bare}%"), ("jp_policy", "Release for {month}, {y}", "the uncollateralized overnight call rate to remain at around {size} percent"),
    ("jp_gdp", "Estimates of GDP for {months} {y}", "国 内 総 生 産 （ Ｇ Ｄ Ｐ ） 0.1 0.2 0.3 0.4 0.5 (9.9) {unicode}\nother 1 2 3\n国 内 総 生 産 （ Ｇ Ｄ Ｐ ） 1.1 1.2 1.3 1.4 {bare}\n"),
    ("de_cpi", "Release for {month}, {y}", "Inflation rate at {plus}%\n{plus}% on the previous month"), ("de_ppi", "Release for {month}, {y}", "Wholesale prices: {plus}% on a year earlier\n{plus}% on the previous month"),
    ("de_unrate", "Release for {month}, {y}", "{size}% {than} than in the same month a year earlier"), ("de_gdp", "GDP, {ordinal} quarter of {y}", "{plus}% on the previous quarter\n{plus}% on the same quarter a year earlier"),
]


def releases(spark, d) -> DataFrame:
    """A release an order: level and percent from the order, in the words of one of 15 sources; and all documents, in which nothing is found.

    Orders of status P and priority 5-LOW have no year, those of P and 4-NOT SPECIFIED no metric.
    """
    pct, m, y = F.col("pct"), F.col("m"), F.col("y")
    # Reading a release takes its time, and the orders of a small table are one task.
    orders = spread_out(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice"), "o_orderkey")
    o = orders.select(
        F.col("o_orderkey").alias("release_id"), F.element_at(F.array(*map(F.lit, SOURCES)), (F.col("o_orderkey") % 15 + 1).cast("int")).alias("source"), F.format_number("o_totalprice", 2).alias("amount"),
        ((F.col("o_custkey") % 199 - 99) / 10.0).alias("pct"), (F.year("o_orderdate") + 20).cast("string").alias("y"), F.month("o_orderdate").alias("m"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
    )
    o = o.withColumns({"size": F.format_string("%.1f", F.abs(pct)), "plus": F.format_string("%+.1f", pct), "q": F.ceil(m / 3).cast("int"), "yymm": F.concat(F.substring(y, 3, 2), ex.two(m))})
    o = o.withColumns({
        "cn": F.concat(F.when(pct < 0, "下降").otherwise("增长"), "size", F.lit("%")), "en": F.concat(F.when(pct < 0, "Fell ").otherwise("rose "), "size", F.lit(" percent")), "bare": F.format_string("%.1f", pct), "plus50": F.format_string("%.1f", pct + 50),
        "unicode": F.regexp_replace("plus", "^-", "−"), "than": F.when(pct < 0, "lower").otherwise("higher"), "month": F.element_at(F.array(*[F.lit(x.capitalize()) for x in ex.MONTHS]), m),
        "months": F.element_at(F.array(*map(F.lit, ("Jan.-Mar.", "April - June", "Jul.–Sep.", "Oct.-Dec."))), F.col("q")), "ordinal": F.element_at(F.array(*map(F.lit, ("1st", "2nd", "3rd", "4th"))), F.col("q")),
        "span": F.when(m <= 2, F.concat(m, F.lit("月份"))).when(m == 3, "一季度").when(m == 6, "上半年").when(m == 9, "前三季度").when(m == 12, "全年").otherwise(F.concat(F.lit("1—"), m, F.lit("月"))),
    }).withColumn("tail", F.when(F.col("status") == "O", "。").otherwise(F.concat(F.lit("，同比"), "cn", F.lit("。"))))
    o = o.join(F.broadcast(spark.createDataFrame(TEMPLATES, "source string, title string, text string")), "source")

    def filled(c: str, *names: str):
        out = F.col(c)
        for name in names:
            out = F.replace(out, F.lit("{" + name + "}"), F.col(name))
        return out

    nothing, dateless = (F.col("status") == "P") & (F.col("priority") == "4-NOT SPECIFIED"), (F.col("status") == "P") & (F.col("priority") == "5-LOW")
    url = F.when(F.col("source") == "jp_ppi", F.concat(F.lit("/a/cgpi"), "yymm", F.lit(".pdf"))).when(F.col("source") == "jp_policy", F.concat(F.lit("/a/k"), "yymm", F.lit("31a.pdf")))
    made = o.select(
        "release_id", "source", F.when(dateless, "no date").otherwise(filled("title", "span", "months", "ordinal", "month", "y")).alias("title"),
        F.when(nothing, "nothing here").otherwise(filled("text", "amount", "tail", "cn", "plus50", "en", "bare", "size", "unicode", "plus", "than")).alias("text"), F.when(~dateless, url).alias("url"),
    )
    # Every third release of the Chinese sources writes its digits full width.
    wide = F.col("source").startswith("cn_") & (F.col("release_id") % 3 == 0)
    made = made.withColumn("text", F.when(wide, F.translate("text", "0123456789", "０１２３４５６７８９")).otherwise(F.col("text")))
    plain = table(spark, d, "documents").select((-1 - F.col("doc_id")).alias("release_id"), F.lit("cn_mof").alias("source"), F.lit("2020年全年").alias("title"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("url"))
    return made.unionByName(plain)


REL = f"""o AS (SELECT o_orderkey AS release_id, ([{', '.join(f"'{s}'" for s in SOURCES)}])[o_orderkey % 15 + 1] AS source, round(o_totalprice, 2) AS level, ((o_custkey % 199 - 99) / 10.0)::DOUBLE AS pct, year(o_orderdate) + 20 AS y, month(o_orderdate) AS m,
        o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' AS nothing, o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AS dateless, o_orderstatus = 'O' AS plain FROM orders),
    per AS (SELECT *, CASE WHEN NOT dateless THEN y || '-' || CASE WHEN source IN ('jp_gdp', 'de_gdp') THEN 'q' || quarter(make_date(2000, m, 1)) ELSE lpad(m::VARCHAR, 2, '0') END END AS period FROM o),
    rule(source, metric_key, kind, label, unit) AS (VALUES {sql_rows(ex.RULES)}),
    met AS (SELECT release_id, source, metric_key, kind, CASE WHEN kind = 'table_0' THEN '% QoQ annualized' ELSE unit END AS unit, dateless, period,
        CASE WHEN kind = 'level_cn' THEN level WHEN metric_key = 'pmi_mfg' THEN round(pct + 50, 1) WHEN metric_key = 'unrate' THEN pct WHEN metric_key = 'policy_rate' THEN abs(pct) END AS value,
        CASE WHEN kind IN ('value_cn', 'value_en') OR (kind = 'level_cn' AND plain AND metric_key <> 'inv_total') THEN NULL ELSE pct END AS yoy,
        CASE WHEN yoy IS NOT NULL THEN CASE WHEN ends_with(metric_key, '_mom') THEN 'mom' WHEN ends_with(metric_key, '_qoq') THEN 'qoq' ELSE 'yoy' END END AS basis
        FROM per JOIN rule USING (source) WHERE NOT nothing AND metric_key NOT IN ('mof_central_exp', 'mof_local_exp', 'mof_govfund_rev', 'mof_govfund_exp'))"""
BODY = "WITH " + REL


def found(spark, d):
    return ex.extract(releases(spark, d))


def of_kind(*kinds):
    return lambda s, d: found(s, d).where(F.col("kind").isin(*kinds)).select("release_id", "metric_key", "value", "yoy", "basis")


def kind_sql(*kinds):
    return f"{BODY} SELECT release_id, metric_key, value, yoy, basis FROM met WHERE kind IN ({', '.join(repr(k) for k in kinds)})"


def periods(*prefixes):
    cond = " or ".join(f"source like '{p}%'" for p in prefixes)
    return lambda s, d: ex.with_period(releases(s, d).where(cond)).select("release_id", "period")


def period_sql(cond):
    return f"{BODY} SELECT release_id, period FROM per WHERE {cond}"


def linked(spark, d):
    """Pages as listings: each links the next page and another one, some a list of year folders."""
    p, k = table(spark, d, "pages"), F.col("page_id")
    html = F.concat(
        F.coalesce("html", F.lit("")), F.lit('<a href="/p/'), k + 1, F.lit('">Next</a><a href="/p/'), k * 2, F.lit('">More</a><a href="state_all/">All</a>'),
        F.when(F.length("url") % 5 != 0, F.concat(F.lit('<a href="state_20'), F.length("url") % 7 + 15, F.lit('/">older</a><a href="state_20'), F.length("url") % 4 + 18, F.lit('/">newer</a>'))).otherwise(""),
    )
    return p.select("page_id", F.concat(F.lit("https://site.example/p/"), k).alias("url"), html.alias("html"))


#: Anchors put before a page's own, by page_id % 12; the last one's link is none that discovery follows.
FORMS = [
    "",
    "<A class=\"x\"\n HREF='../next/./a.html?b=1#c'><b> deux &eacute;</b> <i>mots</i></A>",
    "<a href=/root&amp;2>un &#8217; &#x2026;</a>",
    "<!-- <a href=\"/no\">commented</a> --><a title='>' href=\"?page=2\">p&aacute;gina</a>",
    "<a name=\"only\">no link</a><a href=\"//other.example/x\">elsewhere</a>",
    "<a href=\"/blank\"> <img src=\"i.png\"> </a><a href=\"sub/file.pdf\">file</a>",
    "<a title=\"see href=foo.html\" data-href='no.html' href=\"bar.html\">quoted</a>",
    "<div><a href=\"/open\">left open</div><p>not its text</p>",
    "<a href=one.html>unclosed<a href=two.html>two</a>",
    "<script>var a = '<a href=\"/no\">scripted</a>';</script><a href = \"first.html\" href=\"second.html\">twice</a>",
    "<a href=\"x.html?a=1&copy=2&notit;\">a < b &amp; c</a >",
    "<a href=\"mailto:nobody@site.example\">write to us</a>",
]
#: What they say: title and link by page_id % 12, {b} being the page's folder.
SAID = [
    ("deux émots", "https://site.example/a/next/a.html?b=1#c"), ("un ’ …", "https://site.example/root&2"), ("página", "{b}list.html?page=2"),
    ("elsewhere", "https://other.example/x"), ("file", "{b}sub/file.pdf"), ("quoted", "{b}bar.html"), ("left open", "https://site.example/open"),
    ("unclosed", "{b}one.html"), ("twice", "{b}first.html"), ("a < b & c", "{b}x.html?a=1©=2¬it;"),
]


def listed(spark, d):
    p = table(spark, d, "pages")
    front = F.element_at(F.array(*map(F.lit, FORMS)), (F.col("page_id") % len(FORMS) + 1).cast("int"))
    url = F.concat(F.lit("https://site.example/a/b"), F.col("page_id"), F.lit("/list.html?q#f"))
    return p.select("page_id", F.when(F.col("page_id") % len(FORMS) == 0, F.col("url")).otherwise(url).alias("url"), F.concat(front, F.coalesce("html", F.lit(""))).alias("html"))


def dated_urls(spark, d):
    k, n = F.col("page_id"), F.length("url")
    part = F.when(n % 6 == 0, F.concat(F.lit("/2019/"), ex.two(n % 14 + 1), F.lit("/x.html"))).when(n % 6 == 1, F.concat(F.lit("/2020"), ex.two(n % 14 + 1), F.lit("/y.PDF"))).when(n % 6 == 2, F.concat(F.lit("/k21"), ex.two(n % 14 + 1), F.lit("31a.pdf?v=1"))).when(n % 6 == 3, "/2018/").when(n % 6 == 4, "/2010/05/").otherwise("/none")
    return table(spark, d, "pages").select(k, F.concat(F.coalesce("url", F.lit("")), part).alias("u"))


def dated_sql(*patterns: tuple[str, int]) -> str:
    """The first pattern (year, month) that stands in u with a plausible month and year, else the last day of a year alone."""
    part = lambda p, k: f"try_cast(regexp_extract(u, '{p}', {k}) AS INT)"
    full = [f"CASE WHEN {part(p, 2)} BETWEEN 1 AND 12 AND {part(p, 1)} + {base} BETWEEN {YEAR_NOW - 5} AND {YEAR_NOW + 1} THEN make_date({part(p, 1)} + {base}, {part(p, 2)}, 1) END" for p, base in patterns]
    return f"coalesce({', '.join(full)}, make_date({part('/(20[0-9]{2})/', 1)}, 12, 31))"


DATED = f"""n AS (SELECT page_id, coalesce(url, '') AS url, length(url) AS n, lpad((length(url) % 14 + 1)::VARCHAR, 2, '0') AS mo FROM pages),
    u AS (SELECT page_id, url || CASE n % 6 WHEN 0 THEN '/2019/' || mo || '/x.html' WHEN 1 THEN '/2020' || mo || '/y.PDF' WHEN 2 THEN '/k21' || mo || '31a.pdf?v=1' WHEN 3 THEN '/2018/' WHEN 4 THEN '/2010/05/' ELSE '/none' END AS u FROM n),
    dt AS (SELECT page_id, {dated_sql(("/(20[0-9]{2})/([0-9]{2})/", 0), ("/(20[0-9]{2})([0-9]{2})/", 0), ("/(?:k|release_|release-|cgpi|mpr_)([0-9]{2})([0-9]{2})", 2000))} AS day,
        CASE WHEN ends_with(lower(regexp_extract(u, '^[^?#]*', 0)), '.pdf') THEN 'pdf' ELSE 'html' END AS kind FROM u)"""


def a8(spark, d):
    return dated_urls(spark, d).select("page_id", pg.release_date(F.col("u"), YEAR_NOW).alias("day"), pg.release_kind(F.col("u")).alias("kind"))


def split_digits(spark, d):
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select("doc_id", F.sha2(ex.rejoin_digits(F.concat(F.lit("12 ,3 45. 6 "), t, F.lit(" 7 8\n9"))), 256).alias("sha256"))


def b14(spark, d):
    good, _ = ex.parsed(releases(spark, d))
    return good.select("release_id", "source", "metric_key", "unit", "period", "value", "yoy", "basis")


#: Character references of all forms, markup that is odd or left open, and what it all says.
ODD_HTML = (
    "<p>&copy;&nbsp;&#8217;&hellip;&#x41;&NotEqualTilde; &#150; &unknown; &amp;lt; &#0; 1 <> 2 &amp &notit; &copyright a&ltb &#1;x</p>"
    "<i title='<b>' data-x=\"1>0\">in</i><script>no <b>no</script ><style>p {}</style><!-- no --> end <b class='open"
)
ODD_TEXT = "© ’…A≂̸ – &unknown; &lt; � 1 <> 2 & ¬it; ©right a<b x in end"


QUERIES = {
    "a5_anchor_discovery": lambda s, d: pg.discover(pg.anchors(listed(s, d)), "^[a-zà-ÿ]", None, "^https?://"),
    "a6_chained_discovery": lambda s, d: pg.chained(linked(s, d), pg.anchors(linked(s, d)), [("^Next$", "^/p/"), ("^More$", None)]),
    "a7_newest_year_folder": lambda s, d: pg.newest_year(linked(s, d), pg.anchors(linked(s, d)), "^state"),
    "a8_release_date_kind": a8,
    "a9_staleness": lambda s, d: a8(s, d).select("page_id", pg.stale(F.col("day"), F.lit("2021-02-01").cast("date")).alias("is_stale")),
    "b1_html_to_text": lambda s, d: table(s, d, "pages").select("page_id", pg.html_to_text(F.concat("html", F.lit(ODD_HTML))).alias("text")),
    "b2_split_digit_rejoin": split_digits,
    "b3_lenient_number": lambda s, d: table(s, d, "orders").select("o_orderkey", st.number(F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.concat(F.lit(" "), F.format_number("o_totalprice", 2), F.lit(" ")))).alias("value")),
    "b4_signed_percent": lambda s, d: table(s, d, "orders").select("o_orderkey", st.signed(F.round(F.col("o_totalprice") / 1000, 1), F.when(F.col("o_orderstatus") == "P", "Fell").when(F.col("o_orderstatus") == "O", "rose"), st.EN_NEGATIVE).alias("pct")),
    "b5_level_and_change": of_kind("level_cn"),
    "b6_percent_only": of_kind("pct_cn", "pct_en"),
    "b7_value_at_label": of_kind("value_cn", "value_en"),
    "b8_percent_before_label": of_kind("before", "than"),
    "b9_period_chinese": periods("cn_"),
    "b10_period_english": periods("jp_cpi", "jp_unrate", "jp_gdp"),
    "b11_period_title": periods("de_"),
    "b12_period_url_first": periods("jp_ppi", "jp_policy"),
    "b13_table_row": of_kind("table_0", "table_1"),
    "b14_release_parser": b14,
    "b15_parse_failures": lambda s, d: ex.parsed(releases(s, d))[1],
    "b16_completeness_gate": lambda s, d: ex.incomplete(found(s, d), ex.rule_table(s).select("source", "metric_key")),
    "b17_value_fallback": lambda s, d: found(s, d).select("release_id", "metric_key", F.coalesce("value", "yoy").alias("value")),
    "b18_series_keys": lambda s, d: ex.observations_of(found(s, d)),
}

sql_text = lambda x: "'" + x.replace("'", "''") + "'"
WINDOWS = ", ".join(sql_text(bytes([k]).decode("cp1252", "ignore") or chr(k)) for k in range(0x80, 0xA0))
#: A page's text without markup, then each piece after a & by itself: a numeric reference, a name with a semicolon, else the longest name that needs none.
TEXT_SQL = rf"""names(name, said) AS (VALUES {', '.join(f"({sql_text(name)}, {sql_text(said)})" for name, said in html5.items())}),
    bare AS (SELECT page_id, string_split(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&') AS pieces FROM pages WHERE html IS NOT NULL),
    piece AS (SELECT page_id, unnest(pieces) AS x, unnest(range(0, len(pieces))) AS i FROM bare),
    token AS (SELECT *, CASE WHEN i > 0 THEN regexp_extract(x, '^(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?', 0) ELSE '' END AS t FROM piece),
    digit AS (SELECT *, left(ltrim(regexp_extract(t, '^#[xX]?([0-9a-fA-F]+)', 1), '0'), 9) AS d, regexp_extract(t, '^(?:{'|'.join(pg.OPEN_NAMES)})', 0) AS open FROM token),
    point AS (SELECT *, CASE WHEN d = '' THEN 0 WHEN t[2] IN ('x', 'X') THEN ('0x' || d)::BIGINT ELSE d::BIGINT END AS n FROM (SELECT *, starts_with(t, '#') AS numeric FROM digit) WHERE numeric),
    char AS (SELECT page_id, i, CASE WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR (n % 65536 >= 65534 AND n <= 1114111) THEN ''
        WHEN n BETWEEN 128 AND 159 THEN ([{WINDOWS}])[n - 127] WHEN n BETWEEN 1 AND 1114111 AND n NOT BETWEEN 55296 AND 57343 THEN chr(n::INT) ELSE chr(65533) END AS c FROM point),
    decoded AS (SELECT page_id, string_agg(CASE WHEN i = 0 THEN x WHEN c IS NOT NULL THEN c || substr(x, len(t) + 1) WHEN whole.said IS NOT NULL THEN whole.said || substr(x, len(t) + 1)
        WHEN start.said IS NOT NULL THEN start.said || substr(x, len(open) + 1) ELSE '&' || x END, '' ORDER BY i) AS said
        FROM digit LEFT JOIN char USING (page_id, i) LEFT JOIN names whole ON whole.name = t AND ends_with(t, ';') LEFT JOIN names start ON start.name = open AND open <> '' GROUP BY page_id)"""
JOINED = "'12 ,3 45. 6 ' || coalesce(text, '') || ' 7 8' || chr(10) || '9'"
for _ in range(3):
    JOINED = rf"regexp_replace({JOINED}, '([0-9.,])[ \t\r\n]+([0-9.,])', '\1\2', 'g')"

ORACLE = {
    "a5_anchor_discovery": r"""WITH l AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS site, regexp_extract_all(html, '<a\s+href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS hs, regexp_extract_all(html, '<a\s+href="([^"]*)"[^>]*>([^<]*)</a>', 2) AS ts FROM pages WHERE page_id % 12 = 0),
        x AS (SELECT page_id, site, unnest(hs) AS href, trim(unnest(ts)) AS title, unnest(range(0, len(hs))) AS pos FROM l),
        f AS (SELECT page_id, arg_min(title, pos) AS title, arg_min(CASE WHEN starts_with(href, '/') THEN site || href ELSE href END, pos) AS link FROM x WHERE regexp_matches(title, '^[a-zà-ÿ]') GROUP BY 1)
        SELECT * FROM f WHERE regexp_matches(link, '^https?://')
        UNION ALL SELECT page_id, said[1], replace(said[2], '{b}', 'https://site.example/a/b' || page_id || '/')
        FROM (SELECT page_id, (SAID)[page_id % 12] AS said FROM pages WHERE page_id % 12 BETWEEN 1 AND 10)""".replace(
        "SAID", "[" + ", ".join(f"['{t}', '{link}']" for t, link in SAID) + "]"),
    "a6_chained_discovery": "SELECT p.page_id AS start_id, CASE WHEN q.page_id IS NOT NULL THEN 'https://site.example/p/' || (q.page_id * 2) END AS link FROM pages p LEFT JOIN pages q ON q.page_id = p.page_id + 1",
    "a7_newest_year_folder": """SELECT page_id, CASE WHEN length(url) % 5 <> 0 THEN 2000 + greatest(length(url) % 7 + 15, length(url) % 4 + 18) END::INT AS year, CASE WHEN length(url) % 5 <> 0 THEN 'https://site.example/p/state_20' || greatest(length(url) % 7 + 15, length(url) % 4 + 18) || '/' END AS link,
        CASE WHEN length(url) % 5 = 0 THEN 'no_year_folder' END AS error_class FROM pages""",
    "a8_release_date_kind": f"WITH {DATED} SELECT page_id, day, kind FROM dt",
    "a9_staleness": f"WITH {DATED} SELECT page_id, coalesce(DATE '2021-02-01' - day > 60, false) AS is_stale FROM dt",
    "b1_html_to_text": rf"WITH {TEXT_SQL} SELECT page_id, trim(coalesce(nullif(trim(regexp_replace(replace(said, chr(160), ' '), '[ \t\r\n]+', ' ', 'g')), '') || ' ', '') || '{ODD_TEXT}') AS text FROM decoded UNION ALL SELECT page_id, NULL FROM pages WHERE html IS NULL",
    "b2_split_digit_rejoin": f"SELECT doc_id, sha256({JOINED}) AS sha256 FROM documents",
    "b3_lenient_number": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN round(o_totalprice, 2) END AS value FROM orders",
    "b4_signed_percent": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN -round(o_totalprice / 1000, 1) ELSE round(o_totalprice / 1000, 1) END AS pct FROM orders",
    "b5_level_and_change": kind_sql("level_cn"),
    "b6_percent_only": kind_sql("pct_cn", "pct_en"),
    "b7_value_at_label": kind_sql("value_cn", "value_en"),
    "b8_percent_before_label": kind_sql("before", "than"),
    "b9_period_chinese": period_sql("starts_with(source, 'cn_')") + " UNION ALL SELECT -1 - doc_id, '2020-12' FROM documents",
    "b10_period_english": period_sql("source IN ('jp_cpi', 'jp_unrate', 'jp_gdp')"),
    "b11_period_title": period_sql("starts_with(source, 'de_')"),
    "b12_period_url_first": period_sql("source IN ('jp_ppi', 'jp_policy')"),
    "b13_table_row": kind_sql("table_0", "table_1"),
    "b14_release_parser": f"{BODY} SELECT release_id, source, metric_key, unit, period, value, yoy, basis FROM met WHERE NOT dateless",
    "b15_parse_failures": f"{BODY} SELECT release_id, source, CASE WHEN dateless THEN 'no_period' ELSE 'no_metrics' END AS error_class FROM per WHERE dateless OR nothing UNION ALL SELECT -1 - doc_id, 'cn_mof', 'no_metrics' FROM documents",
    "b16_completeness_gate": f"{BODY} SELECT release_id, source, 'mof_central_exp,mof_govfund_exp,mof_govfund_rev,mof_local_exp' AS missing FROM per WHERE source = 'cn_mof' AND NOT nothing",
    "b17_value_fallback": f"{BODY} SELECT release_id, metric_key, coalesce(value, yoy) AS value FROM met",
    "b18_series_keys": f"{BODY} SELECT release_id, source, metric_key AS series, value FROM met WHERE value IS NOT NULL UNION ALL SELECT release_id, source, CASE WHEN ends_with(metric_key, '_yoy') THEN metric_key ELSE metric_key || '_yoy' END, yoy FROM met WHERE yoy IS NOT NULL",
}
