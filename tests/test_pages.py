"""Pages by tokens, character references against Python's table, and statements with full-width digits."""

import html
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import extract, pages, statements


def of(spark, rows, expression):
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, t string")
    return [r[1] for r in sorted(df.select("k", expression(F.col("t")).alias("v")).collect())]


def test_references_are_those_of_python(spark):
    r = random.Random(5)
    parts = ["&", ";", "#", "x", "not", "notin", "it", "copy", "right", "lt", "amp", "AMP", "eacute", "thetasym", "1", "0", "41", "128", "x80", "X1F600", "d800", "9999999999", " ", "<", "é", "\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 12))) for _ in range(1500)]
    texts += [f"&#{k}; &#x{k:x}" for k in [*range(160), 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFDEF, 0xFFFE, 0xFFFF, 0x1FFFE, 0x10FFFF, 0x110000]]
    texts += ["&notit;", "&copyright", "a&ltb", "&amp;lt;", "&", "&&", "&#", "&#x", "&#;", "&unknown;", ""]
    assert of(spark, texts, pages.unescape) == [html.unescape(t) for t in texts]


ANCHORS = [
    ('<a title="see href=foo.html" href="bar.html">x</a>', [("bar.html", "x")]),
    ("<a data-href='no' href=yes>x</a>", [("yes", "x")]), ("<a href>x</a>", [("", "x")]), ("<a name=q>x</a>", []), ("<a href='1' HREF='2'>x</a>", [("1", "x")]),
    ("<a href=1>one<a href=2>two</a>", [("1", "one"), ("2", "two")]), ("<div><a href=1>in</div>out", [("1", "in")]), ("<a href=1>to the end", [("1", "to the end")]),
    ("<a href=1><div>in</div> and</a> out", [("1", "inand")]), ("<a href='a>b'>x > y</a>", [("a>b", "x > y")]), ("<a href=1>a < b</a>", [("1", "a < b")]),
    ("<a href=1> <b> a </b> c <!-- d --> e </a>", [("1", "ace")]), ("<script>'<a href=1>x</a>'</script><a href=2>y</a>", [("2", "y")]), ("<a href=1>　x </a>", [("1", "x")]),
    ("<a href=1 >x</a foo><a href=2/>y", [("1", "x"), ("2/", "y")]), ('<a href="1>x</a>', []), ("<abbr href=1>x</abbr>", []), ("<a", []), ("", []), (None, []),
    ("<a href=1><img alt='</a>'>x</a>", [("1", "x")]), ("<a\nhref\n=\n'1'\n>x</A>", [("1", "x")]), ("<a href=1>x<script>no</script></a>", [("1", "x")]),
]


def test_anchors_as_a_parser_reads_them(spark):
    table = spark.createDataFrame([(k, "https://site.example/", t) for k, (t, _) in enumerate(ANCHORS)], "page_id long, url string, html string")
    got = {}
    for r in pages.anchors(table).orderBy("page_id", "pos").collect():
        got.setdefault(r.page_id, []).append((r.href, r.title))
    for k, (t, want) in enumerate(ANCHORS):
        assert got.get(k, []) == want, t


def test_tokens(spark):
    got = of(spark, ["<p class='a>b'>x &lt; 1<br/> y</p >< z", "<!-- open <b>", "plain", None], pages.tokens)
    kinds = [[(t["kind"], t["name"]) for t in x] if x else x for x in got]
    assert kinds == [[("start", "p"), ("text", ""), ("start", "br"), ("text", ""), ("end", "p"), ("text", ""), ("text", "")], [("other", "")], [("text", "")], None]


def test_text_of_odd_pages(spark):
    rows = ["a<b title='>'>c</b>d", "x<script>1 < 2</script>y", "x<style>p{}</STYLE >y", "a <!-- b --> c", "1 < 2 and 3 > 2", "a<br", "<!doctype html>t", "<p>" * 3000 + "deep" + "</p>" * 3000, "<a " + "x='1' " * 5000 + ">long</a>", None]
    assert of(spark, rows, pages.html_to_text) == ["a c d", "x y", "x y", "a c", "1 < 2 and 3 > 2", "a", "t", "deep", "long", None]


RELEASE = "release_id long, source string, title string, text string, url string"


@pytest.mark.parametrize(("source", "text", "key", "value", "yoy", "basis"), [
    ("cn_stats_pmi", "制造业采购经理指数为４９.２%", "pmi_mfg", 49.2, None, None), ("cn_mof", "全国一般公共预算收入１１５,３９６亿元，同比下降０.３%", "mof_revenue", 115396.0, -0.3, "yoy"),
    ("cn_mof", "全国一般公共预算收入情况。全国一般公共预算收入为20亿元，其中税收", "mof_revenue", 20.0, None, None),
    ("cn_mof", "全国一般公共预算收入5亿元。" + "。" * 60 + "全国一般公共预算收入7亿元，增长 1.5 %", "mof_revenue", 7.0, 1.5, "yoy"),
    ("cn_mof", "全国一般公共预算收入5亿元" + "。" * 41 + "1.5%", "mof_revenue", 5.0, None, None), ("cn_mof", "全国一般公共预算收入5亿元" + "。" * 40 + "增长1.5%", "mof_revenue", 5.0, 1.5, "yoy"),
    ("cn_stats_cpi", "全国居民消费价格2024年同比 下降 0.5%", "cpi_yoy", None, -0.5, "yoy"), ("jp_ppi", "producer price index, 2015 base, edged down 0.1 percentage points", "cgpi_mom", None, -0.1, "mom"),
    ("jp_cpi", "the Consumer Price Index year-on-year rose 2.4% YoY", "cpi_yoy", None, 2.4, "yoy"), ("jp_unrate", "The Unemployment Rate (adjusted) stood at 2.5 %", "unrate", 2.5, None, None),
    ("jp_unrate", "unemployment rate 2.5%", "unrate", None, None, None), ("de_cpi", "+0.3 %  on the previous month", "cpi_mom", None, 0.3, "mom"), ("de_unrate", "1.5 % Higher than\nin May", "employment_yoy", None, 1.5, "yoy"),
    ("de_gdp", "-0.2% on the previous quarter", "gdp_qoq", None, -0.2, "qoq"),
])
def test_statements(spark, source, text, key, value, yoy, basis):
    got = extract.extract(spark.createDataFrame([(1, source, "t", text, None)], RELEASE)).where(F.col("metric_key") == key).first()
    assert (got and (got.value, got.yoy, got.basis)) == (None if value is None and yoy is None else (value, yoy, basis))


def test_full_width_numbers_and_periods(spark):
    assert of(spark, ["１,２３４.５", "n/a", None, " 7 "], statements.number) == [1234.5, None, None, 7.0]
    got = extract.with_period(spark.createDataFrame([(1, "cn_mof", "２０２５年１—７月", "", None)], RELEASE)).first()
    assert got["period"] == "2025-07"
