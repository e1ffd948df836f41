"""Web pages: cut into tokens, then text, anchors and releases out of them.

A page is cut once, by one pattern, into an array of tokens (markup and text, in
order). Attributes are read at attribute boundaries only, so what looks like one
inside a quoted value is none. All of it is column expressions over one row a page.

Cases: a null page has null text and no anchors; a page without markup is one text
token; markup that is not closed ends with the page; a `<` that starts no markup is
text.
"""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

# One attribute: a name, then perhaps a value in quotes or bare. A value whose quote is never closed ends with the page.
_ATTRIBUTE = r"""[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s>"'][^\s>]*+))?+"""
_ATTRIBUTES = rf"""(?:[\s/=]++|{_ATTRIBUTE})*+"""
_COMMENT, _DECLARATION, _END = r"<!--(?:.*?-->|.*+)", r"<[!?][^>]*+>?+", r"</[^>]*+>?+"
_UNSHOWN = rf"<(script|style)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
_START = rf"<[a-z](?:[^\s/>])*+{_ATTRIBUTES}(?:>|\z)"
MARKUP = f"(?is)(?:{_COMMENT}|{_UNSHOWN}|{_DECLARATION}|{_END}|{_START})"
TOKEN = f"(?is)(?:{_COMMENT}|{_UNSHOWN}|{_DECLARATION}|{_END}|{_START}|[^<]++|<)"

#: Elements whose end tag closes an anchor that was opened inside them.
BLOCKS = (
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "div", "dl", "dt", "fieldset", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "header", "html", "li", "main", "nav", "ol", "p", "section", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
)
#: All characters that count as blank at the ends of a text.
BLANK = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))

#: Names that are references without a semicolon too, so that any longer word may start with them: longest first.
OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))


def _table(names: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps({name: html5[name] for name in names})), "map<string,string>")


def _code_point(digits: Column, base: int) -> Column:
    """The character of a code point written to a base.

    As HTML asks, C1 controls are those of Windows-1252, zero, surrogates and what lies beyond is U+FFFD,
    and other controls and noncharacters are nothing.
    """
    n = F.conv(F.substring(F.ltrim(digits, F.lit("0")), 1, 9), base, 10).try_cast("long")
    windows = F.create_map(*[F.lit(x) for k in range(0x80, 0xA0) for x in (k, bytes([k]).decode("cp1252", "ignore") or chr(k))])
    ok = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    control = n.between(0x1, 0x8) | (n == 0xB) | n.between(0xE, 0x1F) | (n == 0x7F)
    none = control | n.between(0xFDD0, 0xFDEF) | ((n % 0x10000 >= 0xFFFE) & (n <= 0x10FFFF))
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(ok, n)), 8, "0")), "UTF-32")
    return F.when(none, "").otherwise(F.coalesce(F.try_element_at(windows, n.cast("int")), char, F.lit("\ufffd")))


def unescape(text: Column) -> Column:
    """Text with character references decoded: numeric ones, names with a semicolon, and else the longest name that needs none."""
    closed, open_ = _table([name for name in html5 if name.endswith(";")]), _table(OPEN_NAMES)

    def piece(x: Column, i: Column) -> Column:
        token = F.regexp_extract(x, "^(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?", 0)
        bare = F.rtrim(token, F.lit(";"))
        whole = (
            F.when(bare.rlike("^#[xX]"), _code_point(F.substring(bare, 3, 1 << 30), 16))
            .when(bare.startswith("#"), _code_point(F.substring(bare, 2, 1 << 30), 10))
            .when(token.endswith(";"), F.try_element_at(closed, token))
        )
        start = F.regexp_extract(token, f"^(?:{'|'.join(OPEN_NAMES)})", 0)
        rest = lambda of: x.substr(F.length(of) + 1, F.length(x))
        return (
            F.when((i == 0) | (token == ""), F.when(i == 0, x).otherwise(F.concat(F.lit("&"), x)))
            .when(whole.isNotNull(), F.concat(whole, rest(token)))
            .when(start != "", F.concat(F.try_element_at(open_, start), rest(start)))
            .otherwise(F.concat(F.lit("&"), x))
        )

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Text of a page: no script or style bodies, no comments, one space for each tag, character references decoded."""
    out = F.regexp_replace(html, MARKUP, " ")
    return F.trim(F.regexp_replace(F.translate(unescape(out), "\xa0", " "), "[ \\t\\r\\n]+", " "))


def tokens(html: Column) -> Column:
    """Array of (kind, name, text) in order: kind is start, end, text or other; text is the attributes of a start tag, or the text."""

    def cut(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"^</?([A-Za-z][^\s/>]*)", 1))
        unshown = name.isin("script", "style") & ~t.startswith("</")
        kind = (
            F.when(~t.startswith("<") | (t == "<"), "text").when((name == "") | unshown, "other")
            .when(t.startswith("</"), "end").otherwise("start")
        )
        body = F.when(kind == "start", F.rtrim(t.substr(F.length(name) + 2, F.length(t)), F.lit(">"))).when(kind == "text", t)
        return F.struct(kind.alias("kind"), name.alias("name"), body.alias("text"))

    return F.transform(F.regexp_extract_all(html, F.lit(TOKEN), 0), cut)


def attribute(attributes: Column, name: str) -> Column:
    """The value of the first attribute of that name in a start tag's attributes, references decoded; empty without a value, null without it."""
    other = rf"(?!{re.escape(name)}(?:[\s/=]|$)){_ATTRIBUTE}"
    found = rf"(?is)^(?:[\s/=]++|{other})*+({re.escape(name)})(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\z)|'([^']*+)(?:'|\z)|([^\s>\"'][^\s>]*+)))?+"
    values = [F.regexp_extract(attributes, found, k) for k in (2, 3, 4)]
    return F.when(F.regexp_extract(attributes, found, 1) != "", unescape(F.concat(*values)))


def _title(inside: Column) -> Column:
    """The text nodes of an anchor, from the tokens after its start tag: up to its end tag, or that of an element around it."""
    start = F.struct(F.lit(True).alias("open"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("node"), F.array().cast("array<string>").alias("nodes"))

    def fold(s: Column, t: Column) -> Column:
        block = t["name"].isin(*BLOCKS)
        depth = s["depth"] + F.when(block & (t["kind"] == "start"), 1).when(block & (t["kind"] == "end"), -1).otherwise(0)
        closed = (depth < 0) | ((t["kind"] == "end") & (t["name"] == "a"))
        is_text = t["kind"] == "text"
        nodes = F.when(is_text | s["node"].isNull(), s["nodes"]).otherwise(F.concat(s["nodes"], F.array(s["node"])))
        node = F.when(is_text, F.concat(F.coalesce(s["node"], F.lit("")), t["text"]))
        after = F.struct((~closed).alias("open"), depth.alias("depth"), node.alias("node"), nodes.alias("nodes"))
        return F.when(s["open"], after).otherwise(s)

    nodes = F.aggregate(inside, start, fold, lambda s: F.when(s["node"].isNull(), s["nodes"]).otherwise(F.concat(s["nodes"], F.array(s["node"]))))
    return F.array_join(F.transform(nodes, lambda x: F.trim(unescape(x), F.lit(BLANK))), "")


def url_join(base: Column, ref: Column) -> Column:
    """The absolute url of a reference on the page `base` (RFC 3986, section 5.2); dots are taken out of paths."""
    scheme, site = F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*:", 0), F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    path = F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, "^.*/", 0), F.lit("")), F.lit("/"))
    own = F.regexp_extract(ref, "^[^?#]*", 0)
    full = F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    steps = F.slice(F.split(full, "/"), 2, 1 << 30)
    none = F.array().cast("array<string>")

    def walk(done: Column, x: Column) -> Column:
        back = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(none)
        return F.when(x == "..", back).when(x == ".", done).otherwise(F.concat(done, F.array(x)))

    walked = F.aggregate(steps, none, walk)
    last = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    tail = ref.substr(F.length(own) + 1, F.length(ref))
    return (
        F.when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), ref).when(ref.startswith("//"), F.concat(scheme, ref)).when(ref == "", base)
        .when(ref.startswith("#"), F.concat(F.regexp_extract(base, "^[^#]*", 0), ref))
        .when(ref.startswith("?"), F.concat(F.regexp_extract(base, "^[^?#]*", 0), ref))
        .otherwise(F.concat(site, F.lit("/"), F.array_join(last, "/"), tail))
    )


def anchors(pages: DataFrame, url: str = "url", html: str = "html", base: Column | None = None) -> DataFrame:
    """(page_id, pos, href, title, link): anchors with href and text in document order.

    An anchor ends at its end tag, at the next anchor, at the end tag of an element
    around it, or with the page. The title is the text inside, each text node trimmed;
    character references are decoded in both. Links are resolved against the page's
    url, or `base`.
    """
    cut = pages.select("page_id", F.coalesce(base if base is not None else F.col(url), F.lit("")).alias("base"), tokens(F.col(html)).alias("t"))
    places = F.filter(F.sequence(F.lit(1), F.size("t")), lambda i: (F.element_at("t", i)["kind"] == "start") & (F.element_at("t", i)["name"] == "a"))
    cut = cut.where(F.exists("t", lambda t: (t["kind"] == "start") & (t["name"] == "a"))).withColumn("at", places)

    def anchor(i: Column, k: Column) -> Column:
        until = F.coalesce(F.get("at", k + 1), F.size("t") + 1)
        return F.struct(F.element_at("t", i)["text"].alias("attributes"), F.slice("t", i + 1, until - i - 1).alias("inside"))

    rows = cut.select("page_id", "base", F.posexplode(F.transform("at", anchor)).alias("pos", "a"))
    rows = rows.select("page_id", "base", "pos", attribute(F.col("a.attributes"), "href").alias("href"), F.col("a.inside").alias("inside")).where("href is not null")
    rows = rows.select("page_id", "pos", "base", F.trim(F.col("href"), F.lit(BLANK)).alias("href"), _title(F.col("inside")).alias("title")).where("title <> ''")
    return rows.select("page_id", "pos", "href", "title", url_join(F.col("base"), F.col("href")).alias("link"))


def discover(links: DataFrame, title: str, href: str | None = None, follow: str | None = None) -> DataFrame:
    """The first anchor of each page with matching title and href; nothing for the page where that one's link does not match `follow`."""
    rows = links.where(F.col("title").rlike(title))
    rows = rows.where(F.col("href").rlike(href)) if href else rows
    first = rows.groupBy("page_id").agg(F.min_by(F.struct("title", "link"), "pos").alias("a")).select("page_id", "a.title", "a.link")
    return first.where(F.col("link").rlike(follow)) if follow else first


def chained(pages: DataFrame, links: DataFrame, hops: list[tuple[str, str | None]]) -> DataFrame:
    """(start_id, link): where a fixed list of hops (title, href patterns) leads from each page; null if a hop is missing."""
    at = pages.select(F.col("page_id").alias("start_id"), "page_id")
    for k, (title, href) in enumerate(hops):
        step = discover(links, title, href).select("page_id", "link")
        at = at.join(step, "page_id", "left").select("start_id", "link")
        if k < len(hops) - 1:
            at = at.join(pages.select("page_id", F.col("url").alias("link")), "link", "left").select("start_id", "page_id")
    return at


def newest_year(pages: DataFrame, links: DataFrame, href: str | None = None) -> DataFrame:
    """(page_id, year, link) of the newest state_20YY folder that a page links; without one, error_class says so."""
    rows = links.where(F.col("href").rlike(href)) if href else links
    rows = rows.withColumn("year", F.regexp_extract("href", "(?i)state[_-](20[0-9]{2})", 1).try_cast("int")).where("year is not null")
    best = rows.groupBy("page_id").agg(F.max("year").alias("year"), F.max_by("link", F.struct("year", (-F.col("pos")).alias("p"))).alias("link"))
    return pages.select("page_id").join(best, "page_id", "left").withColumn("error_class", F.when(F.col("year").isNull(), "no_year_folder"))


def release_date(url: Column, year_now: int) -> Column:
    """Date in a release url by the first pattern that matches with a plausible month and year; a year alone is its last day."""
    full = lambda p, base: F.when(url.rlike(p), F.struct((F.regexp_extract(url, p, 1).cast("int") + base).alias("y"), F.regexp_extract(url, p, 2).cast("int").alias("m")))
    ok = lambda s: F.when(s["m"].between(1, 12) & s["y"].between(year_now - 5, year_now + 1), F.make_date(s["y"], s["m"], F.lit(1)))
    dated = [ok(full(p, b)) for p, b in (("/(20[0-9]{2})/([0-9]{2})/", 0), ("/(20[0-9]{2})([0-9]{2})/", 0), ("/(?:k|release_|release-|cgpi|mpr_)([0-9]{2})([0-9]{2})", 2000))]
    only = F.when(url.rlike("/(20[0-9]{2})/"), F.make_date(F.regexp_extract(url, "/(20[0-9]{2})/", 1).cast("int"), F.lit(12), F.lit(31)))
    return F.coalesce(*dated, only)


def release_kind(url: Column) -> Column:
    return F.when(F.lower(F.regexp_extract(url, "^[^?#]*", 0)).endswith(".pdf"), "pdf").otherwise("html")


def stale(day: Column, as_of: Column, days: int = 60) -> Column:
    """Older than `days`; a warning only, false for no date."""
    return F.coalesce(F.datediff(as_of, day) > days, F.lit(False))
