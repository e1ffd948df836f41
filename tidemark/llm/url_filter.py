"""URL filters: a sort-merge range join of urls with nested prefix rules [native].

A rule (host, path, verdict) fits its host and all subdomains where the url's
path starts with the rule's path. The canonical key of a rule is its host with
the labels reversed, a slash, then its path ("net.example//en/"), so that a rule is the
interval of keys that start with it and intervals nest or are disjoint. A url
has one key for each host suffix that may be a rule's host ("net//en/25" and
"net.example//en/25"), at most as many as the longest rule host has labels.

Rule starts, rule ends and url keys are range-partitioned on the key together
(ties split by a hash, so one hot host or url spreads out), written once, and
swept in order in each range: a start pushes, an end pops, and the running sum
of both is the depth of the stack. Slot d of the stack holds the last rule
pushed to depth d, which is a second running window over (range, depth). Rules
that are open where a range begins are pushed again at its head; as intervals
nest these are no more than the nesting depth.

Null or odd urls (no "://") have empty host and path and get the default
verdict. Rows are kept one for one, repeated rows too, and urls may be of any length. Keys are compared as bytes; a rule's
end is its key and a byte that UTF-8 never has, so it sorts after all that
starts with the key, whatever characters follow. Of rules with equal
host and path, block wins; of several rules that fit, the one with the longest
canonical key, then the longest host. An empty rule table gives the default
verdict everywhere. Rules with a null host or path are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import parts, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """pages with columns host and path; both empty for null urls and urls without "://"."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.locate("://", u) > 0, u.substr(F.locate("://", u) + 3, F.length(u))).otherwise("")
    return pages.withColumns({
        "host": F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER),
        "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    })


def url_filter(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow", rows_per_range: int = 500_000) -> DataFrame:
    """page_id, host, path, rule ("host" + "path" of the rule that decides, else null), verdict.

    rules: host string, path string, verdict string.
    """
    spark = pages.sparkSession
    labels = F.split("host", "\\.")
    level = lambda n: F.array_join(F.reverse(F.slice(labels, F.size(labels) - n + 1, n)), ".")
    rules = (
        rules.where("host is not null and path is not null")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("key", F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), "path"))
        .select("key", F.length("key").alias("len"), F.length("host").alias("host_len"), F.concat("host", "path").alias("rule"), "verdict")
    )
    rules = stage(rules, "url-rules")
    deepest = rules.agg(F.max(F.size(F.split(F.substring_index("key", "/", 1), "\\.")))).first()[0] or 1
    urls = (
        host_and_path(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")))
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "page_id", "host", "path", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size(labels), F.lit(deepest))))).alias("n"))
        .select("row", "page_id", "host", "path", F.concat(level(F.col("n")), F.lit("/"), "path").cast("binary").alias("key"), F.lit(2).alias("kind"), F.hash("row").alias("tie"))
    )
    rules = rules.withColumn("key", F.col("key").cast("binary"))
    ends = rules.select(F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(0).alias("kind"), *[c for c in rules.columns if c != "key"])
    starts = rules.withColumn("kind", F.lit(1))
    events = starts.unionByName(ends).withColumn("tie", F.lit(None).cast("int"))
    ranges = parts(spark, 2 * pages.count(), rows_per_range)
    dealt = (
        urls.unionByName(events, allowMissingColumns=True)
        .repartitionByRange(ranges, "key", "kind", "tie")
        .withColumn("range", F.spark_partition_id())
    )
    dealt = stage(dealt, "url-ranges")
    edges = dealt.where("kind < 2").groupBy("rule", "host_len").agg(
        F.max(F.when(F.col("kind") == 1, F.col("range"))).alias("first"), F.max(F.when(F.col("kind") == 0, F.col("range"))).alias("last"),
        *[F.max(c).alias(c) for c in ("len", "verdict")],
    )
    carried = (
        edges.where("last > first")
        .withColumn("range", F.explode(F.sequence(F.col("first") + 1, F.col("last")))).drop("first", "last")
        .withColumns({"key": F.lit("").cast("binary"), "kind": F.lit(1)})
    )
    order = [F.col("key"), F.col("kind"), F.when(F.col("kind") == 0, -F.col("len")).otherwise(F.col("len"))]
    sweep = W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    slot = W.partitionBy("range", "depth").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    pushed = F.when(F.col("kind") == 1, F.struct("len", "host_len", "rule", "verdict"))
    top = (
        dealt.unionByName(carried, allowMissingColumns=True)
        .withColumn("depth", F.sum(F.when(F.col("kind") == 1, 1).when(F.col("kind") == 0, -1).otherwise(0)).over(sweep))
        .withColumn("top", F.last(pushed, ignorenulls=True).over(slot))
        .where("kind = 2")
    )
    return (
        top.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), F.max("top").alias("top"))
        .select("page_id", "host", "path", F.col("top.rule").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict"))
    )
