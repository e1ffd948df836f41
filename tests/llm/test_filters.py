"""URL filter, decontamination and mixing against plain versions."""

import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import contained, decontaminate
from tidemark.llm.queries import ORACLE, QUERIES
from tidemark.llm.mixing import apportion, apportion_within, drawn, mix
from tidemark.llm.url_filter import url_filter

from . import brute

RULE = "host string, path string, verdict string"


def judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


def test_url_filter_matches_plain_rules(spark):
    r = random.Random(4)
    labels, segments = ["a", "b", "net", "com"], ["x", "y", "xy"]
    host = lambda: ".".join(r.choice(labels) for _ in range(r.randint(1, 4)))
    path = lambda: "/" + "".join(r.choice(segments) + r.choice(["/", ""]) for _ in range(r.randint(0, 3)))
    rules = list({(h, p): (h, p, v) for h, p, v in ((host(), r.choice([path(), ""]), r.choice(["allow", "block"])) for _ in range(60))}.values())
    urls = [f"http://{host()}{path()}{r.choice(['', '?q=/a', '#z'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "http://", "HTTP://A.NET/x", "http://net?x", "http://net", "http://b.net:80/x"] + [urls[0]] * 5
    pages = spark.createDataFrame([(k, u, "w") for k, u in enumerate(urls)] + [(None, urls[1], "w"), (3, urls[3], "w")], "page_id long, url string, rule string")
    want = [(k, *judge(u, rules)) for k, u in enumerate(urls)] + [(None, *judge(urls[1], rules)), (3, *judge(urls[3], rules))]
    got = [tuple(x) for x in url_filter(pages, spark.createDataFrame(rules + [(None, "/", "block")], RULE), rows_per_range=40).collect()]
    key = lambda x: tuple((v is not None, v) for v in x)
    # Equally long rules of hosts of one length are the same rule; the verdict is then the same too.
    assert sorted(got, key=key) == sorted(want, key=key)


def test_url_filter_with_any_character_and_any_length(spark):
    """No code point sorts after a rule's end, and a url of a million characters is judged like any other."""
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow")]
    urls = ["http://a.example.net/en/\U0010ffffx", "http://x.net/\U0010ffffz", "http://\U0010ffff.net/en/", "http://example.net/en/" + "y" * 1_000_000, "http://x.org/\U0010ffff", "http://net/\x7f"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_filter(pages, spark.createDataFrame(rules, RULE)).collect()}
    assert got == {k: judge(u, rules) for k, u in enumerate(urls)}
    assert [got[k][3] for k in range(6)] == ["allow", "block", "block", "allow", "allow", "block"]


def test_url_filter_block_wins_between_equal_rules_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    rules = spark.createDataFrame([("a.b", "/c", "allow"), ("a.b", "/c", "block")], RULE)
    assert url_filter(pages, rules).first()["verdict"] == "block"
    assert url_filter(pages, spark.createDataFrame([], RULE)).first()["verdict"] == "allow"
    assert url_filter(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0


ITEMS = [(1, brute.prose(900, 20)), (2, brute.prose(901, 45)), (3, "too few words here"), (4, None), (None, brute.prose(902, 20)), (5, brute.prose(903, 9)), (1, brute.prose(900, 20)), (6, "Zebra"), (7, "two words"), (8, "?!"), (9, "one two three four")]


def test_contained_matches_plain_search(spark):
    docs = [(i, t) for i, t in brute.corpus() if i is not None and i != 7]
    near = brute.prose(901, 45).split()
    near[3] = "other"
    far = brute.prose(901, 45).split()
    far[3] = far[14] = far[25] = "other"
    docs += [(1000, brute.prose(1, 3000) + " " + brute.prose(900, 20).upper() + ", " + brute.prose(2, 50)), (1001, " ".join(near)), (1002, " ".join(far)), (1003, f"{ITEMS[1][1]} and {ITEMS[5][1]}")]
    docs += [(1004, "Here are too few, words HERE again"), (1005, "a zebra of two words"), (1006, "zebra"), (1007, "two. Words"), (1008, "two other words, one two four"), (1009, "one two three four")]
    docs += [(2000 + k, f"{brute.prose(k, 9)} {ITEMS[0][1]}") for k in range(30)]
    table = spark.createDataFrame([(i, t, "z") for i, t in docs] + [(None, ITEMS[0][1], "z")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.item_shingles, r.hits) for r in contained(table, items).collect()}
    want = brute.contaminated(docs, ITEMS)
    assert got == want and (1001, 2) in {(d, i) for d, i, *_ in want} and (1002, 2) not in {(d, i) for d, i, *_ in want}
    assert {(1004, 3), (1005, 6), (1005, 7), (1006, 6), (1007, 7), (1009, 9)} <= {(d, i) for d, i, *_ in want} and not [w for w in want if w[0] == 1008]
    # The shuffled joins, without any broadcast, find the same.
    assert {(r.doc_id, r.item_id) for r in contained(table, items, rows_to_broadcast=0).collect()} == {(d, i) for d, i, *_ in want}
    left = decontaminate(table, items)
    assert left.columns == table.columns and {r.doc_id for r in left.collect()} == {None, *(i for i, _ in docs)} - {d for d, *_ in want}


def test_contained_with_empty_tables(spark):
    docs, items = spark.createDataFrame(brute.corpus(), "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    none = lambda s: spark.createDataFrame([], s)
    assert contained(docs, none("item_id long, text string")).count() == contained(none("doc_id long, text string"), items).count() == 0


def highest_quotients(votes, seats):
    won = [0] * len(votes)
    for _ in range(seats):
        k = max(range(len(votes)), key=lambda k: (votes[k] / (2 * won[k] + 1), -k))
        won[k] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1003])
def test_apportion_gives_highest_quotients(spark, seats):
    r = random.Random(seats)
    votes = [r.choice([0.5, 1, 3, 50, 1000.25]) + k / 1000 for k in range(40)]
    parties = spark.createDataFrame([(k, v, "g", seats) for k, v in enumerate(votes)], "k int, votes double, g string, n int")
    want = dict(enumerate(highest_quotients(votes, seats)))
    assert {x.k: x.quota for x in apportion(parties, seats, ["k"]).collect()} == want
    assert {x.k: x.quota for x in apportion_within(parties, "g", "n", ["k"]).collect()} == want


def test_drawn_blocks(spark):
    """As many blocks as asked for, at equal steps, each word once; counted word by word."""
    cases = [(line, quota, start) for line in (1, 7, 40, 403) for quota in {0, 1, -(-line // 4) // 3, -(-line // 4)} for start in {0, (-(-line // 4)) // 2, -(-line // 4) - 1}]
    rows = [(c, w, *cases[c]) for c in range(len(cases)) for w in range(cases[c][0] + 1)]
    table = spark.createDataFrame(rows, "c int, w long, line long, quota long, start long")
    got = {(r.c, r.w): r.n for r in table.withColumn("n", drawn(F.col("w"), F.col("line"), F.col("quota"), F.col("start"), 4)).collect()}
    for c, (line, quota, start) in enumerate(cases):
        n = -(-line // 4)
        chosen = {j for j in range(n) if ((j + start) % n + 1) * quota // n > (j + start) % n * quota // n}
        assert len(chosen) == quota
        assert all(got[c, w] == sum(k // 4 in chosen for k in range(w)) for w in range(line + 1))


def water(sizes, weights):
    target, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while open_:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3.0 * sizes[s] for s in over)
        open_ -= over
    return target


def test_mix_meets_targets(spark):
    r = random.Random(6)
    rows = [(k, brute.prose(k, r.choice([1, 30, 200])), r.choice(["a", "a", "a", "B", "b", "c", None])) for k in range(300)]
    rows += [(1000, None, "a"), (1001, "", "only blank"), (1002, "one two", "tiny"), (None, "x y z", "a"), (5, rows[5][1], rows[5][2]), (1003, brute.prose(3, 20000), "long")]
    docs = spark.createDataFrame([(*x, 1.0) for x in rows], "doc_id long, text string, source string, target double")
    got = mix(docs, shard_words=500).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    want = water(sizes, weights)
    by_id = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for x in got:
        s = by_id[x.doc_id]
        assert x.source_size == sizes[s] and abs(x.target - want[s]) < 1e-6 and 0 <= x.taken <= 3 * x.size
        taken[s] += x.taken
    shards = {s: -(-n // 500) for s, n in sizes.items()}
    assert all(abs(taken[s] - want[s]) <= 4 * (1 + shards[s]) for s in sizes), (taken, want)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix(docs, shard_words=500).collect()), key=repr)


def test_mix_of_nothing(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    only = mix(spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")).collect()
    assert [(x.size, x.taken) for x in only] == [(0, 0), (0, 0)]


def test_short_items_against_sql(spark, tmp_path):
    docs = [(1, "a Zebra. of two words"), (2, "zebra"), (3, "two  words one two three four five six"), (4, None), (5, "one two three four"), (6, "nothing")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "zebra"), (2, "two words"), (3, "one two three four"), (4, "one two three four five six"), (5, "!"), (6, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = sorted(duck.execute(f"SELECT doc_id, item_id, hits FROM ({ORACLE['op1_decontaminate']})").fetchall())
    got = sorted((r.doc_id, r.item_id, r.hits) for r in QUERIES["op1_decontaminate"](spark, str(tmp_path)).collect())
    assert got == want == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (3, 3, 1), (3, 4, 2), (5, 3, 1)]
