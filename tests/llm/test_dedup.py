"""Exact, substring, suffix-array and near dedup against plain versions, with nulls, blanks, ties, repeats and empty tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import drop_copies, exact_dedup
from tidemark.llm.near_dedup import all_links, block_pairs, dart_minhash, in_full, keep_one, near_dedup, near_groups, rare_shingles
from tidemark.llm.exchange import KEY, Spread, member, settle
from tidemark.llm.substring_dedup import substring_dedup
from tidemark.llm.suffix_arrays import eights, found_in, kasai, suffix_array
from tidemark.llm.suffix_dedup import hot_anchors, repeated_windows, row_ids, stretches_of, suffix_dedup

from . import brute

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def rows():
    return brute.corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    # Extra columns with names that the operators use themselves.
    return spark.createDataFrame([(i, t, "x", 1, "k") for i, t in rows], SCHEMA + ", row string, kept int, bucket string").repartition(3)


def same(got, want):
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_exact_dedup(docs, rows):
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append((-len(t or ""), i is None, i or 0, i))
    want = [(i, min(groups[plain(t)])[3], len(groups[plain(t)]), hashlib.sha256(plain(t).encode()).hexdigest()) for i, t in rows]
    got = exact_dedup(docs, rows_per_run=8, fan_in=2, slices=4).collect()
    same([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], want)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    left = drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)


@pytest.mark.parametrize("most_partitions", [20_000, 3])
def test_substring_dedup(docs, rows, most_partitions):
    got = substring_dedup(docs, bytes_per_part=5_000, most_partitions=most_partitions).collect()
    same([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], brute.kept_words(rows))
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("shard_bytes", [4_000_000, 3_000])
def test_suffix_dedup(docs, rows, shard_bytes):
    got = suffix_dedup(docs, bytes_per_part=20_000, shard_bytes=shard_bytes).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], brute.kept_bytes(rows))
    assert all(hashlib.sha256(r.kept_bytes).hexdigest() == r.kept_sha256 for r in got)


def test_suffix_dedup_of_a_passage_that_all_documents_have(spark):
    """Hot anchors: no key has stretches that grow with the documents, and the answer is the same."""
    passage = brute.prose(777, 100)
    rows = [(i, f"{brute.prose(2 * i, 60)} {passage} {brute.prose(2 * i + 1, 60)}") for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    texts = docs.select(F.xxhash64("doc_id", "text").alias("doc"), F.col("doc_id").alias("tag"), "text")

    def most(hot):
        sizes = {}
        for c in stretches_of(texts, Spread.over(4), 200, 32, hot).where("not found").collect():
            for key, size in zip(np.frombuffer(c["keys"], np.uint64).tolist(), np.frombuffer(c["sizes"], np.int64).tolist(), strict=True):
                sizes[key] = sizes.get(key, 0) + size
        return max(sizes.values())

    hot = hot_anchors(texts, 200, 32, 20_000, 1)
    assert len(hot) and most(hot[:0]) > 80_000 and most(hot) < 20_000
    got = suffix_dedup(docs, hot_bytes=20_000, sample=1).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], brute.kept_bytes(rows))


def test_keys_with_equal_hashes_and_other_checks_are_other_keys():
    keys = np.array([(7, 1), (7, 2), (7, 2), (8, 1), (8, 1)], KEY)
    docs = np.array([1, 1, 2, 3, 3])
    first, later, _ = settle(docs, keys, True)
    assert first.tolist() == [0, 1, 3] and later.tolist() == [False, False, True, False, False]
    asked = np.array([(7, 2), (7, 3), (8, 1), (9, 1), (7, 1)], KEY)
    assert member(asked, keys[:3]).tolist() == [True, False, False, False, True]


def test_suffix_dedup_with_several_buckets_a_partition(docs, rows):
    got = suffix_dedup(docs, bytes_per_part=5_000, most_partitions=2).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], brute.kept_bytes(rows))


def test_rows_that_share_a_hash_get_other_numbers(docs, rows):
    """With 4 bits nearly all rows share a hash; still only equal rows have one number."""
    numbered = docs.select("doc_id", "text", row_ids(docs, "doc_id", "text", bits=4).alias("n")).collect()
    assert len({r.n for r in numbered}) == len(set(rows)) == len({(r.doc_id, r.text, r.n) for r in numbered})


def test_suffix_dedup_with_every_anchor_hot(docs, rows):
    got = suffix_dedup(docs, bytes_per_part=20_000, hot_bytes=1, sample=1).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], brute.kept_bytes(rows))


def test_suffix_array_and_prefixes():
    for text in (b"banana" * 30, b"abracadabra", bytes(random.Random(3).choices(b"ab", k=500)), b"x"):
        data = np.frombuffer(text, np.uint8)
        words = eights(data, 72)
        order = suffix_array(data)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        common = kasai(order, words, 64, lanes=7)
        for k in range(1, len(order)):
            a, b = text[order[k - 1] :], text[order[k] :]
            n = next((x for x, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
            assert common[k] == min(n, 64)
    a, b = np.frombuffer(b"....abcdefgh", np.uint8), np.frombuffer(b"abcdefgh12345678", np.uint8)
    assert found_in(eights(a, 16), np.array([4, 0]), eights(b, 16), suffix_array(b)[:1] * 0 + np.array([0]), 8).tolist() == [0, -1]


def test_windows_in_one_shard_or_several():
    r = random.Random(8)
    shared = bytes(r.choices(b"abcd", k=300))
    stretches = [bytes(r.choices(b"abcd", k=250)) for _ in range(6)] + [shared[:260], shared[40:]]
    counts = np.array([len(s) - 199 for s in stretches])
    one, many = (repeated_windows(stretches, counts, 200, size) for size in (10**6, 300))
    assert [x.tolist() for x in one] == [x.tolist() for x in many]
    assert one[6].tolist() == [k >= 40 for k in range(61)] and one[7].tolist() == [k < 21 for k in range(61)] and not any(x.any() for x in one[:6])


@pytest.mark.parametrize("rounds", [0, 3])
def test_near_dedup(docs, rows, rounds):
    got = near_dedup(docs, rounds=rounds).collect()
    want = brute.near_classes(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert all(r.class_id is None for r in got if r.doc_id is None)
    left = keep_one(docs, near_dedup(docs))
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {None, *want.values()}


def test_near_dedup_links_groups_whose_centres_are_apart(spark):
    """A chain of texts, each like the next but not like those further on: one group, whatever the centres."""
    base = brute.prose(1, 200).split()
    rows = []
    for k in range(12):
        rows.append((k * 7 % 12, " ".join(base)))
        base[4 + 15 * k] = f"new{k}"
        base[9 + 15 * k] = f"other{k}"
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute.near_classes(rows)
    assert {r.doc_id: r.class_id for r in near_dedup(docs, rounds=1).collect()} == want
    assert len(set(want.values())) < 12


def test_several_texts_under_one_id_in_any_row_order(spark):
    """Ids 1 to 3 are one group through the two texts of id 1, whichever comes first."""
    a, b = brute.prose(41, 80), brute.prose(42, 80)
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (4, brute.prose(43, 80)), (4, None)]
    assert brute.near_classes(rows) == {1: 1, 2: 1, 3: 1, 4: 4}
    for order in (rows, [rows[1], rows[0], *rows[2:]], rows[::-1]):
        got = near_dedup(spark.createDataFrame(order, SCHEMA).coalesce(1)).collect()
        assert len(got) == 6 and {(r.doc_id, r.class_id, r.class_size) for r in got} == {(1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 4, 1)}
        assert {(r.doc_id, r.links) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 0)}


@pytest.mark.parametrize("rounds", [0, 2])
def test_links_are_verified_and_span_their_classes_and_runs_agree(spark, docs, rows, rounds):
    found = near_groups(docs, rounds=rounds)
    texts = {}
    for r in found.texts.collect():
        texts.setdefault(r.text, []).append(r)
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(brute.shingles(t))
    links = found.links.collect()
    joined = {}
    for link in links:
        sims = [len(p & q) / len(p | q) for p in by_id[texts[link.a][0].doc_id] for q in by_id[texts[link.b][0].doc_id] if p | q]
        assert any(abs(s - link.similarity) < 1e-9 and s >= 0.8 for s in sims)
        joined.setdefault(link.a, set()).add(link.b)
        joined.setdefault(link.b, set()).add(link.a)
    for r in found.classes.collect():
        assert (r.links > 0) == (r.class_size > 1 and any(len(texts[t]) < r.class_size for t in texts if texts[t][0].class_id == r.class_id)) or r.doc_id in (7, None)
    assert sorted(map(tuple, found.classes.collect()), key=repr) == sorted(map(tuple, near_dedup(docs.repartition(5), rounds=rounds).collect()), key=repr)
    assert {(x.a, x.b) for x in links} and all(joined)


def test_rare_shingles_meet_every_similar_pair_and_no_shared_template(spark):
    r = random.Random(11)
    template = list(range(1000, 1060))
    sets = {i: template + list(range(10_000 + 100 * i, 10_000 + 100 * i + 40)) for i in range(30)}  # alike at 0.43
    sets |= {100 + i: [*range(20_000, 20_040), *(30_000 + 10 * i + k for k in range(5))] for i in range(4)}  # alike at 0.8
    sets |= {200: sets[3][:99] + [7], 201: sets[4][:60] + sets[5][60:]}
    table = spark.createDataFrame([(i, r.sample(k, len(k)), []) for i, k in sets.items()], "rep long, keys array<long>, counts array<int>")
    docs = spark.createDataFrame([(i, len(k)) for i, k in sets.items()], "doc long, n long")
    met = {}
    for x in rare_shingles(table, docs, 0.8, False).collect():
        met.setdefault(x.bucket, set()).add(x.doc)
    pairs = {(a, b) for of in met.values() for a in of for b in of if a < b}
    similar = {(a, b) for a in sets for b in sets if a < b and len({*sets[a]} & {*sets[b]}) >= 0.8 * len({*sets[a]} | {*sets[b]})}
    assert similar and similar <= pairs and len(pairs) < 12


def test_no_group_of_the_full_comparison_grows_with_its_bucket(spark):
    """A bucket of 600 documents apart and 300 of one group: all pairs across groups meet once, in groups of about 100 rows."""
    rows = [(1, i, 10, i) for i in range(600)] + [(1, 1000 + i, 10, 600) for i in range(300)]
    members = spark.createDataFrame(rows, "bucket long, doc long, n long, label long")
    for limits in ((50, 10**6), (10**6, 500)):
        groups, met = {}, {}
        for r in block_pairs(members, *limits).collect():
            groups.setdefault((r.x, r.y), []).append(r)
        for (x, y), held in groups.items():
            assert len(held) < 180
            for a in held:
                for b in held:
                    if a.block == x and (b.block != x or a.within and a.doc < b.doc):
                        pair = min(a.doc, b.doc), max(a.doc, b.doc)
                        met[pair] = met.get(pair, 0) + 1
        assert met == {(a[1], b[1]): 1 for a in rows for b in rows if a[1] < b[1] and a[3] != b[3]}


def test_full_comparison_over_several_blocks(spark):
    keys = {i: list(range(10 if i % 2 else 100 * i, (10 if i % 2 else 100 * i) + 10)) for i in range(40)}
    signed = spark.createDataFrame([(i, bytearray(8)) for i in keys], "rep long, sign binary")
    sets = spark.createDataFrame([(i, k, []) for i, k in keys.items()], "rep long, keys array<long>, counts array<int>")
    members = spark.createDataFrame([(5, i, 10, i) for i in keys], "bucket long, doc long, n long, label long")
    want = {(a, b) for a in keys for b in keys if a < b and a % 2 and b % 2}
    for size in (1000, 4):
        assert {(r.a, r.b) for r in in_full(members, signed, sets, 0.8, rows_per_block=size).collect()} == want
    labels = spark.createDataFrame([], "doc long, label long")
    for few in (100, 10, 0):  # by pairs, by rare shingles and pairs, by rare shingles and blocks
        got = all_links(members.withColumn("all", F.lit(len(keys)).cast("long")), labels, signed, sets, 0.8, False, few=few)
        assert {(r.a, r.b) for r in got.collect()} == want


def test_weighted_near_dedup(spark):
    rows = [(1, "a b c d e " * 30), (2, "a b c d e " * 31), (3, "a b c d e " * 3), (4, brute.prose(2, 50))]
    got = {r.doc_id: r.class_id for r in near_dedup(spark.createDataFrame(rows, SCHEMA), weights="count").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_dart_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(5)
    keys = r.integers(0, 2**63, 300).astype(np.uint64)
    a, b = r.integers(0, 6, 300).astype(float), r.integers(0, 6, 300).astype(float)
    b[:200] = a[:200]
    rows = np.repeat([0, 1], 300)
    both, w = np.r_[keys, keys], np.r_[a, b]
    on = w > 0
    s = dart_minhash(rows[on], both[on], w[on], 2, 2000)
    assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.05


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for df in (exact_dedup(none), drop_copies(none), substring_dedup(none), suffix_dedup(none), near_dedup(none)):
        assert df.count() == 0


def test_only_nulls(spark):
    nulls = spark.createDataFrame([(None, None), (None, None)], SCHEMA)
    assert exact_dedup(nulls).where("kept").count() == 1
    assert substring_dedup(nulls).count() == suffix_dedup(nulls).count() == near_dedup(nulls).count() == 2
