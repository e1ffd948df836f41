"""Language ID and quality: held-out accuracy on the given tables, and odd inputs."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.language_id import dictionaries, held_out, identify, plain, recognised
from tidemark.llm.quality import Forest, fit, quality, statistics

DATA = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(DATA), reason="tables are not here")


@given
def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    test = held_out(2, 4)
    found = identify(docs.select("doc_id", "text", "lang"), dictionaries(docs.where(~test))).where(test).select("lang", "lang_pred").collect()
    assert len(found) > 200 and sum(r.lang == r.lang_pred for r in found) / len(found) > 0.96


def test_language_of_odd_texts(spark):
    train = spark.createDataFrame([(k, t, lang) for k in range(40) for t, lang in ((f"the quick fox {k} and the lazy dog went home again", "en"), (f"der schnelle fuchs {k} und der faule hund gingen heim", "de"))], "doc_id long, text string, lang string")
    dicts = dictionaries(train)
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "the lazy dog and the quick fox"), (5, "und der faule hund"), (6, "the lazy dog and the fox " * 20_000), (None, "der schnelle hund")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang_pred string, SCORE int")
    got = {r.doc_id: r for r in identify(docs, dicts).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 4, 5, 6, None)] == ["und", "und", "und", "en", "de", "en", "de"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[1].lang_rejected and not got[4].lang_rejected
    kept = recognised(docs, dicts)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {4, 5, 6, None}
    assert identify(docs.limit(0), dicts).count() == 0
    assert {r.lang_pred for r in identify(docs, dictionaries(train.limit(0))).collect()} == {"und"}


def test_letters_are_letters(spark):
    """Digits, fractions and circled numbers are no letters; scripts without case are."""
    train = spark.createDataFrame([(k, f"the quick fox {k} and the dog", "en") for k in range(40)], "doc_id long, text string, lang string")
    rows = list(enumerate(["²", "½ ①②", "١٢٣", "Ⅷ", "\u0301", "漢", "ª", "x²"]))
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string"), dictionaries(train)).collect()}
    assert [got[k].lang_pred for k, _ in rows] == ["und" if not any(c.isalpha() for c in t) else "en" for _, t in rows]
    assert got[0].lang_pred == got[1].lang_pred == "und" and got[5].lang_pred == got[7].lang_pred == "en"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in recognised(docs, {}).collect()} == {5, 6, 7}  # nothing learned: only texts without a letter go


def test_dictionaries_of_whole_texts(spark):
    rows = [(k, f"alpha beta{'x' * k} gamma.", "a") for k in range(20)] + [(100, "only long text " * 50, "b"), (101, None, "b"), (102, "no language", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    some = dictionaries(table, sample_docs=5, long_chars=100)
    assert sorted(some) == ["a", "b"] and len(some["a"].split(b"beta")) <= 6 and b"only long text" in some["b"]
    assert len(dictionaries(table, sample_chars=30)["a"].split(b"beta")) <= 3


def test_language_is_the_smallest_sum_of_compressed_blocks(spark):
    import zstandard

    langs = {x: [f"{x}ma {x}lo{k} {x}ti ba{k} ka" for k in range(60)] for x in ("ad", "be", "cu")}
    train = spark.createDataFrame([(k, t, x) for x, of in langs.items() for k, t in enumerate(of)], "doc_id long, text string, lang string")
    dicts = dictionaries(train)
    texts = ["adma belo bema cuti", "Adma! adlo7 -- " * 400, "cuma culo3 adma", "zz yy", "bema belo beti " * 900 + "adma", "ka ka"]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), dicts).collect()}
    for k, text in enumerate(texts):
        raw, sizes = plain(text).encode(), {}
        for lang, d in dicts.items():
            coder = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False)
            sizes[lang] = sum(len(coder.compress(raw[i : i + 2048])) for i in range(0, len(raw), 2048))
        order = sorted(sizes, key=lambda x: (sizes[x], x))
        gap = (sizes[order[1]] - sizes[order[0]]) / sizes[order[1]]
        assert got[k].lang_pred == order[0] and abs(got[k].lang_margin - gap) < 1e-9 and got[k].lang_rejected == (gap < 0.001)


@given
def test_quality_on_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    test = held_out(1, 3)
    got = quality(docs, labels.where(~test).select("doc_id", F.col("quality").alias("label"))).join(labels, "doc_id").where(test).collect()
    assert len(got) > 80 and sum(r.predicted == r.quality for r in got) / len(got) > 0.95


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (2, "", 0.1), (3, "word " * 100_000, 0.1), (None, "x", 0.1), (3, "twice", 0.1)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (2, 1), (3, 1)], "doc_id long, label int")
    got = quality(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in quality(docs, labels.limit(0)).collect()} == {1}
    assert quality(docs.limit(0), labels).count() == 0


def test_statistics_do_not_depend_on_neighbours():
    texts = ["", "A b! c\nA b! c\n", "été ñ 12 | 34", "z" * 50]
    raws = [t.encode() for t in texts]
    whole = statistics(np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)]))
    for k, raw in enumerate(raws):
        assert np.allclose(whole[k], statistics(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])


def test_forest_learns_and_array_traversal_matches_stepping():
    r = np.random.default_rng(1)
    x = r.normal(size=(2000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = fit(x[:1500], y[:1500])
    p = forest.score(x[1500:])
    assert ((p >= 0.5) == y[1500:]).mean() > 0.95

    def step(f: Forest, row):
        b, total = f.binned(row[None])[0], f.base
        for s, t, leaf in zip(f.statistic, f.threshold, f.leaf):
            node = 0
            while node < len(s):
                node = 2 * node + 1 + int(b[s[node]] > t[node])
            total += leaf[node - len(s)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([step(forest, v) for v in x[1500:1520]], p[:20])


def plain_trees(x, y, trees, depth, rate, bins, l2, least):
    """Boosted trees in plain loops: lists of (statistic, bin) by node, leaves, and the scores of x."""
    import math

    n = len(y)
    edges = np.quantile(x, np.arange(1, bins) / bins, axis=0).T
    b = [[sum(e < v for e in edges[s]) for s, v in enumerate(row)] for row in x.tolist()]
    share = (sum(y) + 0.5) / (n + 1)
    total, made = [math.log(share / (1 - share))] * n, []
    for _ in range(trees):
        p = [1 / (1 + math.exp(-t)) for t in total]
        g, h = [a - c for a, c in zip(p, y)], [a * (1 - a) for a in p]
        cuts, at = {}, [0] * n
        for level in range(depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                mine = [i for i in range(n) if at[i] == node]
                best = (1e-6, None)
                for s in range(len(edges)):
                    for c in range(bins - 1):
                        left = [i for i in mine if b[i][s] <= c]
                        if len(left) < least or len(mine) - len(left) < least:
                            continue
                        score = lambda of: sum(g[i] for i in of) ** 2 / (sum(h[i] for i in of) + l2)
                        gain = score(left) + score([i for i in mine if b[i][s] > c]) - score(mine)
                        if gain > best[0] + 1e-12:
                            best = (gain, (s, c))
                cuts[node] = best[1]
            at = [2 * a + 1 + int(cuts[a] is not None and b[i][cuts[a][0]] > cuts[a][1]) for i, a in enumerate(at)]
        leaves = {}
        for node in set(at):
            of = [i for i in range(n) if at[i] == node]
            leaves[node] = -rate * sum(g[i] for i in of) / (sum(h[i] for i in of) + l2)
        total = [t + leaves[a] for t, a in zip(total, at)]
        made.append(cuts)
    return made, [1 / (1 + math.exp(-t)) for t in total]


def test_forest_is_that_of_plain_loops():
    r = np.random.default_rng(3)
    x = r.normal(size=(60, 3))
    y = ((x[:, 0] + 0.3 * r.normal(size=60) > 0) ^ (x[:, 2] > 1)).astype(float)
    settings = {"trees": 3, "depth": 2, "rate": 0.3, "bins": 8, "l2": 1.0, "least": 4}
    forest = fit(x, y, **settings)
    cuts, scores = plain_trees(x, y.tolist(), **settings)
    assert np.allclose(forest.score(x), scores)
    for t, of in enumerate(cuts):
        assert {k: (forest.statistic[t, k], forest.threshold[t, k]) for k, c in of.items() if c} == {k: c for k, c in of.items() if c}


def test_quality_learns_from_no_more_than_the_sample_of_repeated_rows(spark, monkeypatch):
    from tidemark.llm import quality as module

    seen = []
    monkeypatch.setattr(module, "fit", lambda x, y: seen.append(y.tolist()) or fit(x, y))
    docs = spark.createDataFrame([(k % 5, f"text {k} " * (k % 7)) for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k % 5, k % 2) for k in range(20)] + [(77, 1)], "doc_id long, label int")
    for sample in (7, 50, 10_000):
        for order in (docs, docs.repartition(3)):
            assert quality(order, labels, sample=sample).count() == 60
    assert [len(s) for s in seen] == [7, 7, 50, 50, 240, 240] and all(seen[k] == seen[k + 1] for k in (0, 2, 4))
