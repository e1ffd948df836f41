"""Toxicity, collocations and spelling variants: plain versions, held-out accuracy and odd inputs."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given as cases, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import collocations as col, queries, quotient_filter as qf, spelling as sp
from tidemark.llm.language_id import held_out
from tidemark.llm.lexicon import Lexicon, allowed
from tidemark.llm.toxicity import Context, hits, measures, toxicity

DATA = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(DATA), reason="tables are not here")


def against_sql(spark, name, folder):
    df = queries.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet{'/*.parquet' if os.path.isdir(f'{folder}/documents.parquet') else ''}'")
    answer = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    want = Counter(tuple(r[names.index(c)] for c in columns) for r in answer.fetchall())
    assert got == want
    return got


@given
@pytest.mark.parametrize("name", ["op12_collocations", "op13_spelling_variants"])
def test_queries_against_sql(spark, name):
    assert against_sql(spark, name, DATA)


ODD_ROWS = [
    (1, "The Big-Cat sat. the big-cat\tsat, THE BIG-CAT SAT! ", "en"), (2, None, "en"), (3, "", None), (4, "  \n .,;", None), (5, "Über ÀÉÿß straße straßen", None),
    (6, "one two three " * 30, "und"), (7, "one two three four. " * 30, None), (7, "one two three four. " * 30, None), (8, "x" * 3000 + " " + "y z " * 40, "en"), (None, "alpha alphb alpha alpha alphb alphb", "en"),
    (9, "naïve naive naïve naive naïve naive naives naives naives navies navies navies", "en"), (10, "a\x00b a\x00b " * 12, "en"), (11, "a\rb\vc\fd " * 15, "de"),
]


def test_odd_rows_against_sql(spark, tmp_path):
    spark.createDataFrame([(*r, 1) for r in ODD_ROWS], "doc_id long, text string, lang string, n int").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("op12_collocations", "op13_spelling_variants"):
        against_sql(spark, name, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert sp.variants(docs.limit(0)).count() == 0 and col.collocations(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@cases(st.lists(st.tuples(st.integers(0, 2**31 - 1), st.integers(0, 2**31 - 1), st.integers(0, 2**31 - 1), st.integers(1, 10**12)), max_size=60), st.sampled_from([7, 16, 21, 22, 31]), st.integers(2, 3))
def test_filter_is_lossless(rows, b, n):
    mask = (1 << b) - 1
    want = Counter()
    for i, j, k, c in rows:
        want[(i & mask, j & mask, k & mask)[:n]] += c
    width = (n - 1) * b
    ids = np.array([[i & mask, j & mask, k & mask][:n] for i, j, k, _ in rows], np.uint64).reshape(-1, n)
    rest = ids[:, 1] if n == 2 else (ids[:, 1] << np.uint64(b)) | ids[:, 2]
    high, low = qf.permuted(ids[:, 0], rest, b, width)
    one = qf.merged([qf.Counts(high, low, np.array([r[3] for r in rows], np.int64))], b, width)
    back = qf.unpacked(qf.packed(one, b, width), b, width)
    for x, y in zip(one, back, strict=True):
        assert (x == y).all()
    halves = [qf.Counts(*(x[s] for x in one)) for s in (slice(0, None, 2), slice(1, None, 2))]
    again = qf.merged(halves, b, width)
    first, rest = qf.restored(again.high, again.low, b, width)
    keys = zip(first.tolist(), rest.tolist()) if n == 2 else zip(first.tolist(), (rest >> np.uint64(b)).tolist(), (rest & np.uint64(mask)).tolist())
    assert dict(zip(keys, again.count.tolist(), strict=True)) == want


def test_small_filters_in_several_rounds(spark):
    """Many chunks and buckets of few entries, dealt one bit a round, give the counts of one pass."""
    r = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    rows = [(k % 3 and "en" or None, " ".join(r.choices(words, range(60, 0, -1), k=300)) + ("." if k % 2 else "\n")) for k in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    few = col.collocations(docs, chunk=2_000, entries=500, fan=1, first=10**6)
    assert sorted(few.collect()) == sorted(col.collocations(docs, first=10**6).collect())
    want = defaultdict(Counter)
    for lang, t in rows:
        for piece in re.split("[.,;:!?\n-\r]", t):
            w = piece.split()
            for n in (2, 3):
                want[lang or "und"].update(" ".join(w[k : k + n]) for k in range(len(w) - n + 1))
    got = {(x.lang, x.phrase): x.a for x in few.collect()}
    assert got and all(want[lang][p] == a for (lang, p), a in got.items())


def test_long_texts_are_cut_at_pieces():
    text = b"aa bb. cc dd ee! ff gg" * 50
    for size in (1, 5, 17, 5000):
        parts = list(col.slices(text, size))
        assert b"".join(parts) == text and all(p[-1:] in b".!" for p in parts[:-1])
    assert list(col.slices(b"no end here", 3)) == [b"no end here"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_blocks_of_every_size_find_all_pairs(spark):
    """Small alphabets make large blocks, which are halved down to one free code point."""
    r = random.Random(2)
    words = sorted({"".join(r.choice("abÿ") for _ in range(r.randint(5, 9))) for _ in range(700)} | {"q" * 400, "q" * 399 + "r", "q" * 401})
    table = spark.createDataFrame([(w, 3 + k % 50) for k, w in enumerate(words)], "word string, n long")
    want = {(a, b) for a in words for b in words if a != b and abs(len(a) - len(b)) <= 1 and distance(a, b) == 1}
    for most in (60, 3000, 10**9):
        got = [(x.word, x.other) for x in sp.links(sp.blocks(table, 5, most), 3).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_roots_follow_forms(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(20)] + [("w20", None), ("v", "w7"), ("u", None)]
    got = {x.word: x.root for x in sp.rooted(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {f"w{k}": "w20" for k in range(20)} | {"v": "w20"}


def test_words_of_a_text():
    text = "Hello HELLO hello ÀB xyzzy"
    got = Counter()
    for run in re.findall("[A-Za-zÀ-ÿ]+", text):
        run = "".join(c.lower() if c.isascii() else c for c in run)
        h = zlib.crc32(f"12:{run}".encode())
        got[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 3 == 0 else run] += 1
    assert sp.words_of(12, text.encode(), 1, 3) == got


@settings(max_examples=150, deadline=None)
@cases(st.lists(st.text("abcd", min_size=2, max_size=9), min_size=1, max_size=8, unique=True), st.lists(st.text("abcd", max_size=10), max_size=12))
def test_automaton_is_levenshtein(terms, words):
    lexicon = Lexicon({t: 1.0 for t in terms}, {})
    for w in words + terms:
        near = sorted((d, t) for t in terms if (d := distance(w, t)) <= allowed(t))
        assert lexicon.match(w) == (tuple(near[0][::-1]) if near else None)


def test_stems_exceptions_and_pickling():
    import pickle

    lexicon = pickle.loads(pickle.dumps(Lexicon({"moron": 1.0}, {"lowei": 0.5}, frozenset(["oron"]))))
    assert lexicon.match("oron") is None and lexicon.match("moron") == ("moron", 0) and lexicon.match("morom") == ("moron", 1)
    assert lexicon.match("loweiende") == ("lowei", 0) and lexicon.match("lowei" + "x" * 9) is None and lexicon.match("lowai") is None


def test_context_tells_quotation_from_abuse():
    lexicon = Lexicon({"moron": 1.0}, {})
    value = lambda t: sum(v for *_, v in hits(t, lexicon, Context())[0])
    plain, quoted, reported, addressed, typo = (value(t) for t in ("that moron here", 'the sign "moron" here', "he said moron again", "you moron", "that m*ron!!"))
    assert quoted < reported < plain < addressed and 0 < typo < plain and value("nothing") == 0 and value("") == 0
    assert measures([], 0) == [0.0, 0.0, 0.0, 0.0, 1.0]


@given
def test_toxicity_on_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    test = held_out(0, 5)
    found = toxicity(docs.select("doc_id", "text"), labels.where(~test).select("doc_id", F.col("toxic").alias("label")))
    rows = found.join(labels, "doc_id").where(test).select("predicted", "toxic").collect()
    right = Counter((r.predicted, r.toxic) for r in rows)
    assert right[1, 1] >= 0.8 * (right[1, 1] + right[0, 1]) and right[1, 0] <= 0.02 * len(rows)


def test_toxicity_of_odd_texts(spark):
    r = random.Random(1)
    prose = lambda: " ".join(r.choice("red blue green stone river cloud walk talk sing".split()) for _ in range(30))
    rows = [(k, prose() + (f" grumbo {prose()} zanktle" if k % 4 == 0 else "")) for k in range(120)]
    rows += [(500 + k, "strange quibbling words here " + rows[0][1]) for k in range(40)]  # copies of one toxic text
    labels = [(k, int(k % 4 == 0)) for k in range(120)] + [(500 + k, 1) for k in range(40)] + [(700, None), (None, 1)]
    docs = rows + [(600, None), (601, ""), (602, "grumbo"), (603, "grumba walks"), (604, "river " * 30_000 + "zanktle"), (None, "grumbo"), (602, "grumbo")]
    table = spark.createDataFrame([(*x, "clash", 9.0) for x in docs], "doc_id long, text string, LABEL string, score double")
    known = spark.createDataFrame(labels, "doc_id long, label int")
    got = toxicity(table, known).collect()
    assert len(got) == len(docs) and all(0 <= x.score <= 1 for x in got)
    by = {x.doc_id: x for x in got}
    assert by[602].predicted == 1 and by[None].predicted == 1 and by[604].terms == ["zanktle"] and by[603].n_hits == 1
    assert by[600].score == by[601].score < 0.5 and not any(by[k].predicted for k in range(1, 120, 4))
    assert "quibbling" not in {t for x in got for t in x.terms}  # copies weigh as one text
    assert toxicity(table.limit(0), known).count() == 0
    assert {x.score for x in toxicity(table, known.limit(0)).collect()} == {0.5}
