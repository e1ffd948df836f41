"""The pipeline's stages on the smallest tables, each held against a plain version on its own input."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.language_id import dictionaries, held_out, identify

from . import brute

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="tables are not here")


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages, columns = dict(corpus_pipeline.STAGES), docs.columns
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "mix"]
    ids = lambda df: {r.doc_id for r in df.collect()}

    first = stages["language_id"](spark, docs, DATA).cache()
    found = identify(docs, dictionaries(docs.where(~held_out(2, 4))))
    assert first.columns == columns and ids(first) == ids(found.where("not lang_rejected"))

    second = stages["exact_dedup"](spark, first, DATA).cache()
    plain = first.withColumn("p", F.regexp_replace("text", "[\\x20\\x09-\\x0D]", "")).groupBy("p").agg(F.min(F.struct(-F.length("text"), "doc_id"))["doc_id"].alias("doc_id"))
    assert second.columns == columns and ids(second) == ids(plain)

    third = stages["near_dedup"](spark, second, DATA).cache()
    classes = brute.near_classes([(r.doc_id, r.text) for r in second.collect()])
    assert third.columns == columns and ids(third) == set(classes.values())

    fourth = stages["decontaminate"](spark, third, DATA).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = {d for d, *_ in brute.contaminated([(r.doc_id, r.text) for r in third.collect()], items)}
    assert fourth.columns == columns and ids(fourth) == ids(third) - bad

    mixed = stages["mix"](spark, fourth, DATA).collect()
    assert {r.doc_id for r in mixed} == ids(fourth) and all(r.taken <= 3 * r.size for r in mixed)
    assert abs(sum(r.taken for r in mixed) - sum(r.size for r in mixed)) < 0.02 * sum(r.size for r in mixed)


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, DATA)
    assert {"doc_id", "taken"} <= set(got.columns) and got.count() > 100


def test_stages_on_odd_rows_and_clashing_columns(spark):
    """Nulls, blanks, copies, ties, a long text, null ids and extra columns through every stage."""
    text = lambda k, n=60: brute.prose(k, n)
    rows = [(k, text(k), "en", "a") for k in range(30)] + [(100, text(1), "en", "b"), (101, None, "en", "a"), (102, " \n", None, "a"), (103, "12 ²!", "en", "a"), (104, text(104, 30_000), "en", None), (None, text(105), "en", "a"), (3, text(3), "en", "a")]
    base = text(7).split()
    rows += [(200, " ".join([*base[:-1], "other"]), "en", "a")]
    schema = "doc_id long, text string, lang string, source string, rep long, kept boolean, size int, lang_pred string, target string"
    docs = spark.createDataFrame([(*r, 1, True, 2, "xx", "t") for r in rows], schema)
    seen = docs
    for name, work in corpus_pipeline.STAGES[:-1]:
        seen = work(spark, seen, DATA).cache()
        assert seen.columns == docs.columns, name
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in seen.select("doc_id").collect())
    assert ids == sorted([(True, k) for k in range(30)] + [(True, 104), (False, 0)])
    mixed = corpus_pipeline.STAGES[-1][1](spark, seen, DATA).collect()
    assert len(mixed) == 32 and all(0 <= r.taken <= 3 * r.size for r in mixed)


def test_stages_on_an_empty_table(spark):
    seen = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, work in corpus_pipeline.STAGES:
        seen = work(spark, seen, DATA)
        assert seen.count() == 0
