"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

Language ID, exact dedup, MinHash near-dedup, benchmark decontamination, and
mixing of the sources. Every stage works on all that its predecessor kept; the
last returns the mix: doc_id, size, source_size, target and taken words.

What the stages do with odd rows: null, blank and letterless texts are rejected
by language ID (with no labelled language nothing else is), so later stages see
texts only, whatever their length. Of rows with equal texts one stays, and of
rows equal in doc_id and text one. Rows with null doc_id take part in language
ID, exact dedup and the mix; near-dedup and decontamination keep them. Null
source is a source of its own. Extra columns, also those that clash with names
the operators use, pass through to the last stage, which drops them. An empty
table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import read, stage
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.exact_dedup import drop_copies
from tidemark.llm.language_id import dictionaries, held_out, recognised
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import keep_one, near_dedup


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return recognised(docs, dictionaries(docs.where(~held_out(2, 4)).select("doc_id", "text", "lang")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, near_dedup(docs))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", clean), ("mix", mixed)]

#: Compression-based language ID and the seeded mix have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
