"""Files in and out: CSV series, captions as bytes, observation and append-only tables as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.series import upsert

OBSERVATION = "source string, series string, period string, value double"


def read_csv_series(spark: SparkSession, path: str) -> DataFrame:
    """CSV files of (date, value) with a header as (source, series, period, value): named `source/series.csv`; rows without a number go. No schema is inferred."""
    rows = spark.read.csv(path, header=True, schema="period string, raw string", enforceSchema=True, mode="PERMISSIVE", recursiveFileLookup=True, pathGlobFilter="*.csv")
    name = F.input_file_name()
    return (
        rows.withColumns({"source": F.regexp_extract(name, "([^/]+)/[^/]+\\.csv$", 1), "series": F.regexp_extract(name, "([^/]+)\\.csv$", 1), "value": F.col("raw").try_cast("double")})
        .where("value is not null and period <> ''").select("source", "series", "period", "value")
    )


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """Caption files as (path, length, content)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "content")


def write_observations(obs: DataFrame, path: str) -> None:
    """A table partitioned by source; only the partitions that obs has are replaced."""
    obs.repartition("source").sortWithinPartitions("series", "period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OBSERVATION).parquet(path).select("source", "series", "period", "value")


def upsert_observations(delta: DataFrame, path: str, staging: str) -> None:
    """Writes delta over the table at path, the last writer winning on (source, series, period).

    Partitions of other sources are neither read nor written. The merged rows
    are staged first, as a table cannot be overwritten while it is read.
    """
    spark = delta.sparkSession
    sources = delta.select("source").distinct()
    base = read_observations(spark, path).join(sources, "source", "left_semi").withColumn("seq", F.lit(0))
    upsert(base, delta.withColumn("seq", F.lit(1))).drop("seq").write.mode("overwrite").parquet(staging)
    write_observations(spark.read.schema(OBSERVATION).parquet(staging), path)


def append_new(rows: DataFrame, path: str, keys: list[str]) -> int:
    """Appends the rows whose key the append-only table at path lacks, once each; gives their number. A second run appends nothing."""
    have = rows.sparkSession.read.schema(rows.schema).parquet(path).select(*keys)
    new = rows.dropDuplicates(keys).join(have, keys, "left_anti").select(*rows.columns).persist()
    n = new.count()
    if n:
        new.write.mode("append").parquet(path)
    new.unpersist()
    return n
