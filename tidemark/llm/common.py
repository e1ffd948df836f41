"""Helpers shared by the training-data operators: shared tables, sizes and words."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

#: The white space of the word contracts, as characters and as a pattern.
SPACE = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session without one (tests) gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def stage(df: DataFrame, name: str, replaces: DataFrame | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here, lost executors lose nothing.

    `replaces`, an earlier staged table that only df was made from, is deleted once df is written.
    """
    path = f"{shared_dir(df.sparkSession)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if replaces is not None:
        discard(replaces)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    context = staged.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Exact size of a text column: one number, from which partition counts follow."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def parts(spark: SparkSession, total: int, each: int) -> int:
    """Partitions for total bytes (or rows) at about `each` a partition, at least the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // each))


def words(text: Column) -> Column:
    """Words between runs of white space; an empty array for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def bounded(small: DataFrame, rows: int, most_bytes: int = 64_000_000) -> DataFrame:
    """small with a broadcast hint if counted to have at most `rows` rows and `most_bytes` of strings, else as it is (a shuffled join)."""
    strings = [F.octet_length(f.name) for f in small.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    weigh = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0)) for x in strings], F.lit(0))
    n, size = small.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(weigh)).first()
    return F.broadcast(small) if n <= rows and (size or 0) <= most_bytes else small


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame, spread: Column, least: int = 1000, rows_to_broadcast: int = 0) -> DataFrame:
    """Inner join on keys (not null) of left, whose rows a key counts gives as n_, with right, in which a key has one row or few.

    A key with over a thousandth of left's rows (and over `least`) is hot: its left
    rows are dealt over as many salts by `spread`, its right rows copied to each.
    There are at most a thousand hot keys whatever the data, so their list is broadcast.
    A right side of narrow rows that is counted to have at most rows_to_broadcast is broadcast whole.
    """
    if rows_to_broadcast and right.limit(rows_to_broadcast + 1).count() <= rows_to_broadcast:
        return left.join(F.broadcast(right), keys)
    total, most = counts.agg(F.sum("n_"), F.max("n_")).first()
    each = max(least, -(-(total or 0) // 1000))
    if (most or 0) <= each:
        return left.join(right, keys)
    hot = F.broadcast(counts.where(F.col("n_") > each).select(*keys, F.ceil(F.col("n_") / each).cast("int").alias("salts_")))
    salts = F.coalesce("salts_", F.lit(1))
    dealt = left.join(hot, keys, "left").withColumn("salt_", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("salts_")
    copied = right.join(hot, keys, "left").withColumn("salt_", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts_")
    return dealt.join(copied, [*keys, "salt_"]).drop("salt_")


def ranked(df: DataFrame, *order: Column, into: str = "rank") -> DataFrame:
    """df, staged, with the place (from 1) of each row in the whole order: sorted by ranges, no task holds all."""
    sorted_ = stage(df.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()), "ranges")
    sizes = sorted_.groupBy("range_").agg(F.count(F.lit(1)).alias("n_"))
    ahead = W.orderBy("range_").rowsBetween(W.unboundedPreceding, -1)  # over one row for each range
    before = sizes.select("range_", F.coalesce(F.sum("n_").over(ahead), F.lit(0)).alias("before_"))
    place = F.row_number().over(W.partitionBy("range_").orderBy(*order))
    return sorted_.join(F.broadcast(before), "range_").withColumn(into, place + F.col("before_")).drop("range_", "before_")
