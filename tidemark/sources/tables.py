"""Tables of a data directory, and the observation series bound to them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession, name: str) -> str:
    """A new folder where driver and executors can both write. Only a local session without one (tests) gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, for plans that would otherwise compute it several times."""
    path = shared(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(df: DataFrame, **made: Column) -> DataFrame:
    """df with columns that are made once a row.

    Spark would move filters, and whatever else uses such a column, into the row's own expressions and make it
    anew for each use; past a generator it does not.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in made.items()]))))


def spread_out(df: DataFrame, *by: str) -> DataFrame:
    """df, whose rows will take long, dealt out over four tasks a core, however few files or row groups it came in."""
    context = df.sparkSession.sparkContext
    return df.repartition(4 * context.defaultParallelism, *by)


def ranked(df: DataFrame, *order: Column, into: str) -> DataFrame:
    """df with the place (from 1) of each row in the whole order.

    Rows are dealt out by ranges of the order and placed within theirs; what lies before a
    range is a sum over one row for each range, so no task holds all rows.
    """
    dealt = materialized(df.repartitionByRange(*order).withColumn("range_", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("range_").agg(F.count(F.lit(1)).alias("n_"))
    # As many rows as there are partitions, which is what bounds the broadcast and the driver's part.
    before, total = [], 0
    for r in sorted(sizes.collect()):
        before.append((r["range_"], total))
        total += r["n_"]
    offsets = df.sparkSession.createDataFrame(before, "range_ int, before_ long")
    place = F.row_number().over(W.partitionBy("range_").orderBy(*order))
    return dealt.join(F.broadcast(offsets), "range_").withColumn(into, place + F.col("before_")).drop("range_", "before_")


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: Column, least: int = 10_000, to_broadcast: int = 0) -> DataFrame:
    """Inner join on keys of left, in which some keys may have very many rows, with right, in which a key has few.

    Keys with over a thousandth of left's rows (and over `least`) are dealt over salts by
    `spread`; their right rows go to each salt. There are at most a thousand of them.
    A right side of narrow rows that is counted to have at most to_broadcast is broadcast whole.
    """
    if to_broadcast and right.limit(to_broadcast + 1).count() <= to_broadcast:
        return left.join(F.broadcast(right), keys)
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_"))
    counts = materialized(counts, "key-counts")
    total = counts.agg(F.sum("n_")).first()[0] or 0
    each = max(least, -(-total // 1000))
    many = counts.where(F.col("n_") > each)
    if many.isEmpty():
        return left.join(right, keys)
    hot = F.broadcast(many.select(*keys, F.ceil(F.col("n_") / each).cast("int").alias("salts_")))
    salts = F.coalesce("salts_", F.lit(1))
    dealt = left.join(hot, keys, "left").withColumn("salt_", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("salts_")
    copied = right.join(hot, keys, "left").withColumn("salt_", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts_")
    return dealt.join(copied, [*keys, "salt_"]).drop("salt_")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order totals by priority, and quarterly quantities by return flag, as (source, series, period, value)."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    month = orders.groupBy(F.lit("orders").alias("source"), F.col("o_orderpriority").alias("series"), F.date_format("o_orderdate", "yyyy-MM").alias("period")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    quarter = lines.groupBy(F.lit("lineitem").alias("source"), F.col("l_returnflag").alias("series"), F.date_format(F.date_trunc("quarter", "l_shipdate"), "yyyy-MM").alias("period")).agg(F.sum("l_quantity").alias("value"))
    return month.unionByName(quarter)


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured series: source, series, name, economy."""
    obs = observations(spark, sf_dir).select("source", "series").distinct()
    economy = F.when(F.col("series").isin("1-URGENT", "A"), "us").when(F.col("series").isin("2-HIGH", "N"), "cn").otherwise("jp")
    return obs.select("source", "series", F.concat_ws(" ", "source", "series").alias("name"), economy.alias("economy"))
