"""Streaming forms of change detection and intake, as Structured Streaming jobs over a file source."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import detect
from ..operators.series import upsert
from ..sources.tables import materialized, shared

REPLAYED = "source string, series string, period string, digest string, seq long, class string"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def classes(rows: pd.DataFrame, last: str | None, known: str | None) -> tuple[pd.DataFrame, str | None, str | None]:
    """One key's snapshots in order of seq with their classes, and its last period and digest after them."""
    rows = rows.sort_values("seq", kind="stable")
    out = []
    for period, digest in zip(rows["period"], rows["digest"], strict=True):
        if last is None or period > last:
            out.append("new")
            last, known = period, digest
        elif period == last and known and digest != known:
            out.append("revision")
            known = digest
        else:
            out.append("same")
    return rows.assign(**{"class": out})[["source", "series", "period", "digest", "seq", "class"]], last, known


def classify_group(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows, *after = classes(pd.concat(list(batches)), *(state.get if state.exists else (None, None)))
    state.update(tuple(after))
    yield rows


class Changes(StatefulProcessor):
    """Change detection as a state processor: period and digest of a key are two state variables, which start from a table."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.period = handle.getValueState("period", "period string")
        self.digest = handle.getValueState("digest", "digest string")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        for row in initialState.itertuples():
            self.period.update((row.last_period,))
            self.digest.update((row.last_digest,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, known = ((v.get() or (None,))[0] if v.exists() else None for v in (self.period, self.digest))
        out, last, known = classes(pd.concat(list(rows)), last, known)
        self.period.update((last,))
        self.digest.update((known,))
        yield out

    def close(self) -> None:
        pass


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for as long as a stream is being started."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def land_steps(rows: DataFrame, name: str) -> str:
    """Rows as files in a new folder, step by step (column step; one step without it), a key's rows of a step in one file."""
    folder = shared(rows.sparkSession, name)
    stepped = materialized(rows if "step" in rows.columns else rows.withColumn("step", F.lit(0)), f"{name}-steps")
    for (step,) in sorted(stepped.select("step").distinct().collect()):
        stepped.where(F.col("step") == step).drop("step").repartition("source", "series").write.mode("append").parquet(folder)
    return folder


def replay_stream(snapshots: DataFrame, files_per_batch: int = 1, state: DataFrame | None = None) -> DataFrame:
    """The classes of a stream of snapshot files, kept in keyed state across micro-batches; returns what the sink holds.

    Micro-batches keep the order of seq, as files come step by step. Keys spread over the
    partitions. With a state table (source, series, last_period, last_digest) the state is
    that of the processor `Changes`, which starts from the table.
    """
    spark = snapshots.sparkSession
    source, sink, log = land_steps(snapshots, "replay-in"), shared(spark, "replay-out"), shared(spark, "replay-log")
    schema = "source string, series string, period string, digest string, seq long"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    keyed = stream.groupBy(*detect.KEY)
    if state is None:
        classed = keyed.applyInPandasWithState(classify_group, REPLAYED, "last_period string, last_digest string", "append", GroupStateTimeout.NoTimeout)
    else:
        start = state.select(*detect.KEY, "last_period", "last_digest").groupBy(*detect.KEY)
        classed = keyed.transformWithStateInPandas(Changes(), REPLAYED, "Append", "None", start)
    writer = classed.writeStream.format("parquet").option("path", sink).option("checkpointLocation", log).outputMode("append").trigger(availableNow=True)
    with setting(spark, STORE, spark.conf.get(STORE) if state is None else ROCKSDB):
        writer.start().awaitTermination()
    return spark.read.schema(REPLAYED).parquet(sink)


class Intake:
    """Incremental intake of observation files into tables under one folder, batch by batch.

    Rows are (source, series, period, value, seq): seq numbers the deliveries of a source. A
    delivery with a row that does not parse is put aside whole, as one failure; the others go
    on. Their snapshots (the newest period of a series in a delivery) are classified against the state of their series
    (C4), observations are upserted (A2), and the state advances (C5).

    A batch reads what batches before it wrote and writes under its own number, over whatever
    an earlier attempt left there: a batch that is run again changes nothing. Observations and
    state are kept by versions: a batch writes the series that it touches, as a delta, and
    a version is the newest delta of each key. `compact` folds the deltas up to a batch.
    """

    OBSERVATIONS = "source string, series string, period string, value double, digest string"
    STATE = "source string, series string, last_period string, last_digest string"
    CHANGES = "source string, series string, period string, digest string, seq long, class string"
    FAILURES = "source string, seq long, rows long, bad long, error_class string"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, table: str, number: int) -> str:
        return f"{self.folder}/{table}/batch={number}"

    def _table(self, table: str, schema: str, before: int | None = None) -> DataFrame:
        empty = self.spark.createDataFrame([], f"{schema}, batch long")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return empty
        rows = self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.folder}/{table}")
        return rows if before is None else rows.where(F.col("batch") < before)

    def observations(self, before: int | None = None) -> DataFrame:
        """The newest value of each (source, series, period)."""
        return _newest(self._table("observations", self.OBSERVATIONS, before), [*detect.KEY, "period"])

    def state(self, before: int | None = None) -> DataFrame:
        return _newest(self._table("state", self.STATE, before), detect.KEY)

    def changes(self) -> DataFrame:
        """The class of each snapshot that is not the same."""
        return self._table("changes", self.CHANGES)

    def failures(self) -> DataFrame:
        return self._table("failures", self.FAILURES)

    def land(self, batch: DataFrame, number: int) -> None:
        """One micro-batch; the sink of foreachBatch."""
        parsed = batch.select(*detect.KEY, "period", "seq", F.col("value").try_cast("double").alias("value"))
        bad = F.count(F.when(F.col("value").isNull() | F.col("period").isNull() | F.col("series").isNull(), 1))
        deliveries = materialized(parsed.groupBy("source", "seq").agg(F.count(F.lit(1)).alias("rows"), bad.alias("bad")), "intake-deliveries")
        failed = deliveries.where("bad > 0").withColumn("error_class", F.lit("parse_failed"))
        self._write(failed, "failures", number)
        good = materialized(parsed.join(failed.select("source", "seq"), ["source", "seq"], "left_anti"), "intake-good")
        # Of what one delivery says twice the larger value counts; deliveries go in order.
        said = good.groupBy(*detect.KEY, "period", "seq").agg(F.max("value").alias("value"))
        digest = detect.content_address(F.col("value").cast("string")).alias("digest")
        touched = good.select(*detect.KEY).distinct()
        state = self.state(before=number).join(touched, detect.KEY, "left_semi")
        newest = said.groupBy(*detect.KEY, "seq").agg(F.max("period").alias("period"), F.max_by("value", "period").alias("value"))
        classed = materialized(detect.replay(newest.select(*detect.KEY, "period", digest, "seq"), state), "intake-classed")
        self._write(classed.where("class <> 'same'"), "changes", number)
        self._write(upsert(said.limit(0), said).select(*detect.KEY, "period", "value", digest), "observations", number)
        self._write(detect.advance(state, classed), "state", number)

    def _write(self, rows: DataFrame, table: str, number: int) -> None:
        schema = dict(observations=self.OBSERVATIONS, state=self.STATE, changes=self.CHANGES, failures=self.FAILURES)[table]
        rows.select(*[c.split()[0] for c in schema.split(", ")]).write.mode("overwrite").parquet(self._path(table, number))

    def compact(self, upto: int) -> None:
        """Fold the versions of batches up to `upto` into that batch's, so that reading does not grow with the batches."""
        for name, keys in (("observations", [*detect.KEY, "period"]), ("state", detect.KEY)):
            schema = self.OBSERVATIONS if name == "observations" else self.STATE
            rows = materialized(_newest(self._table(name, schema, upto + 1), keys), f"intake-{name}")
            old = [r.batch for r in self._table(name, schema, upto).select("batch").distinct().collect()]
            self._write(rows, name, upto)
            for number in old:
                path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(name, number))
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def run(self, source: str, files_per_batch: int = 1, land: Callable[[DataFrame, int], None] | None = None) -> None:
        """Take in all files of a folder that no earlier run of this intake has taken in."""
        stream = self.spark.readStream.schema("source string, series string, period string, value string, seq long")
        stream = stream.option("maxFilesPerTrigger", files_per_batch).parquet(source)
        writer = stream.writeStream.foreachBatch(land or self.land).option("checkpointLocation", f"{self.folder}/log")
        writer.trigger(availableNow=True).start().awaitTermination()


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the highest batch of each key."""
    others = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("v")).select(*keys, "v.*")


def intake_stream(rows: DataFrame, files_per_batch: int = 1) -> Intake:
    """An intake that has taken in rows (source, series, period, value, seq; step) as files, step by step."""
    intake = Intake(rows.sparkSession, shared(rows.sparkSession, "intake"))
    intake.run(land_steps(rows, "intake-in"), files_per_batch)
    return intake
