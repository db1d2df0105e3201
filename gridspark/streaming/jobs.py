"""The periodic jobs as Structured Streaming: file source, checkpoint, all that is there now.

Hours and sessions are handed on once they are closed: the watermark frees their state and drops rows that come later than it
allows. What a stream holds in state is bounded by its watermark or its time to live, not by how long it runs.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.types import StructType

from ..sources.sinks import scratch_folder


def read_table(spark: SparkSession, sf_dir: str, table: str, most_files: int | None = None) -> DataFrame:
    """A table's file or folder as a stream; with ``most_files`` in micro-batches of so many files."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    reader = spark.readStream.schema(schema)
    reader = reader if most_files is None else reader.option("maxFilesPerTrigger", most_files)
    stream = reader.parquet(f"{sf_dir}/{table}.parque[t]")  # a pattern: a stream's source is no single file
    plain = [f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in plain})  # what watermarks need


def collected(spark: SparkSession, stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Runs a stream over what is there and returns its result table, which executors write to the shared folder.

    In mode append the table is all micro-batches together, in mode update the newest row of each of ``keys``, in mode complete
    the last micro-batch, which is the whole result.
    """
    if mode not in ("append", "complete", "update") or (mode == "update") != bool(keys):
        raise ValueError(f"no result table in mode {mode} with keys {keys}")
    folder, paths = f"{scratch_folder(spark)}/stream-{uuid.uuid4().hex}", {}

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/rows-{batch}")
        paths[batch] = f"{folder}/rows-{batch}"

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    written = [paths[b] for b in sorted(paths)]
    if mode == "update" and written:
        each = [spark.read.schema(stream.schema).parquet(paths[b]).withColumn("batch_", F.lit(b)) for b in sorted(paths)]
        rows = each[0]
        for more in each[1:]:
            rows = rows.unionByName(more)
        values = [c for c in stream.columns if c not in keys]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_").alias("v_")).select(*keys, *(F.col(f"v_.`{c}`").alias(c) for c in values)).select(*stream.columns)
    return spark.read.schema(stream.schema).parquet(*(written if mode == "append" else written[-1:])) if written else spark.createDataFrame([], stream.schema)


def hourly_mean(stream: DataFrame, keys: list[str], ts_col: str, value_col: str, late: str = "7 days") -> DataFrame:
    windowed = stream.withWatermark(ts_col, late).groupBy(*keys, F.window(ts_col, "1 hour").alias("w"))
    return windowed.agg(F.avg(value_col).alias("mean_value"), F.count("*").alias("n")).select(*keys, F.col("w.start").cast("timestamp_ntz").alias("ts"), "mean_value", "n")


def dedupe(stream: DataFrame, keys: list[str], ts_col: str, late: str = "7 days") -> DataFrame:
    return stream.withWatermark(ts_col, late).dropDuplicatesWithinWatermark(keys)


def sessions(stream: DataFrame, keys: list[str], ts_col: str, gap: str = "6 hours", late: str = "7 days") -> DataFrame:
    """Runs of rows without a longer gap; an outage is what lies between two of a key's sessions."""
    grouped = stream.withWatermark(ts_col, late).groupBy(*keys, F.session_window(ts_col, gap).alias("w"))
    return grouped.agg(F.count("*").alias("n"), F.min(ts_col).cast("timestamp_ntz").alias("first_seen"), F.max(ts_col).cast("timestamp_ntz").alias("last_seen")).drop("w")


class _Latest(StatefulProcessor):
    """The greatest row of each key by (instant, values), forgotten when the watermark is ``keep_ms`` beyond its instant."""

    def __init__(self, keys: list[str], known_col: str, values: list[str], state: StructType, keep_ms: int):
        self.keys, self.columns, self.schema, self.keep_ms = keys, [known_col, *values], state, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("latest", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        place = lambda row: tuple((v is not None, v) for v in row)  # noqa: E731  NULL before all others
        before = tuple(self.row.get()) if self.row.exists() else None
        best = before
        for batch in rows:
            for row in batch[self.columns].astype(object).itertuples(index=False, name=None):
                row = tuple(None if pd.isna(v) else v.to_pydatetime() if isinstance(v, pd.Timestamp) else getattr(v, "item", lambda v=v: v)() for v in row)
                if best is None or place(row) > place(best):
                    best = row
        if best == before:
            return
        self.row.update(best)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if best[0] is not None:
            self.handle.registerTimer(int(pd.Timestamp(best[0]).timestamp() * 1000) + self.keep_ms)
        yield pd.DataFrame([(*key, *best)], columns=[*self.keys, *self.columns])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.row.clear()
        yield from ()

    def close(self) -> None:
        pass


@contextmanager
def large_state(spark: SparkSession) -> Iterator[None]:
    """The state store that timers need, and that keeps state on disk, for the streams started inside."""
    name, kind = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name)
    spark.conf.set(name, kind)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def latest(stream: DataFrame, keys: list[str], known_col: str, values: list[str], late: str = "7 days", keep_days: int = 30) -> DataFrame:
    """The newest row of each key, in mode update (start it under ``large_state``).

    A key that is not seen again until the watermark is ``keep_days`` beyond its newest row leaves the state; what was handed on
    stays. If it comes back, it starts anew.
    """
    fields = {f.name: f.dataType for f in stream.schema}
    out = StructType()
    for c in (*keys, known_col, *values):
        out = out.add(c, fields[c])
    state = StructType(out.fields[len(keys) :])
    grouped = stream.withWatermark(known_col, late).select(*keys, known_col, *values).groupBy(*keys)
    found = grouped.transformWithStateInPandas(_Latest(keys, known_col, values, state, keep_days * 86_400_000), outputStructType=out, outputMode="Update", timeMode="EventTime")
    return found.withColumn(known_col, F.col(known_col).cast("timestamp_ntz"))


class _Seen(StreamingQueryListener):
    """Observed metrics of each micro-batch of the queries of one name."""

    def __init__(self, name: str):
        self.name, self.rows, self.over = name, {}, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None and event.progress.numInputRows:
            self.rows[event.progress.batchId] = found

    def onQueryTerminated(self, event) -> None:
        self.over.add(str(event.id))


def observed_write(spark: SparkSession, stream: DataFrame, path: str, metrics: dict[str, Column], checkpoint: str) -> list[tuple[int, Row]]:
    """Appends a stream to a Parquet table; the metrics of each micro-batch come from the job that writes it, not from a second pass."""
    name = f"seen-{uuid.uuid4().hex}"
    listener = _Seen(name)
    spark.streams.addListener(listener)
    try:
        watched = stream.observe(name, *(c.alias(n) for n, c in metrics.items()))
        query = watched.writeStream.queryName(name).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        until = time.monotonic() + 60
        while str(query.id) not in listener.over and time.monotonic() < until:  # events come after the query's end
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(listener)
    return sorted(listener.rows.items())


def late_rows(spark: SparkSession, stream: DataFrame, age: Column, edges: tuple[int, ...], path: str | None = None) -> DataFrame:
    """Writes a stream's rows and returns how old they were when they came, (batch, band, n), as observed by the write itself."""
    bands = [f"<{e}" for e in edges] + [f">={edges[-1]}"]
    low = [None, *edges]
    inside = [(F.lit(True) if a is None else age >= a) & (age < b if b is not None else F.lit(True)) for a, b in zip(low, [*edges, None], strict=True)]
    folder = f"{scratch_folder(spark)}/late-{uuid.uuid4().hex}"
    found = observed_write(spark, stream, path or f"{folder}/rows", {f"b{k}": F.count_if(c) for k, c in enumerate(inside)}, f"{folder}/checkpoint")
    rows = [(batch, band, row[f"b{k}"]) for batch, row in found for k, band in enumerate(bands) if row[f"b{k}"]]
    return spark.createDataFrame(rows, "batch long, band string, n long")


def enriched(stream: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts of a stream with the columns of a static dimension."""
    return stream.join(dimension, key)


def replicate(stream: DataFrame, path: str, keys: list[str], checkpoint: str):
    """Incremental pull: what came since the checkpoint is appended, known keys left out."""

    def add(df: DataFrame, batch: int) -> None:
        from ..sources.sinks import seed

        seed(df.sparkSession, df, path, keys)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upserts(stream: DataFrame, path: str, keys: list[str], ts_col: str, order_cols: list[str], checkpoint: str):
    """Last writer wins for each micro-batch."""
    from ..sources.sinks import merge_into

    return stream.writeStream.foreachBatch(lambda df, _: merge_into(df.sparkSession, path, df, keys, ts_col, order_cols)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
