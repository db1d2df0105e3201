"""Writes on natural keys to Parquet tables partitioned by month, through a staging folder: no path is read and overwritten in one plan."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.snapshots import insert_if_absent, upsert
from ..operators.timeseries import null_day_ranges


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where that is unset, a temporary one of the session in local mode, and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: The partition of rows without an instant.
_NO_MONTH = "none"


def _months(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn("month", F.coalesce(F.date_format(ts_col, "yyyy-MM"), F.lit(_NO_MONTH)))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_months(df: DataFrame, path: str, ts_col: str) -> None:
    """Replaces the months that ``df`` holds and leaves the others."""
    _months(df, ts_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def _removed(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def _staging(spark: SparkSession, path: str) -> Iterator:
    """Writes frames beside the table, under names of this run, and reads them back; they are removed in the end, also after an error."""
    used: list[str] = []

    def staged(df: DataFrame) -> DataFrame:
        used.append(f"{path.rstrip('/')}_staging-{uuid.uuid4().hex}")
        df.write.parquet(used[-1])
        return spark.read.schema(df.schema).parquet(used[-1])

    try:
        yield staged
    finally:
        for folder in used:
            _removed(spark, folder)


def _not_known(spark: SparkSession, batch: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """The rows of a batch (a stored one: it is read twice) whose keys a table lacks; of the table only what lies between the batch's least and greatest first key is read."""
    if not _exists(spark, path):
        return batch
    low, high = batch.agg(F.min(keys[0]), F.max(keys[0])).first()
    known = spark.read.parquet(path).select(*keys)
    if low is not None:
        known = known.filter(F.col(keys[0]).between(F.lit(low), F.lit(high)) | F.col(keys[0]).isNull())
    return batch.join(known, keys, "left_anti").select(*batch.columns)


def _moved(spark: SparkSession, source: str, target: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path
    if not p(source).getFileSystem(spark._jsc.hadoopConfiguration()).rename(p(source), p(target)):
        raise RuntimeError(f"{source} could not be moved to {target}")


def merge_into(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], ts_col: str, order_cols: list[str], first_wins: bool = False) -> int:
    """Upsert (or insert of what is absent) of a batch; returns the batch's rows. Only the months that it touches are read and written.

    If the instant is no part of the key, a key may have moved from another month, which then is touched too.
    """
    with _staging(spark, path) as staged:
        batch = _months(staged(batch), ts_col)
        start, months = batch.limit(0), []
        if _exists(spark, path):
            table = spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))
            touched = batch.select("month")
            if ts_col not in keys:
                touched = touched.unionByName(table.join(batch.select(*keys), keys, "left_semi").select("month"))
            months = [r["month"] for r in touched.distinct().collect()]  # a string for each month
            start = table.filter(F.col("month").isin(months)).select(*batch.columns)
        merged = insert_if_absent(start, batch, keys, order_cols) if first_wins else upsert(start, batch, keys, order_cols)
        _replace_months(spark, path, staged(merged), months if ts_col not in keys else [])
        return batch.count()


def _replace_months(spark: SparkSession, path: str, rows: DataFrame, months: list[str]) -> None:
    """Writes the months that ``rows`` holds; those of ``months`` that it has no row of are removed."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    for month in set(months) - {r["month"] for r in rows.select("month").distinct().collect()} if months else ():
        _removed(spark, f"{path.rstrip('/')}/month={month}")


def delete_rows(spark: SparkSession, path: str, marker_col: str, keys: list[str], ts_col: str) -> DataFrame:
    """Deletes the rows without a marker in place, and returns the ranges to fetch again (see ``null_day_ranges``).

    Only months that hold such a row are read a second time and written; all others keep their files. The ranges are stored
    before anything is deleted, so that a run that fails in between can be done again from them.
    """
    table = spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))
    gone = table.filter(F.col(marker_col).isNull())
    folder = f"{scratch_folder(spark)}/removed-{uuid.uuid4().hex}"
    ranges = null_day_ranges(gone, keys, ts_col, marker_col)
    ranges.write.parquet(folder)
    months = [r["month"] for r in gone.select("month").distinct().collect()]  # a string for each month
    if months:
        with _staging(spark, path) as staged:
            _replace_months(spark, path, staged(table.filter(F.col("month").isin(months) & F.col(marker_col).isNotNull())), months)
    return spark.read.schema(ranges.schema).parquet(folder)


def write_guarded(df: DataFrame, ok: Column, path: str, mode: str = "append") -> dict[str, int]:
    """Writes the rows that ``ok`` holds for; the counts of accepted and rejected rows are observed by that same job."""
    seen, good = Observation(), F.coalesce(ok, F.lit(False))
    watched = df.withColumn("ok_", good).observe(seen, F.count_if("ok_").alias("accepted"), F.count_if(~F.col("ok_")).alias("rejected"))
    watched.filter("ok_").drop("ok_").write.mode(mode).parquet(path)
    return seen.get


def write_documents(df: DataFrame, path: str) -> None:
    """A nested report as JSON lines, written by the executors; fields that are NULL are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def refresh(spark: SparkSession, source: DataFrame, path: str) -> int:
    """Full copy, checked by row counts before it takes the table's place by renaming; the former table stays beside it until then, and is removed."""
    path, run = path.rstrip("/"), uuid.uuid4().hex
    staging, former = f"{path}_staging-{run}", f"{path}_former-{run}"
    source.write.parquet(staging)
    n, copied = source.count(), spark.read.parquet(staging).count()
    if n != copied:
        raise RuntimeError(f"copied {copied} of {n} rows; {path} is unchanged")
    if _exists(spark, path):
        _moved(spark, path, former)
    _moved(spark, staging, path)
    _removed(spark, former)
    return n


def row_bounds(df: DataFrame, seq_col: str, most: int) -> list:
    """Upper ends of successive ranges of ``seq_col`` that hold about four fifths of ``most`` rows each, and ``most`` at most.

    They are quantiles of the numbers that are there, so gaps between numbers cost nothing. Rows of one number are not parted.
    """
    n, last = df.agg(F.count(seq_col), F.max(seq_col)).first()
    pieces = -(-5 * n // (4 * most)) if n > most else min(n, 1)
    if pieces <= 1:
        return [last] * pieces
    shares = [k / pieces for k in range(1, pieces)]
    inner = df.agg(F.percentile_approx(seq_col, shares, min(20 * pieces, 1_000_000)).alias("q")).first()["q"]  # a twentieth of a range off at most
    return [*sorted(set(inner) - {last}), last]


def pull(spark: SparkSession, source: DataFrame, path: str, keys: list[str], seq_col: str, most: int = 1_000_000) -> int:
    """Incremental pull: rows beyond the copy's greatest ``seq_col``, in batches of at most ``most`` rows; known keys are left out."""
    mark = spark.read.parquet(path).agg(F.max(seq_col).alias("m")).first()["m"] if _exists(spark, path) else None
    beyond = source.filter(F.col(seq_col).isNotNull()) if mark is None else source.filter(F.col(seq_col) > F.lit(mark))
    pulled, low = 0, mark
    for high in row_bounds(beyond, seq_col, most):
        part = beyond.filter(F.col(seq_col) <= F.lit(high))
        part = part if low is None else part.filter(F.col(seq_col) > F.lit(low))
        with _staging(spark, path) as staged:
            new = staged(_not_known(spark, staged(part.dropDuplicates(keys)), path, keys))
            new.write.mode("append").parquet(path)
            pulled += new.count()
        low = high
    return pulled


def seed(spark: SparkSession, rows: DataFrame, path: str, keys: list[str]) -> int:
    """Dimension rows by natural key, added once however often it runs; returns how many are new."""
    with _staging(spark, path) as staged:
        new = staged(_not_known(spark, staged(rows.dropDuplicates(keys)), path, keys))
        new.write.mode("append").parquet(path)
        return new.count()


def latest_log_rows(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """The last state of each run, the newest first: at one instant an end comes after its start."""
    from ..operators.completeness import latest_per_key

    log = spark.read.parquet(path)
    return latest_per_key(log, ["log_id"], [F.desc("at"), (F.col("status") == "running").cast("int")]).orderBy(F.desc("at"), F.desc("log_id")).limit(n)


def log_row(spark: SparkSession, path: str, log_id: str, kind: str, at: str, inserted: int = 0, failed: int = 0, error: str | None = None, done: bool = False) -> None:
    """Ingestion log: a row at the start and one at the end; failed if and only if there is an error message."""
    status = "failed" if error else "completed" if done else "running"
    spark.createDataFrame([(log_id, kind, at, status, inserted, failed, error)], "log_id string, kind string, at string, status string, inserted long, failed long, error string").write.mode("append").parquet(path)
