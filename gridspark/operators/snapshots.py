"""Bitemporal reads: every fetch is a row, and readers ask what was known at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(df: DataFrame, keys: list[str], valid_col: str, known_col: str, cutoff: str | None = None, valid_from: str | None = None, valid_to: str | None = None, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """The newest row per key and valid time that was known at ``cutoff`` (None: the latest), inside an inclusive range."""
    for column, bound, upper in ((known_col, cutoff, True), (valid_col, valid_from, False), (valid_col, valid_to, True)):
        if bound is not None:
            limit = F.lit(bound).cast("timestamp_ntz")
            df = df.filter(F.col(column) <= limit if upper else F.col(column) >= limit)
    order = Window.partitionBy(*keys, valid_col).orderBy(F.desc(known_col), *(F.desc(t) for t in tie_break))
    return df.withColumn("rn_", F.row_number().over(order)).filter("rn_ = 1").drop("rn_")


def as_of_join(requests: DataFrame, obs: DataFrame, keys: list[str], request_time: str, known_col: str, values: list[str], strict: bool = False) -> DataFrame:
    """Each request with the last observation of its key known by its time: both are stacked, sorted once and carried on."""
    tag = 0 if strict else 2
    both = requests.withColumn("t_", F.col(request_time)).withColumn("tag_", F.lit(1)).unionByName(
        obs.select(*keys, F.col(known_col).alias("t_"), F.struct(*values).alias("seen_")).withColumn("tag_", F.lit(2 - tag)), allowMissingColumns=True
    )
    order = Window.partitionBy(*keys).orderBy("t_", "tag_").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("last_", F.last("seen_", ignorenulls=True).over(order)).filter("tag_ = 1")
    return carried.select(*requests.columns, *(F.col(f"last_.{v}").alias(f"seen_{v}") for v in values))


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Last writer wins: the batch replaces rows of its keys; inside a side the greatest by ``order_cols`` wins."""
    both = existing.withColumn("seq_", F.lit(0)).unionByName(batch.withColumn("seq_", F.lit(1)))
    order = Window.partitionBy(*keys).orderBy(F.desc("seq_"), *(F.desc(c) for c in order_cols))
    return both.withColumn("rn_", F.row_number().over(order)).filter("rn_ = 1").drop("rn_", "seq_")


def insert_if_absent(existing: DataFrame, batch: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """First writer wins: only keys that aren't there are added, the least row by ``order_cols`` of each."""
    order = Window.partitionBy(*keys).orderBy(*order_cols)
    new = batch.join(existing.select(*keys).distinct(), keys, "left_anti").withColumn("rn_", F.row_number().over(order)).filter("rn_ = 1").drop("rn_")
    return existing.unionByName(new.select(*existing.columns))


def null_only_update(existing: DataFrame, updates: DataFrame, keys: list[str], column: str, ts_col: str, start: str, end: str) -> DataFrame:
    """Fills NULLs of ``column`` in the half-open range [start, end)."""
    inside = (F.col(ts_col) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts_col) < F.lit(end).cast("timestamp_ntz"))
    joined = existing.join(updates.withColumnRenamed(column, "new_"), keys, "left")
    return joined.withColumn(column, F.when(F.col(column).isNull() & inside, F.col("new_")).otherwise(F.col(column))).drop("new_")
