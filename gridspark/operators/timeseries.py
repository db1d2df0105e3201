"""Resampling, gaps, islands and intervals of keyed time series. ``keys`` are column names; NULL is "not reported", never 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def micros(ts: str | Column) -> Column:
    """Epoch microseconds of a timestamp with or without time zone (the session's zone is UTC)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def seconds(ts: str | Column) -> Column:
    return micros(ts) / F.lit(1_000_000)


def floor_to(ts: str | Column, unit: str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def number(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def total(value: str | Column) -> Column:
    """The sum as a double: of doubles as they are, of decimals exact."""
    return F.sum(number(value)).cast("double")


def mean(value: str | Column) -> Column:
    return total(value) / F.count(value)


def resample_mean(df: DataFrame, keys: list[str], ts_col: str, value_col: str, unit: str = "hour") -> DataFrame:
    """Mean per key and hour. Hours without a value are absent, not zero."""
    return df.filter(F.col(value_col).isNotNull()).groupBy(*keys, floor_to(ts_col, unit).alias("ts")).agg(mean(value_col).alias("mean_value"), F.count("*").alias("n"))


def gap_counts(hourly: DataFrame, keys: list[str], ts_col: str = "ts") -> DataFrame:
    """Hours between each series' first and last hour that have no row."""
    span = (seconds(F.max(ts_col)) - seconds(F.min(ts_col))) / 3600 + 1
    return hourly.groupBy(*keys).agg(F.count("*").alias("hours"), (span.cast("long") - F.count("*")).alias("gaps"))


def sum_then_mean(df: DataFrame, keys: list[str], ts_col: str, value_col: str) -> DataFrame:
    """Values of one instant are added up (zones of a country) before the hourly mean is taken."""
    instant = df.filter(F.col(value_col).isNotNull()).groupBy(*keys, floor_to(ts_col, "minute").alias("at")).agg(total(value_col).alias("s"))
    return instant.groupBy(*keys, floor_to("at", "hour").alias("ts")).agg(mean("s").alias("mean_value"))


def group_mean(df: DataFrame, keys: list[str], value_col: str) -> DataFrame:
    """Mean over the members that are there (a country's price from its zones)."""
    return df.groupBy(*keys).agg(mean(value_col).alias("mean_value"))


def weighted_mean(df: DataFrame, keys: list[str], value_col: str, weight_col: str) -> DataFrame:
    """Sum of v * w over the sum of w where v is there; ``n_points`` counts the rows without v too."""
    v, w = F.col(value_col), F.col(weight_col)
    weight = total(F.when(v.isNotNull(), w))
    return df.groupBy(*keys).agg((total(v * w) / F.nullif(weight, F.lit(0.0))).alias("weighted"), F.count("*").alias("n_points"))


def collapse_duplicates(df: DataFrame, keys: list[str], value_col: str) -> DataFrame:
    """Duplicates of a key added up: all NULL stays NULL in ``kept_null``, and is 0 in ``zero_filled``."""
    return df.groupBy(*keys).agg(total(value_col).alias("kept_null"), F.coalesce(total(value_col), F.lit(0.0)).alias("zero_filled"))


def gaps(df: DataFrame, keys: list[str], ts_col: str, min_gap_seconds: float) -> DataFrame:
    """Pairs of successive instants more than ``min_gap_seconds`` apart (strictly). What has no next row is no gap."""
    order = Window.partitionBy(*keys).orderBy(ts_col)
    distinct = df.select(*keys, ts_col).distinct().withColumn("next_seen", F.lead(ts_col).over(order))
    return distinct.withColumn("gap_seconds", (micros("next_seen") - micros(ts_col)) / 1_000_000).filter(F.col("gap_seconds") > min_gap_seconds).withColumnRenamed(ts_col, "last_seen")


def time_range(df: DataFrame, ts_col: str, low: str, high: str) -> DataFrame:
    """Inclusive range; a bare date starts at 00:00:00 and ends at 23:59:59."""
    full = lambda s, end: s.replace("T", " ") if len(s) > 10 else f"{s} {end}"
    return df.filter(F.col(ts_col).between(F.lit(full(low, "00:00:00")).cast("timestamp_ntz"), F.lit(full(high, "23:59:59")).cast("timestamp_ntz")))


def merge_intervals(df: DataFrame, keys: list[str], start_col: str, end_col: str, slack_days: int = 1) -> DataFrame:
    """Intervals that overlap or lie at most ``slack_days`` apart become one."""
    order = Window.partitionBy(*keys).orderBy(start_col, end_col)
    before = F.max(end_col).over(order.rowsBetween(Window.unboundedPreceding, -1))
    flagged = df.withColumn("new", F.coalesce(F.col(start_col) > before + F.expr(f"interval {slack_days} day"), F.lit(True)).cast("int"))
    grouped = flagged.withColumn("g", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*keys, "g").agg(F.min(start_col).alias("start_at"), F.max(end_col).alias("end_at"), F.count("*").alias("merged")).drop("g")


def day_islands(df: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """Runs of consecutive days."""
    days = df.select(*keys, F.to_date(ts_col).alias("d")).distinct()
    island = F.date_sub("d", F.row_number().over(Window.partitionBy(*keys).orderBy("d")))
    return days.withColumn("i", island).groupBy(*keys, "i").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count("*").alias("days")).drop("i")


def null_day_ranges(df: DataFrame, keys: list[str], ts_col: str, marker_col: str) -> DataFrame:
    """Per day with NULL markers the range to fetch again: first instant to an hour after the last."""
    bad = df.filter(F.col(marker_col).isNull())
    return bad.groupBy(*keys, F.to_date(ts_col).alias("day")).agg(F.min(ts_col).alias("from_ts"), (F.max(ts_col) + F.expr("interval 1 hour")).alias("to_ts"), F.count("*").alias("n"))


def expand_steps(points: DataFrame, keys: list[str], ts_col: str, value_col: str) -> DataFrame:
    """Sparse step function to its hourly grid: the last value is carried on; hours before the first point don't exist."""
    grid = points.groupBy(*keys).agg(F.min(ts_col).alias("a"), F.max(ts_col).alias("b")).select(*keys, F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias(ts_col))
    order = Window.partitionBy(*keys).orderBy(ts_col).rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(points, [*keys, ts_col], "left").withColumn("is_point", F.col(value_col).isNotNull()).withColumn(value_col, F.last(value_col, ignorenulls=True).over(order))


def decimate(df: DataFrame, ts_col: str) -> DataFrame:
    return df.filter(F.minute(ts_col) == 0)


def rank_and_share(df: DataFrame, keys: list[str], value_col: str, tie_col: str) -> DataFrame:
    by = Window.partitionBy(*keys)
    return df.withColumn("rank_in_group", F.row_number().over(by.orderBy(F.desc(value_col), tie_col))).withColumn("share", F.col(value_col).cast("double") / F.sum(value_col).over(by).cast("double"))


def inclusive_chunks(df: DataFrame, start_col: str, end_col: str, days: int = 7) -> DataFrame:
    """Pieces of whole days of each [start, end] row of dates, ``days`` days at most, both ends included: the next starts a day later."""
    starts = F.sequence(F.to_date(start_col), F.to_date(end_col), F.expr(f"interval {days} days"))
    ordered = df.filter(F.to_date(start_col) <= F.to_date(end_col))
    return ordered.withColumn("chunk_start", F.explode(starts)).withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), F.to_date(end_col)))


def chunks(df: DataFrame, start_col: str, end_col: str, days: int = 90) -> DataFrame:
    """Half-open pieces of at most ``days`` days of each [start, end) row."""
    starts = F.sequence(start_col, F.col(end_col) - F.expr("interval 1 microsecond"), F.expr(f"interval {days} days"))
    return df.withColumn("chunk_start", F.explode(starts)).withColumn("chunk_end", F.least(F.col("chunk_start") + F.expr(f"interval {days} days"), F.col(end_col)))
