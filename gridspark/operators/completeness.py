"""Which months, days and series are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def month_completeness(df: DataFrame, keys: list[str], ts_col: str, expected_per_day: int = 24, unit: str = "hour", threshold: float = 0.99, skip_first: bool = True) -> DataFrame:
    """Months between a series' first and last one that hold less than ``threshold`` of their instants: MISSING or PARTIAL."""
    month = F.date_trunc("month", ts_col).cast("timestamp_ntz")
    have = df.groupBy(*keys, month.alias("month")).agg(F.countDistinct(F.date_trunc(unit, ts_col)).alias("present"))
    spine = have.groupBy(*keys).agg(F.min("month").alias("a"), F.max("month").alias("b")).select(*keys, "a", F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    spine = spine.filter("month > a") if skip_first else spine
    expected = F.dayofmonth(F.last_day("month")) * expected_per_day
    full = spine.drop("a").join(have, [*keys, "month"], "left").withColumn("present", F.coalesce("present", F.lit(0)).cast("long")).withColumn("expected", expected.cast("long"))
    return full.filter(F.col("present") < F.col("expected") * threshold).withColumn("kind", F.when(F.col("present") == 0, "MISSING").otherwise("PARTIAL"))


def missing_months(df: DataFrame, keys: list[str], ts_col: str, first: str, last: str) -> DataFrame:
    """Planned (key, month) pairs that have no row."""
    have = df.select(*keys, F.date_trunc("month", ts_col).cast("timestamp_ntz").alias("month")).distinct()
    months = F.sequence(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"), F.expr("interval 1 month"))
    return df.select(*keys).distinct().withColumn("month", F.explode(months)).join(have, [*keys, "month"], "left_anti")


def to_resume(dimension: DataFrame, df: DataFrame, key: str, ts_col: str, end: str, days: int = 7) -> DataFrame:
    """Members whose latest row is older than ``end`` minus ``days``; what was never loaded is kept."""
    last = df.groupBy(key).agg(F.max(ts_col).alias("latest"))
    limit = F.lit(end).cast("timestamp_ntz") - F.expr(f"interval {days} days")
    return dimension.join(last, key, "left").filter(F.coalesce(F.col("latest") < limit, F.lit(True)))


def snapshot(dimension: DataFrame, key: str, facts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Latest instant and count of each fact per member, each fact aggregated before it is joined; counts of 0 are kept."""
    for name, (fact, ts_col) in facts.items():
        dimension = dimension.join(fact.groupBy(key).agg(F.max(ts_col).alias(f"{name}_latest"), F.count("*").alias(f"{name}_count")), key, "left").withColumn(f"{name}_count", F.coalesce(f"{name}_count", F.lit(0)))
    return dimension


def missing_days(df: DataFrame, ts_col: str, field: str) -> DataFrame:
    """Days on which ``field`` is NULL in some rows, with their number."""
    n = F.sum(F.col(field).isNull().cast("int"))
    return df.groupBy(F.to_date(ts_col).alias("day")).agg(n.alias("missing")).filter("missing > 0")


def latest_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("rn_", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("rn_ = 1").drop("rn_")
