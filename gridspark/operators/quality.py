"""Validation, guards and the rules for zeros that nobody published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Accepted ranges by kind of series.
LIMITS = {"load": (0.0, 100_000.0), "price": (-500.0, 3000.0), "renewable": (0.0, 50_000.0)}


def null_nan(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN to NULL, at ingest: left in, it would poison every aggregate."""
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in columns})


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def validate_range(df: DataFrame, value_col: str, low: float | None, high: float | None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): inclusive limits, NULL is rejected; without limits everything passes."""
    if low is None or high is None:
        return df, df.limit(0)
    ok = F.coalesce(F.col(value_col).between(low, high), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def validate_kind(df: DataFrame, value_col: str, kind: str) -> tuple[DataFrame, DataFrame]:
    return validate_range(df, value_col, *LIMITS.get(kind, (None, None)))


def has_all(columns: list[str]) -> Column:
    """Whether none of the columns is NULL."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns), F.lit(True))


def not_null_guard(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): a row with a NULL in a required column is set aside, never filled and never fatal."""
    good = has_all(columns)
    return df.filter(good), df.filter(~good)


def _unpublished_zero(published: Column, value: Column, by: list[str]) -> Column:
    """A zero at an instant the document doesn't publish; False throughout a document (or series) that publishes none of them."""
    readable = F.max(published.cast("int")).over(Window.partitionBy(*by)) == 1
    return F.coalesce(readable & ~published & (value == 0), F.lit(False))


def _flagged(df: DataFrame, published: DataFrame, on: list[str]) -> DataFrame:
    marks = published.select(*on).distinct().withColumn("is_published", F.lit(True))
    return df.join(marks, on, "left").withColumn("is_published", F.coalesce("is_published", F.lit(False)))


def drop_unpublished_zeros(df: DataFrame, published: DataFrame, doc_col: str, ts_col: str, value_col: str) -> DataFrame:
    """Row rule: drops zeros that the document doesn't publish. NULL, negatives, other values and published zeros stay.

    A document that publishes none of the rows' instants (unreadable, empty, another grid) loses nothing.
    """
    rows = _flagged(df, published, [doc_col, ts_col])
    return rows.withColumn("drop_", _unpublished_zero(F.col("is_published"), F.col(value_col), [doc_col])).filter("not drop_").drop("drop_", "is_published")


def blank_unpublished_zeros(df: DataFrame, published: DataFrame, doc_col: str, series_cols: list[str], ts_col: str, value_col: str) -> DataFrame:
    """Cell rule, per series: such zeros become NULL and the row stays."""
    by = [doc_col, *series_cols]
    rows = _flagged(df, published, [*by, ts_col])
    blank = _unpublished_zero(F.col("is_published"), F.col(value_col), by)
    return rows.withColumn("blanked", blank).withColumn(value_col, F.when(F.col("blanked"), None).otherwise(F.col(value_col))).drop("is_published")


def unmapped_names(df: DataFrame, name_col: str, mapping: DataFrame) -> DataFrame:
    """Names that a map doesn't know, with their rows: they are reported, never lost in silence."""
    return df.join(mapping.select(name_col), name_col, "left_anti").groupBy(name_col).agg(F.count("*").alias("n_rows"))


def drift(left: DataFrame, right: DataFrame, keys: list[str], sides: tuple[str, str] = ("left_only", "right_only")) -> DataFrame:
    """What only one of two dimensions holds, and which."""
    a, b = left.select(*keys), right.select(*keys)
    return a.exceptAll(b).withColumn("side", F.lit(sides[0])).unionByName(b.exceptAll(a).withColumn("side", F.lit(sides[1])))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(df: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    return df.join(dimension.select(F.col(dimension_key).alias(key)).distinct(), key, "left_anti")


def totals_off(df: DataFrame, total_col: str, parts: list[str], tolerance: float = 0.1) -> DataFrame:
    """Rows whose total differs from the sum of its parts, NULL parts as 0, by more than the tolerance."""
    parts_sum = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in parts), F.lit(0.0))
    return df.withColumn("parts_sum", parts_sum).filter(F.abs(F.col(total_col) - F.col("parts_sum")) > tolerance)


def negatives(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, least) of columns that hold negative values, in one pass."""
    counts = df.agg(*(F.struct(F.lit(c).alias("column"), F.count_if(F.col(c) < 0).alias("n"), F.min(c).cast("double").alias("least")).alias(f"c{k}") for k, c in enumerate(columns)))
    return counts.select(F.explode(F.array(*(f"c{k}" for k in range(len(columns))))).alias("x")).select("x.*").filter("n > 0")


#: The tables that may be read by name.
TABLES = frozenset("energy_load energy_price energy_generation energy_renewable energy_load_forecast energy_generation_forecast crossborder_flows net_position weather_observation weather_data data_ingestion_log".split())


def allowed_table(name: str, tables: frozenset[str] = TABLES) -> str:
    """The name, if a registry of tables has it; anything else (a path, a query, another spelling) is an error."""
    if name not in tables:
        raise ValueError(f"unknown table: {name!r}")
    return name


def drop_null_marker(df: DataFrame, marker_col: str) -> DataFrame:
    return df.filter(F.col(marker_col).isNotNull())
