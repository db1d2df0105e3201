"""Maps from long series to fixed columns, netting, units and registries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .timeseries import number


def net_sides(df: DataFrame, keys: list[str], side_col: str, value_col: str, plus: str = "aggregated", minus: str = "consumption") -> DataFrame:
    """Signed netting: both sides a - c; one side counts the other as 0; neither is NULL."""
    a, c = (F.sum(F.when(F.col(side_col) == s, number(value_col))) for s in (plus, minus))
    grouped = df.groupBy(*keys).agg(a.alias("a"), c.alias("c"))
    net = F.when(F.col("a").isNull() & F.col("c").isNull(), None).otherwise(F.coalesce("a", F.lit(0)) - F.coalesce("c", F.lit(0)))
    return grouped.select(*keys, net.cast("double").alias("net_value"))


def prefer_aggregated(df: DataFrame, keys: list[str], side_col: str, series_col: str, minus: str = "consumption") -> DataFrame:
    """The consumption side is left out altogether, a type that has only it is gone; of several series of a type the first stays.

    ``keys`` name a type (of a document); series are not added up.
    """
    kept = df.filter(~F.lower(side_col).contains(minus))
    first = F.min(series_col).over(Window.partitionBy(*keys))
    return kept.withColumn("first_", first).filter(F.col(series_col) == F.col("first_")).drop("first_")


def map_wide(df: DataFrame, keys: list[str], name_col: str, value_col: str, mapping: dict[str, str], absent: float | None = None) -> DataFrame:
    """Names folded to fixed columns and added up. ``absent=None`` keeps "all NULL" NULL; 0.0 fills what is not reported."""
    columns = list(dict.fromkeys(mapping.values()))
    sums = []
    for column in columns:
        names = [n for n, c in mapping.items() if c == column]
        value = F.sum(F.when(F.col(name_col).isin(names), number(value_col))).cast("double")
        sums.append((value if absent is None else F.coalesce(value, F.lit(absent))).alias(column))
    return df.groupBy(*keys).agg(*sums)


def null_as_zero_sum(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, (F.coalesce(F.col(c), F.lit(0.0)) for c in columns))


def convert_units(df: DataFrame, registry: dict[str, tuple[str, float, float]]) -> DataFrame:
    """Columns named, scaled and shifted by a registry {source: (column, scale, offset)}; NULL stays NULL."""
    return df.select(*(c for c in df.columns if c not in registry), *((F.col(s) * scale + offset).alias(c) for s, (c, scale, offset) in registry.items()))


def lookup(df: DataFrame, key: str, mapping: DataFrame, map_key: str, map_value: str, out: str) -> DataFrame:
    """A value by a small map; what the map doesn't know passes through."""
    small = mapping.select(F.col(map_key).alias("k_"), F.col(map_value).alias("v_"))
    return df.join(small, F.col(key) == F.col("k_"), "left").withColumn(out, F.coalesce("v_", key)).drop("k_", "v_")


def min_max_envelope(df: DataFrame, keys: list[str], kind_col: str, value_col: str) -> DataFrame:
    """Lower and upper bounds and their midpoint; a bound that is missing takes the other's value."""
    low, high = (F.max(F.when(F.col(kind_col) == k, number(value_col))).cast("double") for k in ("min", "max"))
    both = df.groupBy(*keys).agg(low.alias("lo"), high.alias("hi"))
    lo, hi = F.coalesce("lo", "hi"), F.coalesce("hi", "lo")
    return both.select(*keys, lo.alias("value_min"), hi.alias("value_max"), ((lo + hi) / 2).alias("value_mid"))


def bounds_by_precedence(df: DataFrame, keys: list[str], kind_col: str, value_col: str, order_cols: list[str]) -> DataFrame:
    """Lower and upper bounds of each key from series of kind "min", "max" or none, and their midpoint, as in ``min_max_envelope``.

    A typed series states its bound whatever else there is, the last one by ``order_cols`` if several do; an untyped one fills
    the bounds that no typed series states, the first one if several could.
    """
    place, value, kind = F.struct(*order_cols), number(value_col), F.col(kind_col)
    typed = lambda k: F.max_by(value, F.when((kind == k) & value.isNotNull(), place))
    untyped = F.min_by(value, F.when(kind.isNull() & value.isNotNull(), place))
    found = df.groupBy(*keys).agg(typed("min").alias("min_"), typed("max").alias("max_"), untyped.alias("fill_"))
    filled = found.select(*keys, F.explode(F.array(*(F.struct(F.lit(k).alias("kind_"), F.coalesce(f"{k}_", "fill_").alias("value_")) for k in ("min", "max")))).alias("b"))
    return min_max_envelope(filled.select(*keys, "b.*"), keys, "kind_", "value_").filter("value_mid is not null")


def stamp(df: DataFrame, quality: str, written_at: str) -> DataFrame:
    """Provenance; the write time is a parameter, so that a run can be repeated."""
    return df.withColumn("quality", F.lit(quality)).withColumn("written_at", F.lit(written_at).cast("timestamp_ntz"))
