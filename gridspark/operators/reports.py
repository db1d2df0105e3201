"""Reports over facts and dimensions: counts, coverage grids, skill of forecasts, shares and lookups by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .timeseries import number, seconds, total


def range_summary(df: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """Rows, first and last instant, and distinct months of each key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(ts_col).alias("first_at"), F.max(ts_col).alias("last_at"), F.countDistinct(F.date_trunc("month", ts_col)).alias("months"))


def source_counts(df: DataFrame, keys: list[str], ts_col: str, value_col: str, since: str) -> DataFrame:
    """Rows, first and last instant and mean of each source since an instant."""
    recent = df.filter(F.col(ts_col) >= F.lit(since).cast("timestamp_ntz"))
    return recent.groupBy(*keys).agg(F.count("*").alias("n"), F.min(ts_col).alias("first_at"), F.max(ts_col).alias("last_at"), (total(value_col) / F.count(value_col)).alias("mean_value"))


def coverage_grid(df: DataFrame, dimension: DataFrame, key: str, kind_col: str, kinds: list[str], value_col: str) -> DataFrame:
    """Every member of a dimension with every kind of a fixed list, zero-filled counts and sums."""
    have = df.groupBy(key, kind_col).agg(F.count("*").alias("n"), total(value_col).alias("value_sum"))
    grid = dimension.select(key).distinct().withColumn(kind_col, F.explode(F.array(*map(F.lit, kinds))))
    return grid.join(have, [key, kind_col], "left").fillna({"n": 0, "value_sum": 0.0})


def run_accounting(df: DataFrame, pass_cols: list[str], id_col: str, ts_col: str, order_cols: list[str], rows_col: str) -> DataFrame:
    """Runs, log rows, wall clock and the amount that each run's latest log row states, by pass. A run's rows add up before passes do."""
    latest = F.max_by(number(rows_col), F.struct(ts_col, *order_cols))
    runs = df.groupBy(*pass_cols, id_col).agg(F.count("*").alias("k"), F.min(ts_col).alias("a"), F.max(ts_col).alias("b"), latest.alias("v"))
    wall = seconds(F.max("b")) - seconds(F.min("a"))
    return runs.groupBy(*pass_cols).agg(F.count("*").alias("runs"), F.sum("k").alias("n_rows"), F.min("a").alias("first_at"), F.max("b").alias("last_at"), wall.alias("wall_seconds"), F.sum("v").cast("double").alias("latest_total"))


def pair_ratio(df: DataFrame, ts_col: str, num: str, den: str, split: str) -> DataFrame:
    """Ratio of two paired sums on either side of a split; rows without an instant are counted, and left out."""
    at = F.lit(split).cast("timestamp_ntz")
    ratio = lambda side: F.sum(F.when(side, number(num))).cast("double") / F.nullif(F.sum(F.when(side, number(den))).cast("double"), F.lit(0.0))
    before, after = F.col(ts_col) < at, F.col(ts_col) >= at
    sums = df.agg(F.count(ts_col).alias("n"), F.count_if(F.col(ts_col).isNull()).alias("excluded"), ratio(before).alias("ratio_before"), ratio(after).alias("ratio_after"))
    return sums.withColumn("effect", F.col("ratio_after") / F.nullif("ratio_before", F.lit(0.0)))


def surrogate_rate(df: DataFrame, keys: list[str], a: str, b: str, tolerance: float) -> DataFrame:
    """Share of common instants at which two sources say the same: near 1 means that one stands in for the other."""
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.groupBy(*keys).agg(F.count("*").alias("n"), F.avg((F.abs(F.col(a) - F.col(b)) < tolerance).cast("int")).alias("share_equal"))


def _errors(error: Column, name: str = "") -> list[Column]:
    n = F.count(error)
    return [n.alias(f"n{name}"), (F.sum(F.abs(error)).cast("double") / n).alias(f"mae{name}"), F.sqrt(F.sum(error * error).cast("double") / n).alias(f"rmse{name}"), (F.sum(error).cast("double") / n).alias(f"bias{name}")]


def skill(df: DataFrame, keys: list[str], forecast: Column, truth: Column, threshold: float = 0.0) -> DataFrame:
    """MAE, RMSE and bias (forecast - truth) where the truth is above a threshold."""
    return df.filter(truth > threshold).groupBy(*keys).agg(*_errors(forecast - truth))


def naive_skill(hourly: DataFrame, keys: list[str], ts_col: str, value_col: str) -> DataFrame:
    """Errors of the two naive forecasts, the hour before and the same hour a day before; an absent hour is no forecast."""
    by_hour = Window.partitionBy(*keys).orderBy("hour_")
    at = lambda h: F.max("v_").over(by_hour.rangeBetween(-h, -h))
    rows = hourly.select(*keys, F.floor(seconds(ts_col) / 3600).alias("hour_"), F.col(value_col).alias("v_"))
    errors = rows.select(*keys, (at(1) - F.col("v_")).alias("e1"), (at(24) - F.col("v_")).alias("e24"))
    return errors.groupBy(*keys).agg(*_errors(F.col("e1"), "_previous"), *_errors(F.col("e24"), "_seasonal"))


def forecast_metrics(hourly: DataFrame, keys: list[str], ts_col: str, truth_col: str, forecast_col: str, season: int = 24) -> DataFrame:
    """Errors of a forecast, and against the two naive ones where those exist: MAPE leaves out zero truths, MASE scales by the
    seasonal naive error, direction compares the signs of both changes since the hour before, skill is 1 - MAE / naive MAE."""
    by_hour = Window.partitionBy(*keys).orderBy("hour_")
    before = lambda h: F.max("y_").over(by_hour.rangeBetween(-h, -h))
    rows = hourly.select(*keys, F.floor(seconds(ts_col) / 3600).alias("hour_"), F.col(truth_col).alias("y_"), F.col(forecast_col).alias("f_"))
    rows = rows.withColumn("y1_", before(1)).withColumn("ys_", before(season))
    y, f, e = F.col("y_"), F.col("f_"), F.abs(F.col("f_") - F.col("y_"))
    persistence, seasonal = F.abs(y - F.col("y1_")), F.abs(y - F.col("ys_"))
    same_way = (F.signum(f - F.col("y1_")) == F.signum(y - F.col("y1_"))).cast("int")
    skill_against = lambda naive: 1 - F.avg(F.when(naive.isNotNull(), e)) / F.nullif(F.avg(F.when(e.isNotNull(), naive)), F.lit(0.0))
    return rows.groupBy(*keys).agg(
        F.count(e).alias("n"), F.avg(e).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (100 * F.avg(F.when(y != 0, e / F.abs(y)))).alias("mape"), (100 * F.avg(2 * e / F.nullif(F.abs(y) + F.abs(f), F.lit(0.0)))).alias("smape"),
        (F.avg(e) / F.nullif(F.avg(seasonal), F.lit(0.0))).alias("mase"), (100 * F.avg(same_way)).alias("direction"),
        skill_against(persistence).alias("skill_persistence"), skill_against(seasonal).alias("skill_seasonal"),
    )


def share_ranking(df: DataFrame, keys: list[str], part: Column, value_col: str) -> DataFrame:
    """Share of the rows that ``part`` marks in each key's total, and its rank among all keys (a few, after the aggregation)."""
    share = F.coalesce(F.sum(F.when(part, number(value_col))).cast("double"), F.lit(0.0)) / F.nullif(total(value_col), F.lit(0.0))
    return df.groupBy(*keys).agg(share.alias("share")).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("share"), *keys)))


def resolve(asked: DataFrame, name_col: str, dimension: DataFrame, key_col: str) -> tuple[DataFrame, DataFrame]:
    """(names with their keys, names that the dimension doesn't know)."""
    known = dimension.select(name_col, key_col)
    return asked.join(known, name_col), asked.join(known, name_col, "left_anti")


def resolved(asked: DataFrame, keys: list[str], dimension: DataFrame, value_col: str) -> DataFrame:
    """``asked`` with ``value_col`` of the dimension by natural key. A key that the dimension doesn't know fails the job, by its name.

    The failure is part of the plan: a complete batch costs the join and nothing else.
    """
    known = dimension.select(*keys, value_col).withColumn("known_", F.lit(True))
    said = F.concat(F.lit(f"no {value_col} for ("), F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys)), F.lit(")"))
    return asked.join(known, keys, "left").withColumn(value_col, F.when(F.col("known_"), F.col(value_col)).otherwise(F.raise_error(said).cast(dimension.schema[value_col].dataType))).drop("known_")


def grouped_with_whole(df: DataFrame, keys: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """Aggregates of each group and of the whole in one pass, by grouping sets; ``is_whole`` marks the row over all groups."""
    sets = df.groupingSets([[F.col(k) for k in keys], []], *(F.col(k) for k in keys))
    return sets.agg((F.grouping_id() > 0).alias("is_whole"), *(c.alias(n) for n, c in aggregates.items()))


def coverage_document(members: DataFrame, facts: DataFrame, key: str, name_col: str, kind_col: str, kinds: list[str], value_col: str, zones_col: str, fallback_col: str) -> DataFrame:
    """A nested document for each member: its name, and of each kind how many, their total, the zones and whether they fell back.

    ``facts`` holds a row for each plant or zone: a plant has a value, a zone has ``zones_col``; a kind fell back if its only
    zone is the one that stands for the whole member (``fallback_col``). Kinds without a row are 0 and false.
    """
    zone = F.col(zones_col).isNotNull()
    per = facts.groupBy(key, kind_col).agg(
        F.count_if(~zone).alias("n_plants"), F.round(F.coalesce(F.sum(F.when(~zone, F.col(value_col))).cast("double"), F.lit(0.0)), 1).alias("total_capacity_mw"),
        F.count_if(zone).alias("chosen_k"), (F.coalesce((F.count_if(zone) == 1) & F.bool_or(F.when(zone, F.col(fallback_col))), F.lit(False))).alias("fell_back_to_country"),
    )
    entry = F.struct("n_plants", "total_capacity_mw", "chosen_k", "fell_back_to_country")
    held = per.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.col(kind_col), entry))).alias("m_"))  # a row for each kind
    none = F.struct(F.lit(0).cast("long").alias("n_plants"), F.lit(0.0).alias("total_capacity_mw"), F.lit(0).cast("long").alias("chosen_k"), F.lit(False).alias("fell_back_to_country"))
    every = F.map_from_arrays(F.array(*map(F.lit, kinds)), F.array(*(F.coalesce(F.try_element_at("m_", F.lit(k)), none) for k in kinds)))
    return members.select(key, name_col).join(held, key, "left").select(key, F.col(name_col).alias("name"), every.alias("kinds"))


def request_batches(df: DataFrame, keys: list[str], order_col: str, size: int = 50) -> DataFrame:
    """Requests of at most ``size`` members of each key, in order: (keys, batch, members)."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order_col)) - 1
    numbered = df.select(*keys, F.col(order_col).alias("m_"), F.floor(place / size).alias("batch"))
    return numbered.groupBy(*keys, "batch").agg(F.sort_array(F.collect_list("m_")).alias("members"))  # at most ``size``


def border_requests(countries: DataFrame, zones: DataFrame, edges: DataFrame) -> DataFrame:
    """(country, neighbour): the zones that border on a country's zones, each once.

    ``zones`` (country, zone): a country without a row is its own zone; ``edges`` (a, b): zones that border on each other,
    stated in either direction.
    """
    own = countries.select("country").distinct().join(zones.select("country", "zone"), "country", "left").select("country", F.coalesce("zone", "country").alias("zone"))
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    return own.join(both, own["zone"] == both["a"]).select("country", F.col("b").alias("neighbour")).distinct()


def completeness_document(df: DataFrame, dimension: DataFrame, key: str, ts_col: str) -> DataFrame:
    """One JSON document per member: has_data, record_count, present of expected days between its first and last, and both."""
    days = F.datediff(F.max(ts_col), F.min(ts_col)) + 1
    have = df.groupBy(key).agg(F.count("*").alias("record_count"), (100.0 * F.countDistinct(F.to_date(ts_col)) / days).alias("completeness"), F.min(ts_col).alias("earliest"), F.max(ts_col).alias("latest"))
    full = dimension.join(have, key, "left").fillna({"record_count": 0, "completeness": 0.0})
    document = F.struct((F.col("record_count") > 0).alias("has_data"), "record_count", "completeness", "earliest", "latest")
    return full.select(*dimension.columns, F.to_json(document).alias("document"))


def union_by_name(sources: dict[str, DataFrame]) -> DataFrame:
    """Frames aligned by column name under the name of their source; what a frame lacks is NULL."""
    named = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    out = named[0]
    for df in named[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def filter_dimension(df: DataFrame, key: str, excluded: list, flagged: list, keep: Column) -> DataFrame:
    """Members that ``keep`` holds for and no list excludes, those of the second list flagged, in the order of the key."""
    return df.filter(keep & ~F.col(key).isin(excluded)).withColumn("is_flagged", F.col(key).isin(flagged)).orderBy(key)
