"""Ingests of market documents: from landed XML to rows of the target tables, for all countries at once.

Documents have columns country (or zone, or from and to) and xml. A job returns its DataFrames by name and writes nothing;
``store`` writes one of them by its natural key and logs the run. Every value is stamped with its document's publication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import registries as rg
from ..operators import quality as ql
from ..operators import shape as sh
from ..operators import timeseries as ts
from ..sources import readers, sinks

#: Business types of the least and the most expected load.
LEAST, MOST = ("A60", "B10"), ("A61", "B11")


def _keyed(docs: DataFrame, doc_id: str) -> DataFrame:
    return docs if doc_id in docs.columns else docs.withColumn(doc_id, F.xxhash64(*docs.columns))


def filled_points(docs: DataFrame, xml_col: str = "xml", doc_id: str = "doc_id") -> DataFrame:
    """The points of documents carried on to their period's end, with ``doc_id``; ``is_published`` marks those that are stated."""
    points = readers.market_points(_keyed(docs, doc_id), xml_col).repartition(doc_id)  # a document's windows all lie in its partition
    period = Window.partitionBy(doc_id, "series_no", "period_start").orderBy("position")
    steps = F.floor((ts.seconds("period_end") - ts.seconds("period_start")) / F.col("step_s")).cast("int")
    upto = F.greatest(F.coalesce(F.col("next_") - 1, steps), F.col("position"))
    every = points.withColumn("next_", F.lead("position").over(period)).withColumn("at", F.explode(F.sequence("position", upto))).drop("next_")
    moved = ts.micros("ts") + (F.col("at") - F.col("position")) * F.col("step_s") * 1_000_000
    return every.withColumn("ts", F.timestamp_micros(moved).cast("timestamp_ntz")).withColumn("is_published", F.col("at") == F.col("position")).drop("at")


def _filled_zero(by: list[str]) -> Column:
    """A zero at an instant that ``by`` doesn't publish. Every document publishes some of its own points, so all can be judged."""
    stated = F.max("is_published").over(Window.partitionBy(*by, "ts"))
    return F.coalesce(~stated & (F.col("quantity") == 0), F.lit(False))


def without_filled_zeros(points: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Row rule: a zero that the document doesn't publish was filled in and goes; NULL and other carried values stay."""
    return points.withColumn("filled_", _filled_zero([doc_id])).filter("not filled_").drop("filled_", "is_published")


def _newest(rows: DataFrame, keys: list[str], *values: Column) -> DataFrame:
    """One row for each key: values of the latest publication, series by series."""
    return rows.groupBy(*keys).agg(*(F.max_by(v, F.struct("published_at", "doc_id", "series_no")).alias(c) for v, c in values), F.max("published_at").alias("published_at"))


def load(docs: DataFrame) -> dict[str, DataFrame]:
    """Actual load: (country, ts, load_mw, published_at), what the limits reject apart."""
    rows = _newest(without_filled_zeros(filled_points(docs)), ["country", "ts"], (F.col("quantity"), "load_mw"))
    kept, rejected = ql.validate_kind(ql.null_nan(rows, ["load_mw"]), "load_mw", "load")
    return {"rows": kept, "rejected": rejected}


def price(docs: DataFrame, countries: DataFrame) -> dict[str, DataFrame]:
    """Day-ahead price of each country: its zone's, or the mean of its zones' at the same instant. Documents are by zone."""
    zones = rg.zones_of(countries.select("country").distinct(), "country", "price")
    points = _newest(filled_points(docs), ["zone", "ts"], (F.col("quantity"), "price"))
    rows = points.join(F.broadcast(zones) if zones.count() <= 1000 else zones, "zone").groupBy("country", "ts")
    rows = rows.agg(F.avg("price").alias("price_eur_mwh"), F.count("price").alias("n_zones"), F.max("published_at").alias("published_at"))
    kept, rejected = ql.validate_kind(ql.null_nan(rows, ["price_eur_mwh"]), "price_eur_mwh", "price")
    return {"rows": kept, "rejected": rejected}


def generation(docs: DataFrame) -> dict[str, DataFrame]:
    """One document, two tables: all types, consumption netted, and the renewable ones folded, from generation alone.

    Zeros that a series doesn't publish are NULL in both. ``unmapped``: types that no column takes, with their rows.
    """
    points = filled_points(docs)
    series = ["production_type", "side"]
    long = points.withColumn("quantity", F.when(~_filled_zero(["doc_id", *series]), F.col("quantity"))).drop("is_published")
    keys = ["country", "ts"]
    long = _newest(long, [*keys, *series], (F.col("quantity"), "quantity"))
    published = long.groupBy(*keys).agg(F.max("published_at").alias("published_at"))
    net = sh.net_sides(long, [*keys, "production_type"], "side", "quantity")
    full = sh.map_wide(net, keys, "production_type", "net_value", rg.GENERATION_COLUMNS)
    renewable = sh.map_wide(long.filter("side <> 'consumption'"), keys, "production_type", "quantity", rg.RENEWABLE_COLUMNS, 0.0)
    renewable = renewable.withColumn("total_renewable_mw", sh.null_as_zero_sum(list(dict.fromkeys(rg.RENEWABLE_COLUMNS.values()))))
    names = docs.sparkSession.createDataFrame([(n,) for n in rg.GENERATION_COLUMNS], "production_type string")
    return {"generation": full.join(published, keys), "renewable": renewable.join(published, keys), "unmapped": ql.unmapped_names(long, "production_type", names)}


def load_forecast(docs: DataFrame, week_ahead: bool = False) -> dict[str, DataFrame]:
    """Day-ahead: the document's first series, inside the limits of load. Week-ahead: least, most and their middle, see ``week_ahead_bounds``."""
    if week_ahead:
        rows = week_ahead_bounds(docs)
        return {"rows": rows, "rejected": rows.limit(0)}
    points = filled_points(docs)
    first = points.withColumn("first", F.min("series_no").over(Window.partitionBy("doc_id"))).filter("series_no = first")
    rows = _newest(first, ["country", "ts"], (F.col("quantity"), "forecast_mw"))
    kept, rejected = ql.validate_kind(ql.null_nan(rows, ["forecast_mw"]), "forecast_mw", "load")
    return {"rows": kept, "rejected": rejected}


def week_ahead_bounds(docs: DataFrame) -> DataFrame:
    """(country, ts, value_min, value_max, value_mid, published_at) of the points that documents state, which are not carried on.

    A series of least or most load states that bound; one of any other type, or of none, fills what no typed series of its
    document states. A country's instant is that of its newest document as a whole.
    """
    kind = F.when(F.col("business_type").isin(*LEAST), "min").when(F.col("business_type").isin(*MOST), "max")
    points = readers.market_points(_keyed(docs, "doc_id")).withColumn("kind", kind)
    each = sh.bounds_by_precedence(points, ["country", "ts", "published_at", "doc_id"], "kind", "quantity", ["series_no", "period_start", "position"])
    newest = F.max_by(F.struct("value_min", "value_max", "value_mid", "published_at"), F.struct("published_at", "doc_id"))
    return each.groupBy("country", "ts").agg(newest.alias("b")).select("country", "ts", "b.*")


def wind_solar_forecast(docs: DataFrame) -> dict[str, DataFrame]:
    """Solar and wind columns, 0 where nothing is forecast, and their total."""
    long = _newest(filled_points(docs), ["country", "ts", "production_type"], (F.col("quantity"), "quantity"))
    rows = sh.map_wide(long.filter(F.col("production_type").isin(list(rg.FORECAST_COLUMNS))), ["country", "ts"], "production_type", "quantity", rg.FORECAST_COLUMNS, 0.0)
    return {"rows": rows.withColumn("total_mw", sh.null_as_zero_sum(list(rg.FORECAST_COLUMNS.values())))}


def flows(docs: DataFrame, borders: DataFrame) -> dict[str, DataFrame]:
    """Hourly flow of each directed border (from_country, to_country): zones added up by instant, then the hour's mean.

    Documents are by (from_zone, to_zone). Rows without a value are set apart; ``silent``: borders with no document rows.
    """
    points = _newest(filled_points(docs), ["from_zone", "to_zone", "ts"], (F.col("quantity"), "quantity"))
    sided = points.withColumn("from_country", rg.country_of(F.col("from_zone"))).withColumn("to_country", rg.country_of(F.col("to_zone")))
    keys = ["from_country", "to_country"]
    instant = sided.groupBy(*keys, "ts").agg(ts.total("quantity").alias("quantity"))
    hourly = instant.groupBy(*keys, ts.floor_to("ts", "hour").alias("ts")).agg(F.avg("quantity").alias("flow_mw"))
    good, rejected = ql.not_null_guard(hourly, [*keys, "ts", "flow_mw"])
    return {"rows": good, "rejected": rejected, "silent": borders.select(*keys).distinct().join(good.select(*keys).distinct(), keys, "left_anti")}


def net_position(docs: DataFrame, countries: DataFrame) -> dict[str, DataFrame]:
    """Hourly net position of each country from its zone's documents, without countries that would count a zone twice."""
    zones = rg.zones_of(rg.without_duplicates(countries.select("country").distinct(), "country", "net_position"), "country", "net_position")
    points = _newest(without_filled_zeros(filled_points(docs)), ["zone", "ts"], (F.col("quantity"), "quantity"))
    rows = points.join(zones, "zone").filter("quantity is not null").groupBy("country", ts.floor_to("ts", "hour").alias("ts"))
    return {"rows": rows.agg(F.avg("quantity").alias("net_position_mw"), F.max("published_at").alias("published_at"))}


def store(spark: SparkSession, rows: DataFrame, path: str, keys: list[str], ts_col: str, quality: str, written_at: str, log_path: str | None = None, log_id: str = "", rejected: DataFrame | None = None) -> int:
    """Stamps and upserts a job's rows, and logs the run's counts; an error is logged and raised again."""
    try:
        stamped = sh.stamp(rows, quality, written_at)
        n = sinks.merge_into(spark, path, stamped, keys, ts_col, ["written_at"])
    except Exception as error:
        if log_path:
            sinks.log_row(spark, log_path, log_id, path, written_at, error=str(error)[:500], done=True)
        raise
    if log_path:
        sinks.log_row(spark, log_path, log_id, path, written_at, n, rejected.count() if rejected is not None else 0, done=True)
    return n
