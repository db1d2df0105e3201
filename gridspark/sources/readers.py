"""Landed documents to rows: market XML, hourly weather arrays, CSV archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.registries import production_type

_POINT = "struct<position:int,quantity:double>"
_PERIOD = f"struct<timeInterval:struct<start:string,end:string>,resolution:string,Point:array<{_POINT}>>"
_DOMAIN = "`outBiddingZone_Domain.mRID`:string"
DOCUMENT = f"createdDateTime string, TimeSeries array<struct<businessType:string,MktPSRType:struct<psrType:string>,{_DOMAIN},Period:array<{_PERIOD}>>>"


def duration_seconds(text: Column) -> Column:
    """Seconds of an ISO duration of days, hours, minutes and seconds; NULL if it isn't one or is zero."""
    t = F.trim(text)
    part = lambda unit: F.coalesce(F.regexp_extract(t, unit, 1).try_cast("bigint"), F.lit(0))
    n = part(r"^P(\d+)D") * 86400 + part(r"T(?:.*?)(\d+)H") * 3600 + part(r"T(?:.*?)(\d+)M") * 60 + part(r"T(?:.*?)(\d+)S")
    return F.when(t.rlike(r"^P(?:\d+D)?(?:T(?:\d+H)?(?:\d+M)?(?:\d+S)?)?$"), F.nullif(n, F.lit(0)))


def instant(text: Column) -> Column:
    """A timestamp with or without seconds, with an offset or Z; NULL if it can't be read."""
    return F.regexp_replace(text, r"T(\d\d:\d\d)(Z|[+-]\d\d:?\d\d)?$", "T$1:00$2").try_cast("timestamp")


def market_points(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One row per published point: ts = start + (position - 1) x resolution. What can't be read is left out, never guessed."""
    bare = F.regexp_replace(F.col(xml_col), r"\sxmlns(:\w+)?=\"[^\"]*\"", "")
    others = [c for c in df.columns if c != xml_col]
    doc = df.select(*others, F.explode(F.array(F.from_xml(bare, DOCUMENT, {"mode": "PERMISSIVE"}))).alias("doc_"))  # parsed once, not once a field
    series = doc.select(*others, instant(F.col("doc_.createdDateTime")).alias("published_at"), F.posexplode("doc_.TimeSeries").alias("series_no", "s"))
    code = F.col("s.MktPSRType.psrType")
    periods = series.select(*others, "published_at", "series_no", F.col("s.businessType").alias("business_type"), production_type(code).alias("production_type"), F.when(F.col("s.`outBiddingZone_Domain.mRID`").isNotNull(), "consumption").otherwise("aggregated").alias("side"), F.explode("s.Period").alias("p"))
    start = instant(F.col("p.timeInterval.start"))
    points = periods.withColumn("start_", start).withColumn("end_", instant(F.col("p.timeInterval.end"))).withColumn("step_s", duration_seconds(F.col("p.resolution"))).select(*others, "published_at", "series_no", "business_type", "production_type", "side", "start_", "end_", "step_s", F.explode("p.Point").alias("pt"))
    ts = F.timestamp_seconds(F.unix_seconds("start_") + (F.col("pt.position") - 1) * F.col("step_s"))
    return points.filter("pt.position >= 1 and start_ is not null and step_s is not null").select(*others, "published_at", "series_no", "business_type", "production_type", "side", "step_s", F.col("start_").cast("timestamp_ntz").alias("period_start"), F.col("end_").cast("timestamp_ntz").alias("period_end"), F.col("pt.position").alias("position"), ts.cast("timestamp_ntz").alias("ts"), F.col("pt.quantity").alias("quantity"))


def hourly_arrays(df: DataFrame, responses_col: str, variables: list[str]) -> DataFrame:
    """JSON array of responses to rows (position in the array, valid_at, variables); arrays that are missing or short give NULL."""
    fields = ",".join(f"`{v}`:array<double>" for v in variables)
    parsed = F.from_json(responses_col, f"array<struct<hourly:struct<time:array<string>,{fields}>>>")
    rows = df.select(*(c for c in df.columns if c != responses_col), F.posexplode(parsed).alias("position", "r"))
    zipped = F.arrays_zip("r.hourly.time", *(F.coalesce(f"r.hourly.{v}", F.array().cast("array<double>")) for v in variables))
    kind = "array<struct<" + ",".join(["time:string", *(f"`{v}`:double" for v in variables)]) + ">>"
    hours = rows.withColumn("h", F.explode(zipped.cast(kind))).drop("r")
    return hours.filter("h.time is not null").select("*", instant(F.col("h.time")).cast("timestamp_ntz").alias("valid_at"), *(F.col(f"h.{v}").alias(v) for v in variables)).drop("h")


def hourly_rows(df: DataFrame, responses_col: str, locations: DataFrame, variables: dict[str, str]) -> DataFrame:
    """JSON array of responses, one for each location by position, to a row per location and hour.

    Responses beyond the locations and responses without times give nothing.
    """
    return hourly_arrays(df, responses_col, list(variables)).join(locations, "position").drop("position").withColumnsRenamed(variables)


def single_point_rows(df: DataFrame, response_col: str, registry: dict[str, tuple[str, float, float]]) -> DataFrame:
    """A JSON response for one place and run to a row per hour, units by the registry {variable: (column, scale, offset)}."""
    from ..operators.shape import convert_units

    whole = df.withColumn("body_", F.concat(F.lit("["), F.col(response_col), F.lit("]"))).drop(response_col)
    place = df.sparkSession.createDataFrame([(0,)], "position int")
    return convert_units(hourly_rows(whole, "body_", place, {v: v for v in registry}), registry)


def archive_rows(spark, path: str, zones: DataFrame, registry: dict[str, tuple[str, float, float]], time_col: str = "time", zone_col: str = "zone_id") -> DataFrame:
    """CSV archives named weather_nwp[_model]_dayN_zones_FROM_TO.csv: of each model and lead the file of the widest span, full hours
    and known zones only, columns and units by the registry; ``fetched_at`` is when the file was written."""
    from ..operators.shape import convert_units
    from ..operators.timeseries import decimate

    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    part = lambda k: F.regexp_extract(name, r"^weather_nwp_(?:(.+)_)?day(\d+)_zones_", k)
    raw = spark.read.option("header", True).csv(path).select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("fetched_at"), F.coalesce(F.nullif(part(1), F.lit("")), F.lit("best_match")).alias("model"), part(2).try_cast("int").alias("lead"))
    widest = widest_files(raw.filter("lead is not null").select("model", "lead", "path").distinct(), ["model", "lead"])
    rows = raw.join(widest.select("path"), "path", "left_semi").withColumn("valid_at", instant(F.col(time_col)).cast("timestamp_ntz"))
    rows = decimate(rows, "valid_at").join(zones, zone_col)
    known = {v: how for v, how in registry.items() if v in raw.columns}
    return convert_units(rows.withColumns({v: F.col(v).try_cast("double") for v in known}), known).drop(time_col, "path")


def plants(wind: DataFrame, solar: DataFrame, names: DataFrame) -> DataFrame:
    """Two plant registries as one (country, technology, capacity_mw, lat, lon, name): operating plants of known countries.

    Registries have columns status, country, capacity_mw, lat, lon, name, the wind one installation too; ``names``: (country, iso).
    """
    from ..operators.zones import clean_coordinates, wind_technology

    kinds = wind.withColumn("technology", F.concat(F.lit("wind_"), wind_technology(F.col("installation")))).unionByName(solar.withColumn("technology", F.lit("solar")), allowMissingColumns=True)
    known = kinds.filter((F.lower("status") == "operating") & F.col("technology").isNotNull()).join(names, "country")
    return clean_coordinates(known, "lat", "lon", "capacity_mw").select(F.col("iso").alias("country"), "technology", "capacity_mw", "lat", "lon", "name")


def widest_files(df: DataFrame, group_cols: list[str], path_col: str = "path") -> DataFrame:
    """Of each group's files the one whose name has the widest span of dates."""
    from ..operators.completeness import latest_per_key

    day = lambda k: F.expr(f"try_to_date(regexp_extract({path_col}, '(\\\\d{{4}}-\\\\d{{2}}-\\\\d{{2}})_(\\\\d{{4}}-\\\\d{{2}}-\\\\d{{2}})', {k}))")
    return latest_per_key(df.withColumn("span", F.datediff(day(2), day(1))), group_cols, [F.desc("span"), path_col])
