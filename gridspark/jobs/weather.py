"""Weather ingests from landed responses, and the zones that they are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import registries as rg
from ..operators import reports as rp
from ..operators import shape as sh
from ..operators import timeseries as ts
from ..operators import zones as zn
from ..sources import readers, sinks

#: Columns that name a snapshot: one fetch of one model for one place and hour.
SNAPSHOT = ["source", "location_id", "valid_at", "fetched_at"]


def covered_locations(spark: SparkSession, locations: DataFrame, sources: list[str]) -> DataFrame:
    """(source, position, location) of what each model is asked for: places inside its box, numbered by location_id."""
    from pyspark.sql import Window

    boxes = spark.createDataFrame([(m, *box) for m, box in rg.MODEL_BOXES.items()], "source string, lat_min double, lat_max double, lon_min double, lon_max double")
    asked = locations.withColumn("source", F.explode(F.array(*map(F.lit, sources))))
    inside = zn.inside_box(asked, boxes, "source")
    return inside.withColumn("position", F.row_number().over(Window.partitionBy("source").orderBy("location_id")) - 1)


def snapshots(responses: DataFrame, locations: DataFrame, variables: list[str]) -> dict[str, DataFrame]:
    """Hourly rows of responses (source, fetched_at, body): a body is an array by the place's position in its model's list.

    A variable's name may end in ``_previous_dayN``. ``failed``: sources whose body can't be read, which cost no other source.
    """
    registry = {v: how for v, how in rg.weather_units().items() if v in variables}
    plain = responses.withColumn("body", F.regexp_replace("body", r"_previous_day\d+\"", "\""))
    parsed = readers.hourly_arrays(plain, "body", list(registry))
    rows = parsed.join(locations.select("source", "position", "location_id"), ["source", "position"]).drop("position")
    rows = sh.convert_units(rows, registry).dropDuplicates(SNAPSHOT)
    summary = rows.groupBy("source", "fetched_at").agg(F.count("*").alias("n_rows"), F.countDistinct("location_id").alias("locations"), F.min("valid_at").alias("first_at"), F.max("valid_at").alias("last_at"))
    return {"rows": rows, "summary": summary, "failed": responses.select("source", "fetched_at").join(summary, ["source", "fetched_at"], "left_anti")}


def store_snapshots(spark: SparkSession, rows: DataFrame, path: str) -> int:
    """First writer wins: a snapshot that is there already stays as it is."""
    return sinks.merge_into(spark, path, rows, SNAPSHOT, "valid_at", ["location_id"], first_wins=True)


def multipoint(responses: DataFrame, points: DataFrame, variables: list[str]) -> DataFrame:
    """Weighted mean over a country's points by (country, kind, valid_at): ``points`` has country, kind, position and weight.

    A point without a value has no part in that variable's weights; ``n_points`` counts all points of the hour.
    """
    registry = {v: how for v, how in rg.weather_units(kelvin=True).items() if v in variables}
    rows = readers.hourly_arrays(responses, "body", list(registry)).join(points, ["country", "kind", "position"])
    keys = ["country", "kind", "valid_at"]
    w = F.col("weight")
    means = [(ts.total(F.col(v) * w) / F.nullif(ts.total(F.when(F.col(v).isNotNull(), w)), F.lit(0.0))).alias(v) for v in registry]
    return sh.convert_units(rows.groupBy(*keys).agg(*means, F.count("*").alias("n_points")), registry)


def store_multipoint(spark: SparkSession, rows: DataFrame, path: str) -> int:
    """Last writer wins for each country, kind and hour; of one batch the row of most points."""
    return sinks.merge_into(spark, path, rows, ["country", "kind", "valid_at"], "valid_at", ["n_points"])


def build_zones(plants: DataFrame, countries: DataFrame, limits: dict[str, tuple[float, float]]) -> dict[str, DataFrame]:
    """Places to ask weather for: every country's centre (country, lat, lon, name) and, by technology, clusters of its plants.

    ``limits``: {technology: (most km from a zone's centre, least MW)}. ``coverage``: plants, capacity and zones of each pair.
    """
    centres = countries.select("country", F.lit("centroid").alias("zone_id"), F.lit("centroid").alias("technology"), "lat", "lon", F.lit(1.0).alias("weight"), F.lit(None).cast("double").alias("capacity_mw"), F.concat_ws(" ", "name", F.lit("centroid")).alias("description"))
    known = plants.join(countries.select("country", F.col("name").alias("country_name")), "country")
    places, keys = centres, ["country", "technology"]
    for technology, (km, mw) in limits.items():
        zones = zn.cluster_zones(known.filter(F.col("technology") == technology), keys, "name", "lat", "lon", "capacity_mw", km, mw)
        named = zn.with_zone_id(zones, keys).join(countries.select("country", F.col("name").alias("country_name")), "country")
        text = F.format_string("%s %s cluster, %.0f MW across %d plants (radius %.0f km)", "country_name", "technology", "capacity", "n_plants", "radius_km")
        places = places.unionByName(named.select("country", "zone_id", "technology", F.col("zone_lat").alias("lat"), F.col("zone_lon").alias("lon"), F.round("weight", 4).alias("weight"), F.round("capacity", 1).alias("capacity_mw"), text.alias("description")))
    have = places.filter("technology <> 'centroid'").groupBy(*keys).agg(F.count("*").alias("zones"))
    grid = rp.coverage_grid(known, countries, "country", "technology", list(limits), "capacity_mw")
    return {"places": places, "coverage": grid.join(have, keys, "left").fillna({"zones": 0})}
