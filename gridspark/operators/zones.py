"""Geography: distances, coverage, plant classification and capacity-weighted zones."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(a))


def clean_coordinates(df: DataFrame, lat: str, lon: str, capacity: str) -> DataFrame:
    return df.filter(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180) & (F.col(capacity) > 0))


def inside_box(df: DataFrame, boxes: DataFrame, key: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points inside their key's inclusive box (lat_min, lat_max, lon_min, lon_max); a key without a box passes everything."""
    joined = df.join(boxes, key, "left")
    inside = F.col(lat).between(F.col("lat_min"), F.col("lat_max")) & F.col(lon).between(F.col("lon_min"), F.col("lon_max"))
    return joined.filter(F.col("lat_min").isNull() | inside).drop("lat_min", "lat_max", "lon_min", "lon_max")


def wind_technology(text: Column) -> Column:
    t = F.lower(F.trim(text))
    return F.when(t == "onshore", "onshore").when(t.startswith("offshore"), "offshore")


def _fit(xy: np.ndarray, w: np.ndarray, k: int, seed: int = 42, rounds: int = 50) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = xy[[int(np.argmax(w))]]
    while len(centers) < k:
        d = ((xy[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1) * w
        centers = np.concatenate((centers, xy[[rng.choice(len(xy), p=d / d.sum()) if d.sum() > 0 else 0]]))
    label = np.zeros(len(xy), np.int64)
    for _ in range(rounds):
        new = ((xy[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        if (new == label).all() and _:
            break
        label = new
        for j in range(k):
            own = label == j
            if own.any():
                centers[j] = np.average(xy[own], axis=0, weights=w[own])
    return label


def cluster_labels(lat: np.ndarray, lon: np.ndarray, mw: np.ndarray, max_km: float, min_mw: float, most: int = 15) -> np.ndarray:
    """The least k whose clusters all lie within ``max_km`` and hold ``min_mw``; else the largest that holds ``min_mw``."""
    xy = np.column_stack((lat, lon * np.cos(np.radians(lat.mean()))))
    best = np.zeros(len(lat), np.int64)
    if mw.sum() < min_mw:
        return best
    for k in range(1, min(most, len(lat)) + 1):
        label = _fit(xy, mw, k)
        if min(mw[label == j].sum() for j in range(k)) < min_mw:
            continue
        best = label
        far = max(111.2 * np.sqrt(((xy[label == j] - np.average(xy[label == j], axis=0, weights=mw[label == j])) ** 2).sum(axis=1)).max() for j in range(k))
        if far <= max_km:
            break
    return best


def with_zone_id(zones: DataFrame, keys: list[str], kind_col: str = "technology") -> DataFrame:
    """``zone_id``: the kind and the zone's rank by capacity; a key's only zone covers the country."""
    alone = F.count("*").over(Window.partitionBy(*keys)) == 1
    return zones.withColumn("zone_id", F.concat_ws("_", kind_col, F.when(alone, "country").otherwise(F.col("rank_in_key").cast("string"))))


def cluster_zones(plants: DataFrame, keys: list[str], id_col: str, lat: str, lon: str, mw: str, max_km: float = 150.0, min_mw: float = 50.0) -> DataFrame:
    """Zones per key: weighted centre, share of capacity, radius, rank; one key's plants are one group (a country's registry)."""
    fields = [*keys, id_col, lat, lon, mw]
    schema = ", ".join(f"`{f}` {plants.schema[f].dataType.simpleString()}" for f in fields) + ", cluster int"

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(id_col, kind="stable")
        return df.assign(cluster=cluster_labels(*(df[c].to_numpy(np.float64) for c in (lat, lon, mw)), max_km, min_mw).astype(np.int32))

    labelled = plants.select(*fields).groupBy(*keys).applyInPandas(run, schema)
    by = Window.partitionBy(*keys, "cluster")
    w = F.sum(mw).over(by)
    placed = labelled.withColumn("c_lat", F.sum(F.col(lat) * F.col(mw)).over(by) / w).withColumn("c_lon", F.sum(F.col(lon) * F.col(mw)).over(by) / w)
    km = haversine_km(F.col(lat), F.col(lon), F.col("c_lat"), F.col("c_lon"))
    zones = placed.groupBy(*keys, "cluster").agg(F.round(F.max("c_lat"), 4).alias("zone_lat"), F.round(F.max("c_lon"), 4).alias("zone_lon"), F.sum(mw).alias("capacity"), F.max(km).alias("radius_km"), F.count("*").alias("n_plants"))
    whole = Window.partitionBy(*keys)
    return zones.withColumn("weight", F.col("capacity") / F.sum("capacity").over(whole)).withColumn("rank_in_key", F.row_number().over(whole.orderBy(F.desc("capacity"), "cluster"))).drop("cluster")
