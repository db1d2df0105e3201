"""Registered queries of the composite jobs. Market documents and weather responses are made from the given tables first."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import registries as rg
from ..jobs import maintenance as mt
from ..jobs import market as mk
from ..jobs import weather as wt
from ..operators import quality as ql
from ..operators import reports as rp
from ..operators import revision as rv
from ..operators import timeseries as ts
from ..sources import sinks
from ..streaming import jobs
from .catalog import _PLACEBOS, _PLACED, _SQL, _placed, _query

#: Production types that events of each type stand for; the last has no column.
CODES = {"view": "B16", "click": "B19", "purchase": "B10", "error": "B14", "signup": "B99"}


def _documents(points: DataFrame, keys: list[str], code=None, out_side=None, business="A04") -> DataFrame:
    """A document for each of ``keys`` and day from hourly ``points`` (keys, day, hour, q); its series by ``code``, side and type."""
    point = F.struct("hour", F.format_string("<Point><position>%d</position><quantity>%d</quantity></Point>", F.col("hour") + 1, "q").alias("xml"))
    code, out_side = F.lit("") if code is None else code, F.lit(False) if out_side is None else out_side
    business = F.lit(business) if isinstance(business, str) else business
    series = points.groupBy(*keys, "day", code.alias("code"), out_side.alias("out_side"), business.alias("business")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(point)), lambda p: p["xml"]), "").alias("points"))
    domain = F.when(F.col("out_side"), '<outBiddingZone_Domain.mRID codingScheme="A01">Z</outBiddingZone_Domain.mRID>').otherwise("")
    kind = F.when(F.col("code") != "", F.concat(F.lit("<MktPSRType><psrType>"), "code", F.lit("</psrType></MktPSRType>"))).otherwise("")
    bounds = F.concat(F.lit("<start>"), F.col("day").cast("string"), F.lit("T00:00Z</start><end>"), F.date_add("day", 1).cast("string"), F.lit("T00:00Z</end>"))
    typed = F.when(F.col("business") != "", F.concat(F.lit("<businessType>"), "business", F.lit("</businessType>"))).otherwise("")
    xml = F.concat(F.lit("<TimeSeries>"), typed, domain, kind, F.lit("<Period><timeInterval>"), bounds, F.lit("</timeInterval><resolution>PT60M</resolution>"), "points", F.lit("</Period></TimeSeries>"))
    documents = series.groupBy(*keys, "day").agg(F.array_join(F.sort_array(F.collect_list(xml)), "").alias("body"))
    return documents.select(*keys, F.concat(F.lit('<Publication_MarketDocument xmlns="urn:x"><createdDateTime>2024-02-01T00:00:00Z</createdDateTime>'), "body", F.lit("</Publication_MarketDocument>")).alias("xml"))


def _hourly(t, q, **keys) -> DataFrame:
    return t("events").groupBy(*(F.expr(e).alias(k) for k, e in keys.items()), F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(q.alias("q"))


def _filled_sql(q: str, where: str = "", **keys) -> str:
    """Published hours, and the hours that they are carried on to, as f (keys, day, h, pub, v)."""
    names = ", ".join(keys)
    return f"WITH q AS (SELECT {', '.join(f'{e} AS {k}' for k, e in keys.items())}, CAST(ts AS DATE) AS day, hour(ts) AS h, {q} AS v FROM events {where} GROUP BY ALL), g AS (SELECT {names}, day, unnest(generate_series(min(h), 23)) AS h FROM q GROUP BY {names}, day), f AS (SELECT {names}, day, CAST(day AS TIMESTAMP) + to_hours(h) AS ts, q.v IS NOT NULL AS pub, CAST(last_value(q.v IGNORE NULLS) OVER (PARTITION BY {names}, day ORDER BY h ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS v FROM g LEFT JOIN q USING ({names}, day, h))"


_LOAD = {"country": "'C' || (user_id % 7)"}


@_query(_filled_sql("count(*) % 3 * 40000", **_LOAD) + " SELECT country, ts, v AS load_mw FROM f WHERE (pub OR v <> 0) AND v BETWEEN 0 AND 100000")
def job_load(t):
    points = _hourly(t, F.count("*") % 3 * 40_000, country="concat('C', user_id % 7)")
    return mk.load(_documents(points, ["country"]))["rows"].select("country", "ts", "load_mw")


_GENERATION = {"country": "'C' || (user_id % 3)", "kind": "event_type", "consumed": "event_type = 'purchase' AND user_id % 2 = 1"}
_BLANKED = _filled_sql("count(*) % 3 * 100", **_GENERATION) + ", b AS (SELECT *, CASE WHEN pub OR v <> 0 THEN v END AS w FROM f)"


def _generation(t) -> DataFrame:
    points = _hourly(t, F.count("*") % 3 * 100, country="concat('C', user_id % 3)", kind="event_type", consumed="event_type = 'purchase' and user_id % 2 = 1")
    code = F.create_map(*(F.lit(x) for kv in CODES.items() for x in kv))[F.col("kind")]
    return _documents(points.withColumn("code_", code), ["country"], F.col("code_"), F.col("consumed"))


def _one(kind: str, net: str = "") -> str:
    return f"sum(w) FILTER (WHERE kind = '{kind}'{net})"


@_query(_BLANKED + f" SELECT country, ts, {_one('view')} AS solar_mw, {_one('click')} AS wind_onshore_mw, {_one('error')} AS nuclear_mw, CASE WHEN {_one('purchase')} IS NOT NULL THEN coalesce({_one('purchase', ' AND NOT consumed')}, 0) - coalesce({_one('purchase', ' AND consumed')}, 0) END AS hydro_pumped_mw, CAST(NULL AS DOUBLE) AS waste_mw FROM b GROUP BY country, ts")
def job_generation(t):
    return mk.generation(_generation(t))["generation"].select("country", "ts", "solar_mw", "wind_onshore_mw", "nuclear_mw", "hydro_pumped_mw", "waste_mw")


@_query(_BLANKED + f" SELECT country, ts, coalesce({_one('view')}, 0) AS solar_mw, coalesce({_one('click')}, 0) AS wind_onshore_mw, coalesce({_one('purchase')}, 0) AS hydro_reservoir_mw, coalesce({_one('view')}, 0) + coalesce({_one('click')}, 0) + coalesce({_one('purchase')}, 0) AS total_renewable_mw FROM b WHERE NOT consumed GROUP BY country, ts")
def job_renewable(t):
    return mk.generation(_generation(t))["renewable"].select("country", "ts", "solar_mw", "wind_onshore_mw", "hydro_reservoir_mw", "total_renewable_mw")


_ZONES = ["NO_1", "NO_2", "NO_3", "NO_4", "NO_5", "IT_NORD", "DE_LU", "FR"]
_ZONE = "element_at(array({}), cast(user_id % 8 as int) + 1)".format(", ".join(f"'{z}'" for z in _ZONES))
_ZONE_SQL = f"({_ZONES!r})[CAST(user_id % 8 AS INTEGER) + 1]"
_COUNTRY_SQL = "CASE WHEN zone LIKE 'NO%' THEN 'NO' WHEN zone = 'IT_NORD' THEN 'IT' WHEN zone = 'DE_LU' THEN 'DE' ELSE zone END"


def _countries(t) -> DataFrame:
    """The countries that the events' zones lie in, and one more that shares a zone."""
    zones = t("events").select(F.expr(_ZONE).alias("zone")).distinct()
    own = zones.select(rg.country_of(F.col("zone")).alias("country")).distinct()
    return own.unionByName(own.filter("country = 'DE'").select(F.lit("LU").alias("country")))


@_query(_filled_sql("count(*) % 4 * 1000 - 500", zone=_ZONE_SQL) + f", c AS (SELECT {_COUNTRY_SQL} AS country, ts, v FROM f UNION ALL SELECT 'LU', ts, v FROM f WHERE zone = 'DE_LU') SELECT country, ts, sum(v) / count(v) AS price_eur_mwh, count(v) AS n_zones FROM c GROUP BY ALL", digits="price_eur_mwh")
def job_price(t):
    docs = _documents(_hourly(t, F.count("*") % 4 * 1000 - 500, zone=_ZONE), ["zone"])
    return mk.price(docs, _countries(t))["rows"].select("country", "ts", "price_eur_mwh", "n_zones")


@_query(_filled_sql("count(*) % 4 - 1", zone=_ZONE_SQL) + f" SELECT {_COUNTRY_SQL} AS country, ts, v AS net_position_mw FROM f WHERE (pub OR v <> 0) AND zone IN ('DE_LU', 'FR')")
def job_net_position(t):
    docs = _documents(_hourly(t, F.count("*") % 4 - 1, zone=_ZONE), ["zone"])
    return mk.net_position(docs, _countries(t))["rows"].select("country", "ts", "net_position_mw")


@_query(_filled_sql("count(*)", zone=_ZONE_SQL, to_zone="CASE WHEN event_id % 2 = 0 THEN 'SE_1' ELSE 'DK_1' END") + f", i AS (SELECT {_COUNTRY_SQL} AS from_country, left(to_zone, 2) AS to_country, ts, sum(v) AS v FROM f GROUP BY ALL) SELECT from_country, to_country, ts, v AS flow_mw FROM i")
def job_flows(t):
    docs = _documents(_hourly(t, F.count("*"), from_zone=_ZONE, to_zone="case when event_id % 2 = 0 then 'SE_1' else 'DK_1' end"), ["from_zone", "to_zone"])
    borders = _countries(t).select(F.col("country").alias("from_country"), F.lit("DK").alias("to_country"))
    return mk.flows(docs, borders)["rows"].select("from_country", "to_country", "ts", "flow_mw")


@_query(_filled_sql("count(*) * 10", country="'C' || (user_id % 5)", kind="event_type") + " SELECT country, ts, coalesce(sum(v) FILTER (WHERE kind = 'view'), 0) AS solar_mw, coalesce(sum(v) FILTER (WHERE kind = 'click'), 0) AS wind_onshore_mw, 0.0::DOUBLE AS wind_offshore_mw, coalesce(sum(v) FILTER (WHERE kind = 'view'), 0) + coalesce(sum(v) FILTER (WHERE kind = 'click'), 0) AS total_mw FROM f WHERE kind IN ('view', 'click') GROUP BY country, ts")
def job_wind_solar_forecast(t):
    points = _hourly(t, F.count("*") * 10, country="concat('C', user_id % 5)", kind="event_type")
    code = F.create_map(*(F.lit(x) for kv in CODES.items() for x in kv))[F.col("kind")]
    return mk.wind_solar_forecast(_documents(points.withColumn("code_", code), ["country"], F.col("code_")))["rows"]


@_query(_filled_sql("count(*) * 30000", country="'C' || (user_id % 9)") + " SELECT country, ts, v AS forecast_mw FROM f WHERE v BETWEEN 0 AND 100000")
def job_load_forecast(t):
    docs = _documents(_hourly(t, F.count("*") * 30_000, country="concat('C', user_id % 9)"), ["country"])
    return mk.load_forecast(docs)["rows"].select("country", "ts", "forecast_mw")


#: Types of series that events stand for: least and most load under both names, and two series that state neither.
BOUNDS = {"view": "A60", "click": "A61", "purchase": "B10", "error": "B11", "signup": ""}


@_query("WITH q AS (SELECT 'C' || (user_id % 5) AS country, date_trunc('hour', ts) AS ts, CASE WHEN event_type = 'signup' THEN 'signup' || (user_id % 2) ELSE event_type END AS k, count(*) * 100 AS v FROM events GROUP BY ALL), p AS (SELECT country, ts, " + ", ".join(f"max(v) FILTER (WHERE k = '{k}') AS {k}" for k in ("view", "click", "purchase", "error", "signup0", "signup1")) + " FROM q GROUP BY ALL), b AS (SELECT country, ts, coalesce(purchase, view, signup0, signup1) AS lo, coalesce(error, click, signup0, signup1) AS hi FROM p) SELECT country, ts, CAST(coalesce(lo, hi) AS DOUBLE) AS value_min, CAST(coalesce(hi, lo) AS DOUBLE) AS value_max, (coalesce(lo, hi) + coalesce(hi, lo)) / 2 AS value_mid FROM b")
def job_week_ahead(t):
    """All cases of bounds: typed under either name, untyped alone or beside either, one side only."""
    kind, half = F.col("kind"), F.when(F.col("kind") == "signup", F.concat(F.lit("B1"), F.col("half").cast("string"))).otherwise("")
    points = _hourly(t, F.count("*") * 100, country="concat('C', user_id % 5)", kind="event_type", half="case when event_type = 'signup' then user_id % 2 end")
    business = F.create_map(*(F.lit(x) for kv in BOUNDS.items() for x in kv))[kind]
    docs = _documents(points, ["country"], half, business=business)
    return mk.load_forecast(docs, week_ahead=True)["rows"].select("country", "ts", "value_min", "value_max", "value_mid")


def _responses(t, source, value) -> DataFrame:
    """A response of each source and day for the places 0 to 3: users by their number, hours by the events' counts."""
    hours = t("events").groupBy(source.alias("source"), F.to_date("ts").alias("day"), (F.col("user_id") % 4).cast("int").alias("place"), F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm").alias("h")).agg(value.alias("v"))
    arrays = hours.groupBy("source", "day", "place").agg(F.sort_array(F.collect_list(F.struct("h", "v"))).alias("x"))
    hourly = F.struct(F.struct(F.col("x.h").alias("time"), F.col("x.v").alias("temperature_2m"), F.col("x.v").alias("cloud_cover")).alias("hourly"))
    bodies = arrays.groupBy("source", "day").agg(F.map_from_entries(F.collect_list(F.struct("place", hourly.alias("r")))).alias("m"))
    every = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.element_at("m", k))
    return bodies.select("source", F.col("day").cast("timestamp_ntz").alias("fetched_at"), F.to_json(every).alias("body"))


@_query("SELECT event_type AS source, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS fetched_at, user_id % 4 + 100 AS location_id, date_trunc('hour', ts) AS valid_at, CAST(count(*) AS DOUBLE) AS temperature_2m_c, CAST(count(*) AS DOUBLE) * 0.01::DOUBLE + 0.0::DOUBLE AS cloud_cover_frac FROM events GROUP BY ALL")
def job_weather_snapshots(t):
    responses = _responses(t, F.col("event_type"), F.count("*").cast("double"))
    places = t("events").select((F.col("user_id") % 4 + 100).alias("location_id")).distinct().withColumns({"lat": F.lit(50.0), "lon": F.lit(5.0)})
    sources = ["view", "click", "purchase", "error", "signup"]
    located = wt.covered_locations(t("events").sparkSession, places, sources)
    rows = wt.snapshots(responses, located, ["temperature_2m", "cloud_cover"])["rows"]
    return rows.select("source", "fetched_at", "location_id", "valid_at", "temperature_2m_c", "cloud_cover_frac")


@_query("SELECT valid_at, sum(v * w) / sum(w) + 273.15::DOUBLE AS temperature_2m_k, count(*) AS n_points FROM (SELECT date_trunc('hour', ts) AS valid_at, user_id % 4 AS p, CAST(count(*) AS DOUBLE) AS v, (user_id % 4 + 1) * 0.118307 AS w FROM events GROUP BY ALL) GROUP BY valid_at", digits="temperature_2m_k")
def job_multipoint_weather(t):
    responses = _responses(t, F.lit("all"), F.count("*").cast("double")).select(F.lit("BE").alias("country"), F.lit("wind").alias("kind"), "body")
    points = t("events").select((F.col("user_id") % 4).cast("int").alias("position")).distinct().select(F.lit("BE").alias("country"), F.lit("wind").alias("kind"), "position", ((F.col("position") + 1) * 0.118307).alias("weight"))
    return wt.multipoint(responses, points, ["temperature_2m"]).select("valid_at", "temperature_2m_k", "n_points")


@_query(f"SELECT c_nationkey, c_mktsegment AS technology, count(*) AS n, count(*) > 0 AS has_zones FROM ({_PLACED}) WHERE c_acctbal > 0 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY ALL")
def job_weather_zones(t):
    plants = _placed(t).filter("c_acctbal > 0 and lat between -90 and 90 and lon between -180 and 180")
    plants = plants.select(F.col("c_nationkey").alias("country"), F.col("c_mktsegment").alias("technology"), F.col("c_acctbal").alias("capacity_mw"), "lat", "lon", F.col("c_custkey").alias("name"))
    countries = t("nation").select(F.col("n_nationkey").alias("country"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), F.col("n_name").alias("name"))
    built = wt.build_zones(plants, countries, {"BUILDING": (2500.0, 1000.0), "MACHINERY": (2500.0, 1000.0)})
    weights = built["places"].filter("technology <> 'centroid'").groupBy("country", "technology").agg((F.abs(F.sum("weight") - 1) < 0.01).alias("adds_up"))
    return built["coverage"].filter("n > 0").join(weights, ["country", "technology"]).select(F.col("country").alias("c_nationkey"), "technology", "n", ((F.col("zones") > 0) & F.col("adds_up")).alias("has_zones"))


# plans and repairs

_USER = "SELECT user_id, ts AS a, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM (SELECT DISTINCT user_id, ts FROM events{})"


@_query(f"WITH r AS (SELECT user_id, a, b FROM ({_USER.format('')}) WHERE epoch_us(b) - epoch_us(a) > 43200000000 UNION ALL SELECT user_id, min(ts), max(ts) + INTERVAL 1 HOUR FROM events WHERE event_type = 'error' GROUP BY user_id, CAST(ts AS DATE) UNION ALL SELECT DISTINCT user_id, TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-12' FROM events WHERE user_id < 20), f AS (SELECT *, CASE WHEN a > max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + INTERVAL 1 DAY THEN 1 ELSE 0 END AS new FROM r), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM f) SELECT user_id, min(a) AS start_at, max(b) AS end_at, count(*) AS merged, CAST(floor((epoch_us(max(b)) - epoch_us(min(a))) / 3600000000::DOUBLE) AS BIGINT) AS hours FROM g GROUP BY user_id, g.g")
def gap_repair_plan(t):
    rows = t("events").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    asked = rows.filter("user_id < 20").select("user_id", F.lit("2024-01-10").cast("timestamp_ntz").alias("start_at"), F.lit("2024-01-12").cast("timestamp_ntz").alias("end_at")).distinct()
    return mt.gap_repair_plan(rows, ["user_id"], "ts", "v", asked, 12 * 3600)


_RANGE = " WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-25 23:59:59'"


@_query(f"WITH w AS (SELECT user_id, a AS from_ts, b + INTERVAL 1 HOUR AS to_ts, (epoch_us(b) - epoch_us(a)) / 1000000::DOUBLE / 3600 AS gap_hours FROM ({_USER.format(_RANGE)}) WHERE epoch_us(b) - epoch_us(a) > 86400000000) SELECT w.*, (SELECT count(*) FROM events e WHERE e.user_id = w.user_id AND e.ts BETWEEN from_ts AND to_ts) AS rows_before FROM w")
def catch_up_plan(t):
    return mt.catch_up_plan(t("events"), ["user_id"], "ts", "2024-01-03", "2024-01-25", 24.0)


@_query("WITH d AS (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_tax = 0), i AS (SELECT l_suppkey, min(d) AS a, max(d) + 1 AS b FROM (SELECT *, d - CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY d) AS INTEGER) AS i FROM d) GROUP BY l_suppkey, i), c AS (SELECT l_suppkey, CAST(a AS TIMESTAMP) AS a, CAST(b AS TIMESTAMP) AS b FROM i) SELECT l_suppkey, s AS chunk_start, least(s + INTERVAL 2 DAY, b) AS chunk_end FROM (SELECT *, unnest(generate_series(a, b - INTERVAL 1 MICROSECOND, INTERVAL 2 DAY)) AS s FROM c)")
def publication_repair_plan(t):
    return mt.publication_repair_plan(t("lineitem").withColumn("v", F.nullif("l_tax", F.lit(0.0))), ["l_suppkey"], "l_shipdate", "v", 2)


@_query("SELECT k AS l_suppkey, m AS month, m + INTERVAL 1 MONTH AS month_end, strftime(m, '%Y-%m') AS month_key FROM (SELECT s_suppkey AS k FROM supplier) a, (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '1999-12-01', INTERVAL 1 MONTH)) AS m) b WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = k AND date_trunc('month', l_shipdate) = m)")
def skip_aware_month_plan(t):
    return mt.month_plan(t("lineitem"), ["l_suppkey"], "l_shipdate", "1995-01-01 00:00:00", "1999-12-01 00:00:00", t("supplier").withColumnRenamed("s_suppkey", "l_suppkey"))


@_query("SELECT 'documents' AS dimension, side, CAST(doc_id AS VARCHAR) AS member FROM (" + _SQL["dimension_drift"] + ") UNION ALL SELECT 'suppliers', 'left_only', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem) UNION ALL SELECT 'customers', 'left_only', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def dimension_drifts(t):
    big = t("lineitem").select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    buyers = t("orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return mt.drifts({"documents": (t("documents"), t("labels"), ["doc_id"]), "suppliers": (t("supplier"), big, ["s_suppkey"]), "customers": (t("customer"), buyers, ["c_custkey"])})


# statistics

_PAIRED_HOURS = "SELECT event_type, h, avg(value) AS y, any_value(pooled) AS f FROM (SELECT event_type, CAST(epoch(date_trunc('hour', ts)) / 3600 AS BIGINT) AS h, value, avg(value) OVER (PARTITION BY date_trunc('hour', ts)) AS pooled FROM events) GROUP BY ALL"


@_query(f"WITH p AS ({_PAIRED_HOURS}), b AS (SELECT *, max(y) OVER (PARTITION BY event_type ORDER BY h RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS y1, max(y) OVER (PARTITION BY event_type ORDER BY h RANGE BETWEEN 24 PRECEDING AND 24 PRECEDING) AS ys FROM p) SELECT event_type, count(*) AS n, avg(abs(f - y)) AS mae, sqrt(avg((f - y) * (f - y))) AS rmse, 100 * avg(CASE WHEN y <> 0 THEN abs(f - y) / abs(y) END) AS mape, 100 * avg(2 * abs(f - y) / nullif(abs(y) + abs(f), 0)) AS smape, avg(abs(f - y)) / avg(abs(y - ys)) AS mase, 100 * avg(CAST(sign(f - y1) = sign(y - y1) AS INTEGER)) AS direction, 1 - avg(CASE WHEN y1 IS NOT NULL THEN abs(f - y) END) / avg(abs(y - y1)) AS skill_persistence, 1 - avg(CASE WHEN ys IS NOT NULL THEN abs(f - y) END) / avg(abs(y - ys)) AS skill_seasonal FROM b GROUP BY event_type", digits="mae rmse mape smape mase direction skill_persistence skill_seasonal")
def forecast_metrics(t):
    rows = t("events").withColumn("ts", ts.floor_to("ts", "hour"))
    pooled = rows.groupBy("ts").agg(F.avg("value").alias("pooled"))
    return rp.forecast_metrics(ts.resample_mean(rows, ["event_type"], "ts", "value").join(pooled, "ts"), ["event_type"], "ts", "mean_value", "pooled")


@_query("SELECT sum(n) AS n, 2 * sqrt(sum(se * se)) / max(CASE WHEN side = 'after' THEN mean_value END) AS min_detectable_effect FROM (SELECT CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 'after' ELSE 'before' END AS side, count(value) AS n, avg(value) AS mean_value, stddev_pop(value) / sqrt(count(value)) AS se FROM events GROUP BY ALL)", digits="min_detectable_effect")
def minimum_detectable_effect(t):
    return rv.minimum_detectable_effect(rv.two_samples(t("events"), F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), "value"))


@_query("SELECT max(CASE WHEN split = TIMESTAMP '2024-01-15' THEN shift END) AS real_shift, max(CASE WHEN split <> TIMESTAMP '2024-01-15' THEN shift END) AS worst_placebo, count(*) FILTER (WHERE split <> TIMESTAMP '2024-01-15') AS placebos, max(CASE WHEN split = TIMESTAMP '2024-01-15' THEN shift END) > 3 * max(CASE WHEN split <> TIMESTAMP '2024-01-15' THEN shift END) AS is_effect FROM (SELECT split, abs(effect - 1) AS shift FROM (" + _PLACEBOS + ") WHERE n_before >= 1000 AND n_after >= 1000 AND split - INTERVAL 5 DAY >= TIMESTAMP '2024-01-04' AND split + INTERVAL 5 DAY <= TIMESTAMP '2024-01-24')", digits="real_shift worst_placebo")
def placebo_verdict(t):
    splits = [f"2024-01-{d} 00:00:00" for d in ("08", "11", "15", "18", "22")]
    effects = rv.split_effects(t("events"), "ts", "value", splits, 5, ("2024-01-04", "2024-01-24"))
    return rv.placebo_verdict(effects, "2024-01-15 00:00:00")


@_query("SELECT 'c_acctbal' AS \"column\", count(*) FILTER (WHERE c_acctbal < 0) AS n, min(c_acctbal) AS least FROM customer HAVING n > 0")
def negative_values(t):
    return ql.negatives(t("customer"), ["c_acctbal", "c_custkey"])


@_query("SELECT l_orderkey, l_linenumber, l_partkey, coalesce(l_tax, 0) + coalesce(l_discount, 0) AS parts_sum FROM lineitem WHERE abs(l_quantity / 100 - (coalesce(l_tax, 0) + coalesce(l_discount, 0))) > 0.3")
def totals_off(t):
    rows = t("lineitem").withColumn("total", F.col("l_quantity") / 100)
    return ql.totals_off(rows, "total", ["l_tax", "l_discount"], 0.3).select("l_orderkey", "l_linenumber", "l_partkey", "parts_sum")


# streams


@_query("SELECT CASE WHEN age < 7 THEN '<7' WHEN age < 14 THEN '<14' ELSE '>=14' END AS band, count(*) AS n FROM (SELECT (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 86400000000::DOUBLE AS age FROM events) GROUP BY ALL")
def stream_late_rows(spark, sf_dir):
    age = (F.lit(1706745600.0) - ts.seconds("ts")) / 86_400
    return jobs.late_rows(spark, jobs.read_table(spark, sf_dir, "events"), age, (7, 14)).groupBy("band").agg(F.sum("n").alias("n"))


@_query("SELECT event_id, c_mktsegment FROM events JOIN customer ON user_id = c_custkey")
def stream_enriched(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return jobs.collected(spark, jobs.enriched(jobs.read_table(spark, sf_dir, "events"), customers, "user_id").select("event_id", "c_mktsegment"), "append")


@_query("SELECT event_id, event_type FROM events")
def stream_replica(spark, sf_dir):
    folder = f"{sinks.scratch_folder(spark)}/stream_replica-{uuid.uuid4().hex}"
    rows = jobs.read_table(spark, sf_dir, "events").select("event_id", "event_type")
    for _ in range(2):  # the second pull finds nothing new
        jobs.replicate(rows, f"{folder}/table", ["event_id"], f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/table")


@_query("SELECT event_id, event_type FROM events")
def incremental_pull(spark, sf_dir):
    folder = f"{sinks.scratch_folder(spark)}/pull-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type")
    most = (events.agg(F.max("event_id")).first()[0] or 0) // 2 + 1
    for part in (events.filter(F.col("event_id") < most), events):  # the second pull starts where the first has stopped
        sinks.pull(spark, part, f"{folder}/table", ["event_id"], "event_id", most)
    return spark.read.parquet(f"{folder}/table")
