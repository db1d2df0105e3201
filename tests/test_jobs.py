"""Composite jobs, readers and sinks on small documents and tables."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gridspark.functions import registries as rg
from gridspark.jobs import maintenance, market, weather
from gridspark.operators import quality, reports, revision, shape, text, timeseries, zones
from gridspark.sources import readers, sinks

DAY = "2024-03-05"


def series(points, code="", consumed=False, business="A04", resolution="PT60M", start=f"{DAY}T00:00Z", end=f"{DAY}T04:00Z"):
    kind = f"<MktPSRType><psrType>{code}</psrType></MktPSRType>" if code else ""
    side = "<outBiddingZone_Domain.mRID>Z</outBiddingZone_Domain.mRID>" if consumed else ""
    body = "".join(f"<Point><position>{p}</position><quantity>{q}</quantity></Point>" for p, q in points)
    return f"<TimeSeries><businessType>{business}</businessType>{side}{kind}<Period><timeInterval><start>{start}</start><end>{end}</end></timeInterval><resolution>{resolution}</resolution>{body}</Period></TimeSeries>"


def document(*parts, at="2024-03-06T10:00:00Z"):
    return f'<D xmlns="urn:d"><createdDateTime>{at}</createdDateTime>{"".join(parts)}</D>'


def docs(spark, rows, key="country string"):
    return spark.createDataFrame(rows, f"{key}, xml string")


def by(rows, *keys):
    return {tuple(getattr(r, k) for k in keys[:-1]): getattr(r, keys[-1]) for r in rows.collect()}


def hour(h):
    return dt.datetime(2024, 3, 5, h)


def test_load_carries_values_on_but_not_zeros(spark):
    found = market.load(docs(spark, [("A", document(series([(1, 5000), (3, 0)]))), ("B", document(series([(1, 900_000)]))), ("C", "no xml")]))
    assert by(found["rows"], "country", "ts", "load_mw") == {("A", hour(0)): 5000.0, ("A", hour(1)): 5000.0, ("A", hour(2)): 0.0}
    assert found["rejected"].count() == 4  # beyond the limits


def test_the_latest_publication_of_an_instant_counts(spark):
    rows = [("A", document(series([(1, 7)], end=f"{DAY}T01:00Z"), at="2024-03-07T00:00:00Z")), ("A", document(series([(1, 6)], end=f"{DAY}T01:00Z")))]
    assert [r.load_mw for r in market.load(docs(spark, rows))["rows"].collect()] == [7.0]


def test_one_document_two_tables(spark):
    parts = [series([(1, 10)], "B16"), series([(1, 8), (2, 4)], "B10"), series([(1, 3), (2, 9)], "B10", consumed=True), series([(1, 0)], "B14"), series([(1, 2)], "B25"), series([(1, 1)], "B99")]
    found = market.generation(docs(spark, [("A", document(*parts))]))
    full = {r.ts: r for r in found["generation"].collect()}
    assert [full[hour(h)].hydro_pumped_mw for h in range(3)] == [5.0, -5.0, -5.0]
    assert (full[hour(0)].nuclear_mw, full[hour(1)].nuclear_mw, full[hour(0)].waste_mw) == (0.0, None, None)
    renewable = {r.ts: r for r in found["renewable"].collect()}
    assert (renewable[hour(1)].hydro_reservoir_mw, renewable[hour(1)].other_renewable_mw, renewable[hour(1)].biomass_mw, renewable[hour(1)].total_renewable_mw) == (4.0, 2.0, 0.0, 16.0)
    assert [(r.production_type, r.n_rows) for r in found["unmapped"].collect()] == [("B99", 4)]
    assert len(rg.GENERATION_COLUMNS) == 21 and set(rg.PSR_TYPES.values()) == set(rg.GENERATION_COLUMNS) and len(set(rg.RENEWABLE_COLUMNS.values())) == 8


def test_prices_of_zones(spark):
    whole = lambda q: document(series([(1, q)]))
    found = market.price(docs(spark, [("DE_LU", whole(50)), ("NO_1", whole(10)), ("NO_2", whole(30)), ("FR", whole(4000))], "zone string"), spark.createDataFrame([(c,) for c in ("DE", "LU", "NO", "FR", "ES")], "country string"))
    first = {r.country: (r.price_eur_mwh, r.n_zones) for r in found["rows"].filter(F.hour("ts") == 0).collect()}
    assert first == {"DE": (50.0, 1), "LU": (50.0, 1), "NO": (20.0, 2)} and {r.country for r in found["rejected"].collect()} == {"FR"}


def test_net_position_counts_a_zone_once(spark):
    rows = [("DE_LU", document(series([(1, 100), (2, 300)], resolution="PT30M", end=f"{DAY}T01:00Z")))]
    found = market.net_position(docs(spark, rows, "zone string"), spark.createDataFrame([("DE",), ("LU",)], "country string"))["rows"].collect()
    assert [(r.country, r.net_position_mw) for r in found] == [("DE", 200.0)]


def test_load_forecasts(spark):
    week = document(series([(1, 40)], business="A60", resolution="P1D", end="2024-03-06T00:00Z"), series([(1, 60)], business="A61", resolution="P1D", end="2024-03-06T00:00Z"))
    only = document(series([(1, 70)], business="A61", resolution="P1D", end="2024-03-06T00:00Z"))
    rows = market.load_forecast(docs(spark, [("A", week), ("B", only)]), week_ahead=True)["rows"].collect()
    assert {r.country: (r.value_min, r.value_max, r.value_mid) for r in rows} == {"A": (40.0, 60.0, 50.0), "B": (70.0, 70.0, 70.0)}
    day = market.load_forecast(docs(spark, [("A", document(series([(1, 5)]), series([(1, 6)])))]))["rows"]
    assert {r.forecast_mw for r in day.collect()} == {5.0}


def test_flows_report_silent_borders_and_empty_values(spark):
    rows = [("NO_1", "SE_1", document(series([(1, 10)]))), ("NO_2", "SE_1", document(series([(1, 5)]))), ("FR", "BE", document(series([(1, "x")])))]
    borders = spark.createDataFrame([("NO", "SE"), ("FR", "BE"), ("PL", "CZ")], "from_country string, to_country string")
    found = market.flows(spark.createDataFrame(rows, "from_zone string, to_zone string, xml string"), borders)
    assert {(r.from_country, r.to_country, r.flow_mw) for r in found["rows"].collect()} == {("NO", "SE", 15.0)}
    assert {r.from_country for r in found["silent"].collect()} == {"FR", "PL"}


def test_zone_names(spark):
    zones_ = spark.createDataFrame([("IT_SARD",), ("GB_NIR",), ("FR",), ("SOMEWHERE",)], "z string").select(rg.country_of(F.col("z")).alias("c"))
    assert [r.c for r in zones_.collect()] == ["IT", "GB", "FR", "SOMEWHERE"]


def test_weather_snapshots_by_source(spark):
    places = spark.createDataFrame([(7, 50.0, 4.0), (9, 37.0, 4.0)], "location_id int, lat double, lon double")
    located = weather.covered_locations(spark, places, ["meteofrance_arome_france", "gfs"])
    assert {(r.source, r.position, r.location_id) for r in located.collect()} == {("meteofrance_arome_france", 0, 7), ("gfs", 0, 7), ("gfs", 1, 9)}
    one = lambda t, c: {"hourly": {"time": [f"{DAY}T00:00", f"{DAY}T01:00"], "temperature_2m_previous_day1": t, "cloud_cover_previous_day1": c}}
    body = json.dumps([one([1.5, None], [50]), one([2.5, 3.5], [100, 0]), one([9, 9], [9, 9])])
    responses = spark.createDataFrame([("gfs", hour(2), body), ("meteofrance_arome_france", hour(2), "{broken")], "source string, fetched_at timestamp, body string")
    found = weather.snapshots(responses, located, ["temperature_2m", "cloud_cover"])
    assert {(r.location_id, r.valid_at.hour, r.temperature_2m_c, r.cloud_cover_frac) for r in found["rows"].collect()} == {(7, 0, 1.5, 0.5), (7, 1, None, None), (9, 0, 2.5, 1.0), (9, 1, 3.5, 0.0)}
    assert [(r.source, r.n_rows, r.locations) for r in found["summary"].collect()] == [("gfs", 4, 2)]
    assert [r.source for r in found["failed"].collect()] == ["meteofrance_arome_france"]


def test_snapshots_are_written_once(spark, tmp_path):
    rows = lambda v: spark.createDataFrame([("gfs", 7, hour(0), hour(2), v)], "source string, location_id int, valid_at timestamp, fetched_at timestamp, v double")
    for v in (1.0, 2.0):
        weather.store_snapshots(spark, rows(v), f"file://{tmp_path}/weather")
    assert [r.v for r in spark.read.parquet(f"file://{tmp_path}/weather").collect()] == [1.0]


def test_weights_of_six_decimals(spark):
    hourly = lambda t: {"hourly": {"time": [f"{DAY}T00:00"], "temperature_2m": [t]}}
    responses = spark.createDataFrame([("BE", "wind", json.dumps([hourly(0.004), hourly(0.003), hourly(None)]))], "country string, kind string, body string")
    points = spark.createDataFrame([("BE", "wind", 0, 0.118307), ("BE", "wind", 1, 0.000002), ("BE", "wind", 2, 0.5)], "country string, kind string, position int, weight double")
    row = weather.multipoint(responses, points, ["temperature_2m"]).first()
    assert row.n_points == 3 and abs(row.temperature_2m_k - 273.15 - (0.004 * 0.118307 + 0.003 * 0.000002) / 0.118309) < 1e-9
    df = spark.createDataFrame([("a", hour(0), 0.004, 0.118307), ("a", hour(0), 0.003, 0.000002)], "k string, ts timestamp, v double, w double")
    assert abs(timeseries.weighted_mean(df, ["k"], "v", "w").first().weighted - (0.004 * 0.118307 + 0.003 * 0.000002) / 0.118309) < 1e-12
    assert abs(timeseries.resample_mean(df, ["k"], "ts", "v").first().mean_value - 0.0035) < 1e-12


def test_plants_to_places(spark):
    wind = spark.createDataFrame([("Operating", "France", 100.0, 45.0, 2.0, f"w{k}", kind) for k, kind in enumerate((" Onshore", "Offshore hard mount", "unknown"))] + [("retired", "France", 9.0, 45.0, 2.0, "x", "onshore")], "status string, country string, capacity_mw double, lat double, lon double, name string, installation string")
    solar = spark.createDataFrame([("operating", "France", 10.0 * k, 44.0 + 6 * (k % 2), 3.0, f"s{k}") for k in range(1, 9)] + [("operating", "Atlantis", 5.0, 1.0, 1.0, "y")], "status string, country string, capacity_mw double, lat double, lon double, name string")
    plants = readers.plants(wind, solar, spark.createDataFrame([("France", "FR")], "country string, iso string"))
    assert plants.groupBy("technology").count().filter("technology = 'solar'").first()["count"] == 8 and plants.count() == 10
    built = weather.build_zones(plants, spark.createDataFrame([("FR", 46.0, 2.0, "France"), ("MT", 35.9, 14.4, "Malta")], "country string, lat double, lon double, name string"), {"solar": (150.0, 50.0), "wind_onshore": (100.0, 50.0)})
    places = built["places"].collect()
    assert {(r.country, r.zone_id) for r in places} == {("FR", "centroid"), ("MT", "centroid"), ("FR", "solar_1"), ("FR", "solar_2"), ("FR", "wind_onshore_country")}
    assert abs(sum(r.weight for r in places if r.technology == "solar") - 1) < 1e-3
    assert {(r.country, r.technology, r.n, r.zones) for r in built["coverage"].collect()} == {("FR", "solar", 8, 2), ("FR", "wind_onshore", 1, 1), ("MT", "solar", 0, 0), ("MT", "wind_onshore", 0, 0)}


def test_archives(spark, tmp_path):
    head = "time,zone_id,temperature_2m,relative_humidity_2m\n"
    for name, rows in (("weather_nwp_gfs_day1_zones_2024-01-01_2024-01-03.csv", "2024-01-01T00:00,z1,9,90\n"), ("weather_nwp_gfs_day1_zones_2024-01-01_2024-02-01.csv", "2024-01-01T00:00Z,z1,1,50\n2024-01-01T00:15,z1,2,60\n2024-01-01T01:00:00,zz,3,70\n2024-01-01T02:00,z1,,\n"), ("weather_nwp_day2_zones_2024-01-01_2024-01-02.csv", "2024-01-01T00:00,z1,4,80\n")):
        (tmp_path / name).write_text(head + rows)
    known = spark.createDataFrame([("z1", 7)], "zone_id string, location_id int")
    rows = readers.archive_rows(spark, f"file://{tmp_path}", known, rg.weather_units()).collect()
    assert {(r.model, r.lead, r.location_id, r.valid_at.hour, r.temperature_2m_c, r.relative_humidity_2m_frac) for r in rows} == {("gfs", 1, 7, 0, 1.0, 0.5), ("gfs", 1, 7, 2, None, None), ("best_match", 2, 7, 0, 4.0, 0.8)}
    written = dt.datetime.fromtimestamp(os.path.getmtime(tmp_path / "weather_nwp_day2_zones_2024-01-01_2024-01-02.csv"), dt.UTC).replace(tzinfo=None)
    assert all(abs((r.fetched_at - written).total_seconds()) < 3 for r in rows if r.lead == 2)


def test_single_point_and_widest_file(spark):
    body = json.dumps({"hourly": {"time": [f"{DAY}T00:00Z", f"{DAY}T01:00+01:00"], "temperature_2m": [1.0], "relative_humidity_2m": [40, 50]}})
    rows = readers.single_point_rows(spark.createDataFrame([("BE", body)], "country string, body string"), "body", {"temperature_2m": ("t_k", 1.0, 273.15), "relative_humidity_2m": ("rh", 0.01, 0.0)})
    assert [(r.country, r.valid_at.hour, r.t_k, r.rh) for r in rows.collect()] == [("BE", 0, 274.15, 0.4), ("BE", 0, None, 0.5)]
    files = spark.createDataFrame([("m", "a_2024-01-01_2024-01-05.csv"), ("m", "b_2024-01-01_2024-03-05.csv"), ("m", "c.csv")], "model string, path string")
    assert [r.path for r in readers.widest_files(files, ["model"]).collect()] == ["b_2024-01-01_2024-03-05.csv"]


def test_instants_in_all_forms(spark):
    stamps = ["2024-03-31T01:30Z", "2024-03-31T03:30+02:00", "2024-03-31T01:30:00Z", "2024-03-31T01:30:00", "2024-03-31T01:30", "soon", None]
    got = [r.t for r in spark.createDataFrame([(s,) for s in stamps], "s string").select(readers.instant(F.col("s")).cast("timestamp_ntz").alias("t")).collect()]
    assert got == [dt.datetime(2024, 3, 31, 1, 30)] * 5 + [None, None]
    # a day of 23 hours: local midnights an hour closer together
    short = document(series([(1, 5)], start="2024-03-30T23:00Z", end="2024-03-31T22:00Z"))
    assert market.load(docs(spark, [("A", short)]))["rows"].count() == 23


def test_chunks_are_half_open(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 11)), (dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1))], "a timestamp, b timestamp")
    got = [(r.chunk_start.day, r.chunk_end.day) for r in timeseries.chunks(rows.filter("a < b"), "a", "b", 4).collect()]
    assert got == [(1, 5), (5, 9), (9, 11)]


def test_merge_keeps_rows_without_instant_and_moves_keys(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    frame = lambda rows: spark.createDataFrame([(k, None if m is None else dt.datetime(2024, m, 1), v) for k, m, v in rows], "k string, ts timestamp, v int")
    for rows in ([("a", None, 1), ("b", 1, 1)], [("c", None, 2), ("b", 2, 2)], [("a", None, 3)]):
        sinks.merge_into(spark, path, frame(rows), ["k"], "ts", ["v"])
    assert sorted((r.k, r.ts and r.ts.month, r.v) for r in spark.read.parquet(path).collect()) == [("a", None, 3), ("b", 2, 2), ("c", None, 2)]


def test_refresh_seed_pull_and_log(spark, tmp_path):
    path = lambda name: f"file://{tmp_path}/{name}"
    frame = lambda n: spark.range(n).select(F.col("id").cast("int").alias("id"), F.lit(n).alias("v"))
    assert sinks.refresh(spark, frame(5), path("copy")) == 5 and sinks.refresh(spark, frame(3), path("copy")) == 3
    assert {r.v for r in spark.read.parquet(path("copy")).collect()} == {3}
    assert [sinks.seed(spark, frame(n), path("seed"), ["id"]) for n in (4, 4, 6)] == [4, 0, 2]
    assert [sinks.pull(spark, frame(n), path("pull"), ["id"], "id", 2) for n in (5, 5, 9)] == [5, 0, 4]
    sinks.log_row(spark, path("log"), "r1", "load", "2024-01-01T00:00:00")
    sinks.log_row(spark, path("log"), "r1", "load", "2024-01-01T00:00:00", inserted=4, done=True)
    found = market.load(docs(spark, [("A", document(series([(1, 5000)])))]))
    n = market.store(spark, found["rows"], path("load"), ["country", "ts"], "ts", "actual", "2024-03-06 00:00:00", path("log"), "r2", found["rejected"])
    with pytest.raises(Exception):  # noqa: B017
        market.store(spark, found["rows"], path("load"), ["nowhere"], "ts", "actual", "2024-03-06 00:00:00", path("log"), "r3")
    log = {r.log_id: (r.status, r.inserted, r.failed) for r in sinks.latest_log_rows(spark, path("log")).collect()}
    assert n == 4 and log == {"r1": ("completed", 4, 0), "r2": ("completed", 4, 0), "r3": ("failed", 0, 0)}
    assert {r.quality for r in spark.read.parquet(path("load")).collect()} == {"actual"}


def test_repairs(spark):
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    df = spark.createDataFrame([("a", at(1), None), ("a", at(2), at(5)), ("a", at(3), None), ("b", at(3), None)], "k string, ts timestamp, p timestamp")
    plan = maintenance.publication_repair_plan(df, ["k"], "ts", "p")
    assert sorted((r.k, r.chunk_start.day, r.chunk_end.day) for r in plan.collect()) == [("a", 1, 2), ("a", 3, 4), ("b", 3, 4)]
    asked = spark.createDataFrame([("a", at(1), at(9)), ("a", at(2), at(9)), ("b", at(3), at(9))], "k string, ts timestamp, p timestamp")
    fixed = maintenance.repair_publications(df, asked, ["k", "ts"], "ts", "p", "2024-01-01", "2024-01-03")
    assert by(fixed, "k", "ts", "p") == {("a", at(1)): at(9), ("a", at(2)): at(5), ("a", at(3)): None, ("b", at(3)): None}
    windows = maintenance.catch_up_plan(df.select("k", "ts"), ["k"], "ts", "2024-01-01", "2024-01-04", 6.0)
    more = df.select("k", "ts").unionByName(spark.createDataFrame([("a", at(1, 12))], "k string, ts timestamp"))
    assert sorted((r.from_ts.day, r.rows_before, r.recovered) for r in maintenance.recovery(windows, more, ["k"], "ts").collect()) == [(1, 2, 1), (2, 2, 0)]


def test_rows_in_windows_whatever_the_order_of_each_computation(spark):
    def shuffled(parts):
        for part in parts:
            yield part.sample(frac=1, random_state=int.from_bytes(os.urandom(4), "big"))

    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    df = spark.createDataFrame([(k, at(h)) for k in range(40) for h in range(k + 1)] + [(None, at(1))], "k long, ts timestamp")
    bounds = [(k, at(0), at(100), f"w{k}") for k in range(40)] * 2 + [(3, at(1), at(2), "inside"), (99, at(0), at(100), "no rows"), (None, at(0), at(100), "no key")]
    windows = spark.createDataFrame(bounds, "k long, from_ts timestamp, to_ts timestamp, name string")
    windows = windows.mapInPandas(shuffled, windows.schema)
    found = maintenance.rows_in_windows(df, windows, ["k"], "ts", "n")
    assert found.columns == ["k", "from_ts", "to_ts", "name", "n"]
    assert sorted((r.name, r.n) for r in found.collect()) == sorted([(f"w{k}", k + 1) for k in range(40)] * 2 + [("inside", 2), ("no rows", 0), ("no key", 0)])


def test_revision_study_by_modes(spark):
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), dt.datetime(2024, 2, 20), 3.0 if h < 800 else 1.0, 1.0, 2.0) for h in range(1200)]
    df = spark.createDataFrame(rows, "k string, target timestamp, clock timestamp, v double, r double, o double")
    found = maintenance.revision_study(df, ["k"], "target", "clock", "v", "r", "o", 16.67, min_rows=50, least=50, low=3.0, high=40.0)
    assert found["confirm"].first().verdict == "CONFIRMED" and abs(found["boundary"].first().split - 16.67) < 0.5 and found["exposure"].first().n == 1200
    assert set(maintenance.revision_study(df, ["k"], "target", "clock", "v", "r", "o", 16.67, ("exposure", "sweep"))) == {"exposure", "sweep"}
    assert {"boundary_profile", "spot", "spot_effects", "spot_verdict", "spot_samples", "spot_detectable"} < set(found)
    with pytest.raises(ValueError):
        maintenance.revision_study(df, ["k"], "target", "clock", "v", "r", "o", 16.67, ("all",))


def test_secrets(spark):
    cases = {
        "GET /x?access_token=abcdef&b=1": "GET /x?access_token=***&b=1",
        "auth_token=q1 (clientx) client_secret=zz)": "auth_token=*** (clientx) client_secret=***)",
        "{'securityToken': 'abc-1', \"passwd\": \"x\"}": "{'securityToken': '***', \"passwd\": \"***\"}",
        "SECURITYTOKEN=AA'": "SECURITYTOKEN=***'",
        "broken_tokens=3": "broken_tokens=3",
        "the value long-literal-1 here": "the value *** here",
    }
    df = spark.createDataFrame([(k,) for k in [*cases, None]], "t string")
    once = df.select("t", text.redact(F.col("t"), ("long-literal-1",)).alias("a")).withColumn("b", text.redact(F.col("a"), ("long-literal-1",)))
    assert {r.t: r.a for r in once.collect()} == cases | {None: None} and all(r.a == r.b for r in once.collect())
    with pytest.raises(ValueError):
        text.redact(F.col("t"), ("short",))


def test_tables_by_name():
    assert quality.allowed_table("energy_renewable") == "energy_renewable"
    for name in ("energy_load; drop", "/tmp/x", "ENERGY_LOAD"):
        with pytest.raises(ValueError):
            quality.allowed_table(name)


def test_totals_and_negatives(spark):
    df = spark.createDataFrame([(1, 10.0, 4.0, 6.05), (2, 10.0, 4.0, None), (3, -1.0, -1.0, 0.0)], "k int, total double, a double, b double")
    assert [r.k for r in quality.totals_off(df, "total", ["a", "b"]).collect()] == [2]
    assert {(r["column"], r.n, r.least) for r in quality.negatives(df, ["a", "b"]).collect()} == {("a", 1, -1.0)}


def test_placebos_lie_inside_one_band(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), 2.0 if h >= 480 else 1.0) for h in range(960)]
    df = spark.createDataFrame(rows, "ts timestamp, v double")
    found = revision.split_effects(df, "ts", "v", ["2024-01-03", "2024-01-11", "2024-01-21", "2024-01-30"], 5, ("2024-01-01", "2024-02-09"))
    assert {r.split.day for r in found.collect()} == {11, 21, 30}
    verdict = revision.placebo_verdict(found, "2024-01-21", 100).first()
    assert verdict.is_effect and verdict.placebos == 2 and revision.placebo_verdict(found, "2024-01-21").first().is_effect is None


def test_metrics_of_a_perfect_forecast(spark):
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(h % 7), float(h % 7)) for h in range(100)]
    row = reports.forecast_metrics(spark.createDataFrame(rows, "k string, ts timestamp, y double, f double"), ["k"], "ts", "y", "f").first()
    assert (row.mae, row.mape, row.direction, row.skill_persistence) == (0.0, 0.0, 100.0, 1.0)


def test_zone_ids(spark):
    df = spark.createDataFrame([("x", "solar", 1), ("y", "solar", 1), ("y", "solar", 2)], "country string, technology string, rank_in_key int")
    assert {(r.country, r.zone_id) for r in zones.with_zone_id(df, ["country", "technology"]).collect()} == {("x", "solar_country"), ("y", "solar_1"), ("y", "solar_2")}


def test_units(spark):
    df = spark.createDataFrame([(20.0, 50.0)], "temperature_2m double, cloud_cover_low double")
    warm = {v: how for v, how in rg.weather_units(kelvin=True).items() if v in df.columns}
    row = shape.convert_units(df, warm).first()
    assert (row.temperature_2m_k, row.cloud_cover_low_frac) == (293.15, 0.5)
