"""Bounds of forecasts, writes in place, pulls by rows, lookups that must succeed, streams whose state is freed."""

import datetime as dt
import os
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridspark.functions import registries as rg
from gridspark.jobs import maintenance, market, weather
from gridspark.operators import quality, reports, revision, shape, text, timeseries
from gridspark.sources import readers, sinks
from gridspark.streaming import jobs


def at(day, hour=0, month=1):
    return dt.datetime(2024, month, day, hour)


def document(*series, created="2024-01-01T00:00:00Z"):
    body = "".join(
        f"<TimeSeries>{f'<businessType>{kind}</businessType>' if kind else ''}<Period><timeInterval><start>2024-01-08T00:00Z</start><end>2024-01-10T00:00Z</end></timeInterval><resolution>P1D</resolution>"
        + "".join(f"<Point><position>{p}</position><quantity>{q}</quantity></Point>" for p, q in points)
        + "</Period></TimeSeries>"
        for kind, points in series
    )
    return f"<GL_MarketDocument><createdDateTime>{created}</createdDateTime>{body}</GL_MarketDocument>"


def bounds(spark, *documents):
    rows = market.load_forecast(spark.createDataFrame([("AT", d) for d in documents], "country string, xml string"), week_ahead=True)["rows"].collect()
    return {r.ts.day: (r.value_min, r.value_max, r.value_mid) for r in rows}


def test_week_ahead_bounds_in_all_cases(spark):
    assert bounds(spark, document(("A60", [(1, 10), (2, 20)]), ("A61", [(1, 30), (2, 40)]))) == {8: (10, 30, 20), 9: (20, 40, 30)}
    assert bounds(spark, document(("B11", [(1, 30)]), ("B10", [(1, 10)]))) == {8: (10, 30, 20)}
    assert bounds(spark, document(("A04", [(1, 7)]), (None, [(1, 9), (2, 5)]))) == {8: (7, 7, 7), 9: (5, 5, 5)}  # the first untyped one
    assert bounds(spark, document((None, [(1, 7), (2, 8)]), ("A60", [(1, 3)]))) == {8: (3, 7, 5), 9: (8, 8, 8)}
    assert bounds(spark, document(("A61", [(1, 9)]), (None, [(1, 7)]))) == {8: (7, 9, 8)}
    assert bounds(spark, document(("A60", [(1, 3)]))) == {8: (3, 3, 3)} and bounds(spark, document(("A61", [(1, 4)]))) == {8: (4, 4, 4)}
    assert bounds(spark, document(("A60", [(1, 3)]), ("B10", [(1, 4)]))) == {8: (4, 4, 4)}  # the last typed one
    assert bounds(spark, document(("A60", [(1, 3)]), ("A61", [(1, 5)])), document(("A61", [(1, 9)]), created="2024-01-02T00:00:00Z")) == {8: (9, 9, 9)}  # a newer document as a whole
    assert bounds(spark, document()) == {} and bounds(spark, "no xml") == {}


def test_first_series_of_a_type_stays(spark):
    rows = [("d", "B16", 2, "Actual Aggregated", 5.0), ("d", "B16", 1, "Actual Aggregated", 7.0), ("d", "B16", 0, "Actual Consumption", 1.0), ("d", "B10", 3, "Actual Consumption", 2.0), ("e", "B16", 2, "Actual Aggregated", None)]
    found = shape.prefer_aggregated(spark.createDataFrame(rows, "doc string, kind string, series int, side string, v double"), ["doc", "kind"], "side", "series")
    assert {(r.doc, r.kind, r.v) for r in found.collect()} == {("d", "B16", 7.0), ("e", "B16", None)}


@pytest.mark.parametrize("job", ["load", "generation"])
def test_a_document_is_parsed_once(spark, job):
    docs = spark.createDataFrame([("AT", document(("A04", [(1, 0), (2, 5)])))], "country string, xml string")
    found = market.load(docs)["rows"] if job == "load" else market.generation(docs)["generation"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("xmltostructs") + plan.count("from_xml") <= (1 if job == "load" else 2)  # values and stamps of generation are two results


def months(path):
    return {p.name: {f.name: f.stat().st_mtime_ns for f in p.iterdir() if f.suffix == ".parquet"} for p in Path(path).iterdir() if p.name.startswith("month=")}


def test_rows_are_deleted_in_place(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [("a", at(1, 3), 1.0), ("a", at(1, 5), None), ("a", at(1, 9), None), ("a", at(2), None), ("b", at(1, month=2), 2.0), ("b", at(5, month=3), None), ("c", None, None), ("c", None, 1.0)]
    sinks.write_months(spark.createDataFrame(rows, "k string, ts timestamp, v double"), path, "ts")
    before = months(path)
    want = timeseries.null_day_ranges(spark.createDataFrame(rows, "k string, ts timestamp, v double"), ["k"], "ts", "v").collect()
    assert Counter(sinks.delete_rows(spark, path, "v", ["k"], "ts").collect()) == Counter(want)
    after = months(path)
    assert after["month=2024-02"] == before["month=2024-02"] and after["month=2024-01"] != before["month=2024-01"] and "month=2024-03" not in after
    assert Counter((r.k, r.ts, r.v) for r in spark.read.parquet(path).collect()) == Counter(r for r in rows if r[2] is not None)
    assert sinks.delete_rows(spark, path, "v", ["k"], "ts").count() == 0 and months(path) == after
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_pull_in_batches_of_rows(spark, tmp_path):
    frame = lambda ids: spark.createDataFrame([(i, f"x{i}") for i in ids], "id long, v string")
    path, hour = str(tmp_path / "copy"), 3_600_000_000
    sparse = [k * 2 * hour for k in range(1, 4)]
    assert sinks.row_bounds(frame(sparse), "id", 1000) == sparse[-1:] and sinks.row_bounds(frame([]), "id", 5) == []
    assert [sinks.pull(spark, frame(ids), path, ["id"], "id") for ids in (sparse, sparse, [*sparse, 9 * hour], [])] == [3, 0, 1, 0]
    assert Counter(r.id for r in spark.read.parquet(path).collect()) == Counter([*sparse, 9 * hour])
    many = spark.range(50_000).select((F.col("id") * F.col("id") * 7).alias("id"))
    ends = sinks.row_bounds(many, "id", 4000)
    held = many.groupBy(F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e < F.col("id"))).alias("k")).count().collect()
    assert max(r["count"] for r in held) <= 4000 and len(ends) <= 17 and ends == sorted(set(ends))
    assert sinks.pull(spark, many, str(tmp_path / "many"), ["id"], "id", 20_000) == 50_000
    assert spark.read.parquet(str(tmp_path / "many")).distinct().count() == 50_000
    assert sinks.seed(spark, frame([1, 2, 1]), str(tmp_path / "dim"), ["id"]) == 2 and sinks.seed(spark, frame([2, 3]), str(tmp_path / "dim"), ["id"]) == 1
    assert sinks.refresh(spark, frame([1]), str(tmp_path / "full")) == 1 and sinks.refresh(spark, frame([1, 2]), str(tmp_path / "full")) == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["copy", "dim", "full", "many"]


def test_a_write_counts_what_it_rejects(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2.0), (2, None), (None, 1.0), (4, 4.0)], "k int, v double").repartition(3)
    before = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("guarded", "guarded")
    assert sinks.write_guarded(rows, quality.has_all(["k", "v"]), str(tmp_path / "t")) == {"accepted": 2, "rejected": 2}
    jobs_run = [j for j in before.getJobIdsForGroup("guarded")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.k for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {1, 4} and len(jobs_run) <= 2  # the shuffle is a job of its own under adaptive execution


def test_lookups_that_must_succeed(spark):
    places = spark.createDataFrame([("AT", "w1", 5), ("AT", "w2", None)], "country string, zone string, id int")
    asked = lambda *keys: spark.createDataFrame([(*k, 1) for k in keys], "country string, zone string, n int")
    found = reports.resolved(asked(("AT", "w1"), ("AT", "w2")), ["country", "zone"], places, "id")
    assert {(r.zone, r.id) for r in found.collect()} == {("w1", 5), ("w2", None)}
    for key, said in ((("AT", "w9"), "AT, w9"), (("AT", None), "AT, NULL")):
        with pytest.raises(Exception, match=f"no id for .{said}"):
            reports.resolved(asked(("AT", "w1"), key), ["country", "zone"], places, "id").collect()


def test_nested_documents_survive_their_files(spark, tmp_path):
    facts = [("AT", "solar", 1.25, None, None), ("AT", "solar", 2.0, None, None), ("AT", "solar", None, 1, True), ("AT", "wind", 3.0, None, None), ("AT", "wind", None, 1, False), ("BE", "wind", None, 1, True), ("BE", "wind", None, 2, True)]
    members = spark.createDataFrame([("AT", "Austria"), ("BE", "Belgium"), ("CH", None)], "iso string, name string")
    made = reports.coverage_document(members, spark.createDataFrame(facts, "iso string, kind string, mw double, zone int, whole boolean"), "iso", "name", "kind", ["solar", "wind"], "mw", "zone", "whole")
    sinks.write_documents(made, str(tmp_path / "r"))
    again = spark.read.schema(made.schema).json(str(tmp_path / "r"))
    flat = lambda df: {(r.iso, r.name): {k: tuple(v) for k, v in r.kinds.items()} for r in df.collect()}
    none = (0, 0.0, 0, False)
    assert flat(again) == flat(made) == {("AT", "Austria"): {"solar": (2, 3.3, 1, True), "wind": (1, 3.0, 1, False)}, ("BE", "Belgium"): {"solar": none, "wind": (0, 0.0, 2, False)}, ("CH", None): {"solar": none, "wind": none}}


def test_members_and_the_whole_in_one_pass(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 8.0)], "k string, v double")
    assert {(r.k, r.is_whole, r.m) for r in reports.grouped_with_whole(df, ["k"], {"m": F.avg("v")}).collect()} == {("a", False, 2.0), (None, False, 8.0), (None, True, 4.0)}


def test_borders_from_the_edges_of_zones(spark):
    zones = spark.createDataFrame([("DK", "DK_1"), ("DK", "DK_2")], "country string, zone string")
    edges = spark.createDataFrame([("DK_1", "SE_3"), ("SE_3", "DK_1"), ("DE_LU", "DK_1"), ("DK_2", "SE_4"), ("FR", "BE")], "a string, b string")
    found = reports.border_requests(spark.createDataFrame([("DK",), ("FR",), ("IS",)], "country string"), zones, edges)
    assert sorted(map(tuple, found.collect())) == [("DK", "DE_LU"), ("DK", "SE_3"), ("DK", "SE_4"), ("FR", "BE")]


def test_requests_and_pieces(spark):
    batches = reports.request_batches(spark.range(337).withColumn("source", F.lit("x")), ["source"], "id", 50).orderBy("batch").collect()
    assert [len(r.members) for r in batches] == [50] * 6 + [37] and [m for r in batches for m in r.members] == list(range(337))
    spans = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 15)), (dt.date(2024, 1, 5), dt.date(2024, 1, 5)), (dt.date(2024, 1, 9), dt.date(2024, 1, 2))], "a date, b date")
    found = sorted((r.chunk_start.day, r.chunk_end.day) for r in timeseries.inclusive_chunks(spans, "a", "b").collect())
    assert found == [(1, 7), (5, 5), (8, 14), (15, 15)]


def test_single_places_and_stored_means(spark, tmp_path):
    body = '{"hourly": {"time": ["2024-01-01T00:00"], "wind_direction_100m": [90], "wind_speed_80m": [8], "wind_speed_120m": [12], "temperature_2m": [1]}}'
    row = readers.single_point_rows(spark.createDataFrame([("BE", body)], "country string, body string"), "body", rg.point_units()).first()
    assert (row.wind_direction_100m_deg, row.wind_speed_80m_ms, row.wind_speed_120m_ms, row.temperature_2m_k, row.rain_mm) == (90, 8, 12, 274.15, None)
    frame = lambda v: spark.createDataFrame([("BE", "wind", at(1), v, 2)], "country string, kind string, valid_at timestamp, t double, n_points int")
    for v in (1.0, 2.0):
        weather.store_multipoint(spark, frame(v), str(tmp_path / "m"))
    assert [r.t for r in spark.read.parquet(str(tmp_path / "m")).collect()] == [2.0]


def test_secrets_whatever_they_start_with(spark):
    cases = {"password=*abc&x": "password=***&x", "password=***": "password=***", "token=****": "token=***", "x 'api_key' : \"a'b\"": "x 'api_key' : \"***\"", "Secret = \"a b\"": "Secret = \"***\"", "token=": "token="}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", text.redact(F.col("t")).alias("a")).withColumn("b", text.redact(F.col("a"))).collect()
    assert {r.t: r.a for r in rows} == cases and all(r.a == r.b for r in rows)


def test_small_keys_have_no_boundary_and_placebos_need_more_than_the_least(spark):
    rows = [(k, 3.0 if a < 20 else 1.0, 1.0, a) for k, n in (("few", 799), ("many", 800)) for i in range(n) for a in [i * 40.0 / n]]
    df = spark.createDataFrame(rows, "k string, v double, r double, age double")
    assert [r.k for r in revision.step_detector(df, ["k"], "v", "r", F.col("age"), half=7.0, least=200, low=18.0, high=22.0).collect()] == []  # 140 rows a side are too few
    df = df.unionByName(df.filter("k = 'many'"))
    found = revision.step_detector(df, ["k"], "v", "r", F.col("age"), half=7.0).collect()
    assert [(r.k, r.is_boundary) for r in found] == [("many", True)] and abs(found[0].split - 20) <= 0.25
    effects = spark.createDataFrame([(at(1), 1.5, 1001, 1001), (at(2), 1.01, 1001, 1001), (at(3), 1.4, 1000, 5000)], "split timestamp_ntz, effect double, n_before int, n_after int")
    verdict = revision.placebo_verdict(effects, "2024-01-01").first()
    assert verdict.placebos == 1 and verdict.is_effect


def test_spot_check_of_a_session(spark):
    start, wrote = dt.datetime(2023, 8, 1), dt.datetime(2024, 1, 28)
    rows = [(start + dt.timedelta(hours=h), wrote, (1.2 if start + dt.timedelta(hours=h) >= dt.datetime(2024, 1, 8) else 1.0) * (1 + (h % 24) / 1000), 1.0) for h in range(180 * 24)]
    df = spark.createDataFrame(rows, "target timestamp, clock timestamp, v double, r double")
    found = maintenance.spot_check(df, "target", "clock", "v", "r", 20.0, least=400)
    verdict = found["spot_verdict"].first()
    assert verdict.is_effect and verdict.placebos == 5 and abs(verdict.real_shift - 0.2 / 1.2) < 0.45
    assert found["spot_samples"].count() == 2 and 0 < found["spot_detectable"].first().min_detectable_effect < 0.05
    assert set(maintenance.spot_check(df.limit(0), "target", "clock", "v", "r", 20.0)) == {"spot"}


def source(spark, folder, batches, schema):
    """A folder of files that a stream takes one by one, in order."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for f in Path(folder).glob("*.parquet"):
            if f.stat().st_mtime > 1_000_000_000 + 100 * len(batches):
                os.utime(f, (1_000_000_000 + 100 * k,) * 2)
    return spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(stream, folder, mode="append"):
    query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]


def test_late_rows_are_dropped_and_state_is_freed(spark, tmp_path):
    schema = "k string, ts timestamp, v double"
    batches = [[("a", at(1, h), 1.0) for h in range(20)], [("a", at(21), 2.0)], [("a", at(21, 1), 2.0)], [("a", at(13, 0), 9.0), ("a", at(15), 4.0)], [("a", at(29, 1), 3.0)]]
    stream = source(spark, str(tmp_path / "in"), batches, schema)
    state = run(jobs.hourly_mean(stream, ["k"], "ts", "v"), str(tmp_path))
    rows = {(r.ts, r.mean_value) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows == {(at(1, h), 1.0) for h in range(20)} | {(at(15), 4.0), (at(21), 2.0), (at(21, 1), 2.0)}  # the row 8 days late is in none
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 1
    assert max(s["numRowsTotal"] for s in state) <= 21 and state[-1]["numRowsTotal"] == 1
    sessions = run(jobs.sessions(stream, ["k"], "ts"), str(tmp_path / "s"))
    assert sum(s["numRowsDroppedByWatermark"] for s in sessions) == 1 and sessions[-1]["numRowsTotal"] == 1
    assert {r.n for r in spark.read.parquet(str(tmp_path / "s/out")).collect()} == {20, 2, 1}


def test_keys_that_are_not_seen_leave_the_state(spark, tmp_path):
    schema = "k string, ts timestamp, v double"
    batches = [[("a", at(1), 1.0), ("b", at(1), 5.0), ("a", at(2), 2.0), ("b", at(1), 7.0)], [("b", at(20), 6.0), ("b", at(19), 9.0)], [("c", at(9, month=2), None)], [("c", at(10, month=2), 8.0)]]
    stream = source(spark, str(tmp_path / "in"), batches, schema)

    def write(df, batch):
        df.write.mode("overwrite").parquet(str(tmp_path / f"out/b={batch}"))

    with jobs.large_state(spark):
        query = jobs.latest(stream, ["k"], "ts", ["v"], keep_days=20).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    last = {}
    for r in sorted(spark.read.parquet(str(tmp_path / "out")).collect(), key=lambda r: r.b):
        last[r.k] = (r.ts, r.v)
    assert last == {"a": (at(2), 2.0), "b": (at(20), 6.0), "c": (at(10, month=2), 8.0)}
    assert kept[-1] == 2 and max(kept) == 3  # the key of January 2 is gone


def test_observed_bands_of_a_stream(spark, tmp_path):
    stream = source(spark, str(tmp_path / "in"), [[("a", 1.0), ("b", 9.0)], [("c", 20.0), ("d", None), ("e", 7.0)]], "k string, age double")
    found = jobs.late_rows(spark, stream, F.col("age"), (7, 14), str(tmp_path / "out"))
    assert sorted(map(tuple, found.collect())) == [(0, "<14", 1), (0, "<7", 1), (1, "<14", 1), (1, ">=14", 1)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
