"""Facts that decide correctness, on small rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridspark.operators import completeness, quality, revision, shape, snapshots, text, timeseries, zones
from gridspark.sources import readers, sinks
from gridspark.streaming import jobs

H = lambda h, d=1: dt.datetime(2026, 8, d, h)


def test_drop_unpublished_zeros(spark):
    rows = [("a", H(h), 0.0) for h in range(24)] + [("b", H(0), 0.0), ("b", H(1), None), ("c", H(0), -20.0), ("c", H(1), 0.0)]
    df = spark.createDataFrame(rows, "doc string, ts timestamp, v double")
    published = spark.createDataFrame([("a", H(0)), ("b", H(5)), ("c", H(0))], "doc string, ts timestamp")
    kept = quality.drop_unpublished_zeros(df, published, "doc", "ts", "v").collect()
    assert sorted((r.doc, r.ts.hour, r.v) for r in kept if r.doc != "b") == [("a", 0, 0.0), ("c", 0, -20.0)]
    assert len([r for r in kept if r.doc == "b"]) == 2  # another grid: everything stays


def test_blank_unpublished_zeros_by_series(spark):
    rows = [("a", s, H(h), 0.0 if s == "nuclear" else 5.0) for s in ("nuclear", "gas") for h in range(24)]
    df = spark.createDataFrame(rows, "doc string, s string, ts timestamp, v double")
    published = df.filter((F.col("s") == "gas") | (F.hour("ts") == 0))
    out = quality.blank_unpublished_zeros(df, published, "doc", ["s"], "ts", "v")
    assert out.filter("v is null").count() == 23 and out.filter("s = 'gas' and v = 5").count() == 24


def test_netting(spark):
    rows = [(1, "aggregated", 12.25), (1, "consumption", 70.5), (2, "consumption", 8.0), (3, "aggregated", None), (4, "aggregated", 31.0)]
    out = shape.net_sides(spark.createDataFrame(rows, "k int, side string, v double"), ["k"], "side", "v")
    assert {r.k: r.net_value for r in out.collect()} == {1: -58.25, 2: -8.0, 3: None, 4: 31.0}


def test_mapping_keeps_null(spark):
    rows = [(1, "Solar", 0.0), (1, "Nuclear", None)]
    out = shape.map_wide(spark.createDataFrame(rows, "k int, n string, v double"), ["k"], "n", "v", {"Solar": "solar", "Nuclear": "nuclear", "Waste": "waste"}).first()
    assert (out.solar, out.nuclear, out.waste) == (0.0, None, None)


def test_resample_leaves_gaps(spark):
    df = spark.createDataFrame([("FR", H(0), 100.0), ("FR", H(3), 400.0)], "k string, ts timestamp, v double")
    hourly = timeseries.resample_mean(df, ["k"], "ts", "v")
    assert hourly.count() == 2 and timeseries.gap_counts(hourly, ["k"]).first().gaps == 2


def test_gap_at_threshold(spark):
    df = spark.createDataFrame([("a", H(0)), ("a", H(6)), ("a", dt.datetime(2026, 8, 1, 12, 0, 1))], "k string, ts timestamp")
    assert [r.last_seen.hour for r in timeseries.gaps(df, ["k"], "ts", 6 * 3600).collect()] == [6]


def test_month_short_by_an_hour_is_no_hole(spark):
    hours = [("x", dt.datetime(2026, m, 1) + dt.timedelta(hours=h)) for m, n in ((1, 744), (2, 671), (4, 720)) for h in range(n)]
    out = completeness.month_completeness(spark.createDataFrame(hours, "k string, ts timestamp"), ["k"], "ts").collect()
    assert [(r.month.month, r.kind) for r in out] == [(3, "MISSING")]


def test_as_of_ties_and_bounds(spark):
    rows = [(1, H(5), H(1), 1), (1, H(5), H(2), 2), (1, H(5), H(2), 3), (1, H(5), H(4), 4)]
    df = spark.createDataFrame(rows, "k int, valid timestamp, known timestamp, v int")
    at = lambda c: [r.v for r in snapshots.as_of(df, ["k"], "valid", "known", c, tie_break=("v",)).collect()]
    assert (at("2026-08-01 00:30:00"), at("2026-08-01 02:00:00"), at(None)) == ([], [3], [4])


def test_week_envelope(spark):
    rows = [(1, "min", 2.0), (1, "max", 6.0), (2, "max", 5.0)]
    out = shape.min_max_envelope(spark.createDataFrame(rows, "k int, kind string, v double"), ["k"], "kind", "v")
    assert {r.k: (r.value_min, r.value_max, r.value_mid) for r in out.collect()} == {1: (2.0, 6.0, 4.0), 2: (5.0, 5.0, 5.0)}


def test_market_document(spark):
    point = "<Point><position>{}</position><quantity>{}</quantity></Point>"
    period = "<Period><timeInterval><start>2026-08-01T22:00Z</start></timeInterval><resolution>{}</resolution>{}</Period>"
    body = period.format("PT15M", point.format(1, 5) + point.format(0, 9)) + period.format("nonsense", point.format(1, 1))
    rows = [("d", f'<GL_MarketDocument xmlns="urn:x"><createdDateTime>2026-08-06T16:44:47Z</createdDateTime><TimeSeries><MktPSRType><psrType>B16</psrType></MktPSRType>{body}</TimeSeries></GL_MarketDocument>'), ("e", "not xml at all"), ("f", None)]
    out = readers.market_points(spark.createDataFrame(rows, "doc_id string, xml string")).collect()
    assert [(r.doc_id, r.production_type, r.side, r.ts, r.quantity) for r in out] == [("d", "Solar", "aggregated", dt.datetime(2026, 8, 1, 22), 5.0)]


def test_durations(spark):
    texts = ["PT15M", "PT30M", "PT60M", "PT1M", "PT24H", "P1D", "P7D", " PT60M ", "", "PT", "P1Y"]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select(readers.duration_seconds(F.col("t")).alias("s")).collect()
    assert [r.s for r in out] == [900, 1800, 3600, 60, 86400, 86400, 604800, 3600, None, None, None]


def test_writes_are_idempotent(spark, tmp_path):
    path = f"file://{tmp_path}/load"
    batch = spark.createDataFrame([("BE", H(0), 1.0), ("BE", H(1), 2.0)], "k string, ts timestamp, v double")
    for _ in range(2):
        sinks.merge_into(spark, path, batch, ["k", "ts"], "ts", ["v"])
    sinks.merge_into(spark, path, batch.filter("v = 1").withColumn("v", F.lit(9.0)), ["k", "ts"], "ts", ["v"])
    sinks.merge_into(spark, path, batch.withColumn("v", F.lit(7.0)), ["k", "ts"], "ts", ["v"], first_wins=True)
    assert sorted((r.ts.hour, r.v) for r in spark.read.parquet(path).collect()) == [(0, 9.0), (1, 2.0)]


def test_small_contracts(spark):
    with pytest.raises(ValueError, match="b"):
        quality.require_columns(spark.range(1), ["id", "b"])
    with pytest.raises(ValueError):
        text.redact(F.lit("x"), ("short",))
    once = spark.createDataFrame([("u?token=abc&x=1",), (None,)], "t string").select(text.redact(F.col("t")).alias("t"))
    assert [r.t for r in once.select(text.redact(F.col("t")).alias("t")).collect()] == ["u?token=***&x=1", None]
    km = spark.range(1).select(zones.haversine_km(*(F.lit(x) for x in (50.85, 4.35, 48.85, 2.35))).alias("d")).first().d
    assert 250 < km < 275
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert quality.null_nan(nan, ["v"]).filter("v is null").count() == 1
    assert revision.age_days("a", "b") is not None


def test_stream_results_are_files(spark, tmp_path):
    schema = "id long, ts timestamp"
    stream = lambda name: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
    for _ in range(3):  # three micro-batches, each with the same and one new id
        n = len(list(tmp_path.glob("t/*.parquet")))
        spark.createDataFrame([(0, H(1)), (n + 1, H(2))], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
    once = jobs.collected(spark, jobs.dedupe(stream("t"), ["id"], "ts"), "append")
    assert sorted(r.id for r in once.collect()) == [0, 1, 2, 3] and once.inputFiles()
    counted = jobs.collected(spark, stream("t").groupBy("id").count(), "complete")
    assert {r.id: r["count"] for r in counted.collect()} == {0: 3, 1: 1, 2: 1, 3: 1} and counted.inputFiles()
    (tmp_path / "none").mkdir()
    assert jobs.collected(spark, stream("none"), "append").count() == 0
