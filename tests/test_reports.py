"""Reports on rows with nulls, gaps and unknown names, and on empty tables."""

import datetime as dt

from pyspark.sql import functions as F

from gridspark.operators import reports as rp


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_pair_ratio_counts_rows_without_an_instant(spark):
    df = spark.createDataFrame([(at(1), 2.0, 1.0), (at(3), 8.0, 2.0), (None, 5.0, 5.0)], "ts timestamp_ntz, a double, b double")
    got = rp.pair_ratio(df, "ts", "a", "b", "2024-01-02 00:00:00").first()
    assert (got.n, got.excluded, got.ratio_before, got.ratio_after, got.effect) == (2, 1, 2.0, 4.0, 2.0)
    empty = rp.pair_ratio(df.limit(0), "ts", "a", "b", "2024-01-02 00:00:00").first()
    assert (empty.n, empty.effect) == (0, None)


def test_naive_skill_takes_no_absent_hour(spark):
    df = spark.createDataFrame([("a", at(1, 0), 1.0), ("a", at(1, 1), 3.0), ("a", at(1, 5), 9.0), ("a", at(2, 0), 2.0)], "k string, ts timestamp_ntz, v double")
    got = rp.naive_skill(df, ["k"], "ts", "v").first()
    assert (got.n_previous, got.mae_previous, got.bias_previous) == (1, 2.0, -2.0)
    assert (got.n_seasonal, got.mae_seasonal) == (1, 1.0)


def test_grid_and_names(spark):
    nations = spark.createDataFrame([(1, "x"), (2, "y")], "k int, name string")
    facts = spark.createDataFrame([(1, "p", 2.5), (1, "p", None)], "k int, kind string, v double")
    grid = {(r.k, r.kind): (r.n, r.value_sum) for r in rp.coverage_grid(facts, nations, "k", "kind", ["p", "q"], "v").collect()}
    assert grid == {(1, "p"): (2, 2.5), (1, "q"): (0, 0.0), (2, "p"): (0, 0.0), (2, "q"): (0, 0.0)}
    found, missing = rp.resolve(spark.createDataFrame([("y",), ("z",)], "name string"), "name", nations, "k")
    assert [tuple(r) for r in found.collect()] == [("y", 2)] and [r.name for r in missing.collect()] == ["z"]


def test_completeness_document_of_a_member_without_rows(spark):
    nations = spark.createDataFrame([(1,), (2,)], "k int")
    facts = spark.createDataFrame([(1, at(1)), (1, at(4))], "k int, ts timestamp_ntz")
    got = rp.completeness_document(facts, nations, "k", "ts").withColumn("d", F.from_json("document", "has_data boolean, record_count long, completeness double"))
    assert {r.k: tuple(r.d) for r in got.collect()} == {1: (True, 2, 50.0), 2: (False, 0, 0.0)}
