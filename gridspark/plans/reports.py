"""Registered queries of reports, lookups and upserts by stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import completeness as cp
from ..operators import reports as rp
from ..operators import shape as sh
from ..operators import timeseries as ts
from ..sources.sinks import scratch_folder
from ..streaming import jobs
from .catalog import _SQL, _query


@_query("SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_shipdate) AS first_at, max(l_shipdate) AS last_at, count(DISTINCT date_trunc('month', l_shipdate)) AS months FROM lineitem GROUP BY ALL")
def range_summary(t):
    return rp.range_summary(t("lineitem"), ["l_returnflag", "l_linestatus"], "l_shipdate")


@_query(f"SELECT event_type, count(*) AS n, min(ts) AS first_at, max(ts) AS last_at, sum(value) / count(value) AS mean_value FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY ALL", digits="mean_value")
def source_row_counts(t):
    return rp.source_counts(t("events"), ["event_type"], "ts", "value", "2024-01-15 00:00:00")


#: The market segments of the customers.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@_query(f"SELECT n_nationkey AS c_nationkey, s AS c_mktsegment, count(c_custkey) AS n, coalesce(sum(c_acctbal), 0) AS value_sum FROM nation CROSS JOIN (SELECT unnest({SEGMENTS}) AS s) LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = s GROUP BY ALL", digits="value_sum")
def coverage_grid(t):
    nations = t("nation").select(F.col("n_nationkey").alias("c_nationkey"))
    return rp.coverage_grid(t("customer"), nations, "c_nationkey", "c_mktsegment", SEGMENTS, "c_acctbal")


@_query(f"SELECT event_type, CAST(a AS DATE) AS day, count(*) AS runs, CAST(sum(k) AS BIGINT) AS n_rows, min(a) AS first_at, max(b) AS last_at, (epoch_us(max(b)) - epoch_us(min(a))) / 1000000::DOUBLE AS wall_seconds, sum(v) AS latest_total FROM (SELECT event_type, user_id, count(*) AS k, min(ts) AS a, max(ts) AS b, max_by(value, (ts, event_id)) AS v FROM events GROUP BY event_type, user_id, CAST(ts AS DATE)) GROUP BY ALL", digits="latest_total")
def run_accounting(t):
    rows = t("events").withColumn("day", F.to_date("ts"))
    return rp.run_accounting(rows, ["event_type", "day"], "user_id", "ts", ["event_id"], "value").withColumn("wall_seconds", F.round("wall_seconds", 6))


_PAIRED = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"


def _ratio(side: str) -> str:
    return f"CAST(sum(l_extendedprice) FILTER (WHERE {side}) AS DOUBLE) / CAST(sum(l_quantity * p_retailprice) FILTER (WHERE {side}) AS DOUBLE)"


_SPLIT = "TIMESTAMP '1996-07-15'"


@_query(f"SELECT *, ratio_after / ratio_before AS effect FROM (SELECT count(l_shipdate) AS n, count(*) FILTER (WHERE l_shipdate IS NULL) AS excluded, {_ratio(f'l_shipdate < {_SPLIT}')} AS ratio_before, {_ratio(f'l_shipdate >= {_SPLIT}')} AS ratio_after FROM {_PAIRED} WHERE o_orderdate >= TIMESTAMP '1996-05-01' AND o_orderdate < TIMESTAMP '1996-06-01')", digits="ratio_before ratio_after effect")
def session_pair_ratio(t):
    session = t("orders").filter("o_orderdate >= timestamp_ntz '1996-05-01' and o_orderdate < timestamp_ntz '1996-06-01'")
    rows = t("lineitem").join(session, F.col("l_orderkey") == F.col("o_orderkey")).join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return rp.pair_ratio(rows.withColumn("expected", F.col("l_quantity") * F.col("p_retailprice")), "l_shipdate", "l_extendedprice", "expected", "1996-07-15 00:00:00")


@_query("SELECT l_returnflag, count(*) AS n, avg(CASE WHEN abs(l_tax - l_discount) < 0.001 THEN 1 ELSE 0 END) AS share_equal FROM lineitem GROUP BY ALL")
def surrogate_rate(t):
    return rp.surrogate_rate(t("lineitem"), ["l_returnflag"], "l_tax", "l_discount", 0.001)


_MISS = "(l_extendedprice - l_quantity * p_retailprice)"


@_query(f"SELECT CASE WHEN l_discount < 0.03 THEN 'low' WHEN l_discount <= 0.07 THEN 'middle' ELSE 'high' END AS regime, count(*) AS n, sum(abs({_MISS})) / count(*) AS mae, sqrt(sum({_MISS} * {_MISS}) / count(*)) AS rmse, sum({_MISS}) / count(*) AS bias FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity * p_retailprice > 1000 GROUP BY ALL", digits="mae rmse bias")
def skill_by_regime(t):
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    regime = F.when(F.col("l_discount") < 0.03, "low").when(F.col("l_discount") <= 0.07, "middle").otherwise("high")
    return rp.skill(rows.withColumn("regime", regime), ["regime"], F.col("l_extendedprice"), F.col("l_quantity") * F.col("p_retailprice"), 1000.0)


def _naive(e: str, name: str) -> str:
    return f"count({e}) AS n_{name}, sum(abs({e})) / count({e}) AS mae_{name}, sqrt(sum({e} * {e}) / count({e})) AS rmse_{name}, sum({e}) / count({e}) AS bias_{name}"


@_query(f"WITH h AS (SELECT event_type, CAST(epoch(date_trunc('hour', ts)) / 3600 AS BIGINT) AS h, sum(value) / count(value) AS v FROM events GROUP BY ALL), e AS (SELECT event_type, max(v) OVER (PARTITION BY event_type ORDER BY h RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) - v AS e1, max(v) OVER (PARTITION BY event_type ORDER BY h RANGE BETWEEN 24 PRECEDING AND 24 PRECEDING) - v AS e24 FROM h) SELECT event_type, {_naive('e1', 'previous')}, {_naive('e24', 'seasonal')} FROM e GROUP BY ALL", digits="mae_previous rmse_previous bias_previous mae_seasonal rmse_seasonal bias_seasonal")
def naive_skill(t):
    return rp.naive_skill(ts.resample_mean(t("events"), ["event_type"], "ts", "value"), ["event_type"], "ts", "mean_value")


@_query(f"SELECT *, row_number() OVER (ORDER BY share DESC, c_nationkey) AS rank FROM (SELECT c_nationkey, coalesce(CAST(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE), 0) / sum(o_totalprice) AS share FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY ALL)", digits="share")
def renewable_share_rank(t):
    recent = t("orders").filter("o_orderdate >= timestamp_ntz '1998-01-01'").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rp.share_ranking(recent, ["c_nationkey"], F.col("o_orderstatus") == "F", "o_totalprice")


@_query("SELECT n_nationkey, n_name, orders_latest, lineitem_latest FROM nation LEFT JOIN (SELECT c_nationkey, max(o_orderdate) AS orders_latest FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) o ON o.c_nationkey = n_nationkey LEFT JOIN (SELECT s_nationkey, max(l_shipdate) AS lineitem_latest FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL) l ON l.s_nationkey = n_nationkey")
def latest_by_country(t):
    orders = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_nationkey", "n_nationkey")
    lines = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).withColumnRenamed("s_nationkey", "n_nationkey")
    facts = {"orders": (orders, "o_orderdate"), "lineitem": (lines, "l_shipdate")}
    return cp.snapshot(t("nation"), "n_nationkey", facts).select("n_nationkey", "n_name", "orders_latest", "lineitem_latest")


#: Names asked for; the last one is no nation.
ASKED = ["NATION_1", "NATION_7", "NATION_20", "NATION_99"]


@_query(f"SELECT n_name, n_nationkey, count(s_suppkey) AS suppliers, n_nationkey IS NULL AS is_missing FROM (SELECT unnest({ASKED}) AS n_name) LEFT JOIN nation USING (n_name) LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL")
def natural_key_lookup(t):
    nation = t("nation")
    asked = nation.sparkSession.createDataFrame([(n,) for n in ASKED], "n_name string")
    found, missing = rp.resolve(asked, "n_name", nation, "n_nationkey")
    per_nation = t("supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    counted = found.join(per_nation, "n_nationkey", "left").withColumn("is_missing", F.lit(False))
    return counted.unionByName(missing.withColumn("is_missing", F.lit(True)), allowMissingColumns=True).fillna({"suppliers": 0})


@_query("SELECT n_nationkey, n_name, n > 0 AS has_data, n AS record_count, coalesce(100.0::DOUBLE * d / (date_diff('day', a, b) + 1), 0) AS completeness, a AS earliest, b AS latest FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n, count(DISTINCT CAST(o_orderdate AS DATE)) AS d, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) ON c_nationkey = n_nationkey")
def completeness_document(t):
    orders = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_nationkey", "n_nationkey")
    documents = rp.completeness_document(orders, t("nation").select("n_nationkey", "n_name"), "n_nationkey", "o_orderdate")
    fields = F.from_json("document", "has_data boolean, record_count bigint, completeness double, earliest timestamp_ntz, latest timestamp_ntz")
    return documents.select("n_nationkey", "n_name", fields.alias("d")).select("n_nationkey", "n_name", "d.*")


@_query("SELECT s_suppkey, s_nationkey, s_acctbal, s_suppkey IN (3, 8) AS is_flagged FROM supplier WHERE s_nationkey IN (1, 3, 5, 7, 9) AND s_acctbal BETWEEN 0 AND 8000 AND s_suppkey NOT IN (1, 5)")
def filter_dimension(t):
    keep = F.col("s_nationkey").isin(1, 3, 5, 7, 9) & F.col("s_acctbal").between(0, 8000)
    return rp.filter_dimension(t("supplier").select("s_suppkey", "s_nationkey", "s_acctbal"), "s_suppkey", [1, 5], [3, 8], keep)


@_query("SELECT p_partkey, p_retailprice * 100.0::DOUBLE + 0.0::DOUBLE AS price_cents, p_size * 10.0::DOUBLE + 0.0::DOUBLE AS size_mm FROM part")
def registry_projection(t):
    return sh.convert_units(t("part").select("p_partkey", "p_retailprice", "p_size"), {"p_retailprice": ("price_cents", 100.0, 0.0), "p_size": ("size_mm", 10.0, 0.0)})


@_query("SELECT user_id, count(*) AS n, string_agg(DISTINCT event_type || 's', ',' ORDER BY event_type || 's') AS sources FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY ALL")
def union_sources(t):
    kinds = {f"{k}s": t("events").filter(F.col("event_type") == k).select("event_id", "user_id", F.col("value").alias(f"{k}_value")) for k in ("purchase", "signup")}
    rows = rp.union_by_name(kinds)
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"))


@_query("SELECT event_id, regexp_extract(props, '\"([a-z]+)\"\\s*:', 1) AS name, CAST(regexp_extract(props, ':\\s*(\\d+)', 1) AS BIGINT) AS number, ts - INTERVAL 1 HOUR AS utc FROM events")
def text_patterns(t):
    utc = F.to_utc_timestamp("ts", "Europe/Brussels").cast("timestamp_ntz")  # the events lie in a winter month
    return t("events").select("event_id", F.regexp_extract("props", r'"([a-z]+)"\s*:', 1).alias("name"), F.regexp_extract("props", r":\s*(\d+)", 1).cast("bigint").alias("number"), utc.alias("utc"))


@_query(_SQL["latest_snapshot"])
def stream_upsert(spark, sf_dir):
    folder = f"{scratch_folder(spark)}/stream_upsert-{uuid.uuid4().hex}"
    events = jobs.read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    rows = events.select("event_type", ts.floor_to("ts", "hour").alias("hour"), "ts", "event_id", "value")
    jobs.upserts(rows, f"{folder}/table", ["event_type", "hour"], "hour", ["ts", "event_id"], f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/table").select("event_type", "hour", "ts", "event_id", "value")
