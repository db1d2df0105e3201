"""Registered queries of writes in place, guarded writes, nested reports, lookups that must succeed, requests and borders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import quality as ql
from ..operators import reports as rp
from ..operators import timeseries as ts
from ..sources import sinks
from .catalog import _query
from .reports import SEGMENTS

_MARKED = "SELECT *, nullif(user_id % 40, 7) AS marker FROM events"


@_query(f"SELECT event_type, CAST(ts AS DATE) AS day, min(ts) AS from_ts, max(ts) + INTERVAL 1 HOUR AS to_ts, count(*) AS n, (SELECT count(*) FROM ({_MARKED}) WHERE marker IS NOT NULL) AS n_left FROM ({_MARKED}) WHERE marker IS NULL GROUP BY ALL")
def delete_in_place(spark, sf_dir):
    path = f"{sinks.scratch_folder(spark)}/deleted-{uuid.uuid4().hex}"
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("marker", F.nullif(F.col("user_id") % 40, F.lit(7)))
    sinks.write_months(rows, path, "ts")
    ranges = sinks.delete_rows(spark, path, "marker", ["event_type"], "ts")
    return ranges.withColumn("n_left", F.lit(spark.read.parquet(path).count()))


@_query("SELECT count(*) FILTER (WHERE l_tax <> 0 AND l_discount <> 0) AS accepted, count(*) FILTER (WHERE l_tax = 0 OR l_discount = 0) AS rejected FROM lineitem")
def guarded_write(spark, sf_dir):
    """Accepted and rejected rows as the write itself observes them."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", F.nullif("l_tax", F.lit(0.0)).alias("a"), F.nullif("l_discount", F.lit(0.0)).alias("b"))
    seen = sinks.write_guarded(rows, ql.has_all(["a", "b"]), f"{sinks.scratch_folder(spark)}/guarded-{uuid.uuid4().hex}")
    return spark.createDataFrame([(seen["accepted"], seen["rejected"])], "accepted long, rejected long")


@_query(f"SELECT n_nationkey, n_name AS name, kind, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_mktsegment = kind) AS n_plants, CAST(coalesce((SELECT sum(c_custkey) FROM customer WHERE c_nationkey = n_nationkey AND c_mktsegment = kind), 0) AS DOUBLE) AS total_capacity_mw, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND ({SEGMENTS!r})[s_suppkey % 5 + 1] = kind) AS chosen_k, coalesce((SELECT count(*) = 1 AND bool_or(s_suppkey % 2 = 0) FROM supplier WHERE s_nationkey = n_nationkey AND ({SEGMENTS!r})[s_suppkey % 5 + 1] = kind), false) AS fell_back_to_country FROM nation, (SELECT unnest({SEGMENTS!r}) AS kind)")
def coverage_documents(spark, sf_dir):
    """Nested documents by nation, written as JSON by the executors and read back."""
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    plants = t("customer").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("kind"), F.col("c_custkey").alias("capacity"), F.lit(None).cast("long").alias("zone"), F.lit(None).cast("boolean").alias("whole"))
    kind = F.element_at(F.array(*map(F.lit, SEGMENTS)), (F.col("s_suppkey") % 5 + 1).cast("int"))
    zones = t("supplier").select(F.col("s_nationkey").alias("n_nationkey"), kind.alias("kind"), F.lit(None).cast("long").alias("capacity"), F.col("s_suppkey").cast("long").alias("zone"), (F.col("s_suppkey") % 2 == 0).alias("whole"))
    documents = rp.coverage_document(t("nation"), plants.unionByName(zones), "n_nationkey", "n_name", "kind", SEGMENTS, "capacity", "zone", "whole")
    path = f"{sinks.scratch_folder(spark)}/documents-{uuid.uuid4().hex}"
    sinks.write_documents(documents, path)
    return spark.read.schema(documents.schema).json(path).select("n_nationkey", "name", F.explode("kinds").alias("kind", "d")).select("n_nationkey", "name", "kind", "d.*")


@_query("SELECT grouping(c_nationkey) > 0 AS is_whole, c_nationkey, count(*) AS n, count(DISTINCT CAST(o_orderdate AS DATE)) AS days, avg(CAST(o_totalprice AS DOUBLE)) AS mean_price FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY GROUPING SETS ((c_nationkey), ())", digits="mean_price")
def members_and_whole(t):
    orders = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rp.grouped_with_whole(orders, ["c_nationkey"], {"n": F.count("*"), "days": F.countDistinct(F.to_date("o_orderdate")), "mean_price": F.avg(F.col("o_totalprice").cast("double"))})


@_query("SELECT s_suppkey, n_name, r_name, n_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def required_lookup(t):
    """Suppliers' places by natural key; one that the dimension lacks would fail the query by its name."""
    named = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name", "n_nationkey")
    asked = t("supplier").join(named, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name", "r_name")
    return rp.resolved(asked, ["n_name", "r_name"], named, "n_nationkey")


_ZONED = "SELECT n_nationkey AS country, n_nationkey || '_' || unnest(generate_series(0, n_nationkey % 3)) AS zone FROM nation WHERE n_nationkey % 4 <> 0"
_BORDERS = "SELECT s_nationkey || CASE WHEN s_nationkey % 4 = 0 THEN '' ELSE '_' || (s_suppkey % 3) END AS a, (s_suppkey * 7 % 25) || CASE WHEN s_suppkey * 7 % 25 % 4 = 0 THEN '' ELSE '_' || (s_suppkey % 2) END AS b FROM supplier"


@_query(f"WITH o AS (SELECT CAST(n_nationkey AS VARCHAR) AS country, coalesce(zone, CAST(n_nationkey AS VARCHAR)) AS zone FROM nation LEFT JOIN ({_ZONED}) z ON country = n_nationkey), e AS (SELECT a, b FROM ({_BORDERS}) UNION SELECT b, a FROM ({_BORDERS})) SELECT DISTINCT country, b AS neighbour FROM o JOIN e ON zone = a")
def border_requests(t):
    """Which borders to ask for: suppliers stand for edges between zones of nations."""
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    zones = t("nation").filter("n_nationkey % 4 != 0").select(text("n_nationkey").alias("country"), F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n_nationkey") % 3).cast("long"))).alias("k"))
    zones = zones.select("country", F.concat_ws("_", "country", text("k")).alias("zone"))
    other = F.col("s_suppkey") * 7 % 25
    name = lambda nation, k: F.when(nation % 4 == 0, text(nation)).otherwise(F.concat_ws("_", text(nation), text(F.col("s_suppkey") % k)))
    edges = t("supplier").select(name(F.col("s_nationkey"), 3).alias("a"), name(other, 2).alias("b"))
    return rp.border_requests(t("nation").select(text("n_nationkey").alias("country")), zones, edges)


@_query("SELECT c_nationkey, CAST(floor(r / 50) AS BIGINT) AS batch, count(*) AS n, min(c_custkey) AS first_member, max(c_custkey) AS last_member FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS r FROM customer) GROUP BY ALL")
def request_batches(t):
    found = rp.request_batches(t("customer"), ["c_nationkey"], "c_custkey", 50)
    return found.select("c_nationkey", "batch", F.size("members").cast("long").alias("n"), F.element_at("members", 1).alias("first_member"), F.element_at("members", -1).alias("last_member"))


@_query("SELECT o_orderpriority, CAST(s AS DATE) AS chunk_start, least(CAST(s AS DATE) + 6, b) AS chunk_end FROM (SELECT o_orderpriority, b, unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 7 DAY)) AS s FROM (SELECT o_orderpriority, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders GROUP BY ALL))")
def inclusive_chunks(t):
    spans = t("orders").groupBy("o_orderpriority").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    return ts.inclusive_chunks(spans, "a", "b", 7).select("o_orderpriority", "chunk_start", "chunk_end")
