"""Registered queries of the library's own operators over the given tables, with the equal SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import completeness as cp
from ..operators import quality as ql
from ..operators import revision as rv
from ..operators import shape as sh
from ..operators import snapshots as sn
from ..operators import text as tx
from ..operators import timeseries as ts
from ..operators import zones as zn
from ..sources import readers
from ..streaming import jobs

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


#: Digits of sums and means of doubles that don't depend on the order of rows.
_DIGITS = 10


def _cut(c: str) -> str:
    """``c`` cut after its first digits. The cut lies off the halves, where short decimals end up."""
    scale = f"power(10.0, {_DIGITS - 1} - floor(log10(abs({c}))))"
    return f"CASE WHEN {c} = 0 THEN {c} ELSE floor({c} * {scale} + 0.318) / {scale} END"


def _query(sql: str | None = None, digits: str = ""):
    """Registers a query. The columns named in ``digits`` are cut in its result and in the SQL's, which adds doubles up in another order."""
    columns = digits.split()

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")) if f.__code__.co_argcount == 1 else f(spark, sf_dir)
            return out.withColumns({c: F.expr(_cut(c).replace("10.0", "10D").replace("0.318", "0.318D")) for c in columns})

        _QUERIES[f.__name__] = run
        if sql:
            cuts = ", ".join(f"{_cut(c).replace('10.0', '10::DOUBLE').replace('0.318', '0.318::DOUBLE')} AS {c}" for c in columns)
            _SQL[f.__name__] = f"SELECT * REPLACE ({cuts}) FROM ({sql})" if columns else sql
        return run

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_AGED = "lineitem l JOIN orders o ON l_orderkey = o_orderkey"
_AGE = "(epoch_us(o_orderdate) - epoch_us(l_shipdate)) / 86400000000::DOUBLE"


def _aged(t) -> DataFrame:
    return t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))


def _age():
    return rv.age_days("o_orderdate", "l_shipdate")


# snapshots


@_query("SELECT event_type, hour, ts, event_id, value FROM (SELECT *, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_snapshot(t):
    return sn.as_of(t("events").withColumn("hour", ts.floor_to("ts", "hour")), ["event_type"], "hour", "ts", tie_break=("event_id",)).select("event_type", "hour", "ts", "event_id", "value")


@_query("SELECT event_type, hour, ts, event_id, value FROM (SELECT *, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00') WHERE r = 1 AND hour BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'")
def as_of_cutoff(t):
    events = t("events").withColumn("hour", ts.floor_to("ts", "hour"))
    return sn.as_of(events, ["event_type"], "hour", "ts", "2024-01-15 12:00:00", "2024-01-05 00:00:00", "2024-01-20 00:00:00", ("event_id",)).select("event_type", "hour", "ts", "event_id", "value")


@_query("SELECT p.event_id, p.user_id, p.ts, v.event_id AS seen_event_id, v.value AS seen_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts")
def as_of_join(t):
    asked = t("events").filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = t("events").filter("event_type = 'view'")
    return sn.as_of_join(asked, seen, ["user_id"], "ts", "ts", ["event_id", "value"])


_UPSERT_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
_ORDER_DESC = ", ".join(f"{c} DESC" for c in _UPSERT_ORDER)


@_query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey % 2 DESC, {_ORDER_DESC}) AS r FROM lineitem) WHERE r = 1")
def upsert_last_wins(t):
    l = t("lineitem")  # noqa: E741
    return sn.upsert(l.filter("l_suppkey % 2 = 0"), l.filter("l_suppkey % 2 = 1"), ["l_orderkey", "l_linenumber"], _UPSERT_ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@_query(f"WITH a AS (SELECT * FROM lineitem WHERE l_suppkey % 2 = 0), b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_UPSERT_ORDER)}) AS r FROM lineitem WHERE l_suppkey % 2 = 1 AND NOT EXISTS (SELECT 1 FROM a WHERE a.l_orderkey = lineitem.l_orderkey AND a.l_linenumber = lineitem.l_linenumber)) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM a UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM b WHERE r = 1")
def insert_if_absent(t):
    l = t("lineitem")  # noqa: E741
    return sn.insert_if_absent(l.filter("l_suppkey % 2 = 0"), l.filter("l_suppkey % 2 = 1"), ["l_orderkey", "l_linenumber"], _UPSERT_ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@_query("SELECT event_id, e.ts, CASE WHEN e.v IS NULL AND e.ts >= TIMESTAMP '2024-01-05' AND e.ts < TIMESTAMP '2024-01-15' THEN e.value ELSE e.v END AS v FROM (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS v FROM events) e")
def null_only_update(t):
    e = t("events")
    old = e.select("event_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return sn.null_only_update(old, e.select("event_id", F.col("value").alias("v")), ["event_id"], "v", "ts", "2024-01-05 00:00:00", "2024-01-15 00:00:00")


# time series


@_query(f"SELECT event_type, date_trunc('hour', ts) AS ts, sum(value) / count(value) AS mean_value, count(*) AS n FROM events GROUP BY ALL", digits="mean_value")
def hourly_mean(t):
    return ts.resample_mean(t("events"), ["event_type"], "ts", "value")


@_query("SELECT user_id, count(*) AS hours, CAST((epoch(max(h)) - epoch(min(h))) / 3600 + 1 AS BIGINT) - count(*) AS gaps FROM (SELECT DISTINCT user_id, date_trunc('hour', ts) AS h FROM events) GROUP BY user_id")
def hourly_gap_count(t):
    return ts.gap_counts(ts.resample_mean(t("events"), ["user_id"], "ts", "value"), ["user_id"])


@_query(f"SELECT zone, date_trunc('hour', m) AS ts, sum(s) / count(*) AS mean_value FROM (SELECT user_id % 10 AS zone, date_trunc('minute', ts) AS m, sum(value) AS s FROM events GROUP BY ALL) GROUP BY ALL", digits="mean_value")
def zone_sum_then_hourly_mean(t):
    return ts.sum_then_mean(t("events").withColumn("zone", F.col("user_id") % 10), ["zone"], "ts", "value")


@_query(f"SELECT s_nationkey, date_trunc('month', l_shipdate) AS month, sum(l_extendedprice) / count(*) AS mean_value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL", digits="mean_value")
def multi_zone_average(t):
    joined = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).withColumn("month", ts.floor_to("l_shipdate", "month"))
    return ts.group_mean(joined, ["s_nationkey", "month"], "l_extendedprice")


@_query(f"SELECT date_trunc('month', l_shipdate) AS month, sum(nullif(l_tax, 0) * l_quantity) / nullif(sum(CASE WHEN l_tax <> 0 THEN l_quantity END), 0) AS weighted, count(*) AS n_points FROM lineitem GROUP BY ALL", digits="weighted")
def weighted_mean_null_renorm(t):
    rows = t("lineitem").withColumn("month", ts.floor_to("l_shipdate", "month")).withColumn("v", F.nullif("l_tax", F.lit(0.0)))
    return ts.weighted_mean(rows, ["month"], "v", "l_quantity")


@_query(f"SELECT l_partkey, date_trunc('month', l_shipdate) AS month, sum(nullif(l_tax, 0)) AS kept_null, coalesce(sum(nullif(l_tax, 0)), 0) AS zero_filled FROM lineitem GROUP BY ALL", digits="kept_null zero_filled")
def collapse_duplicates(t):
    rows = t("lineitem").withColumn("month", ts.floor_to("l_shipdate", "month")).withColumn("v", F.nullif("l_tax", F.lit(0.0)))
    return ts.collapse_duplicates(rows, ["l_partkey", "month"], "v")


_LEAD = "SELECT user_id, ts AS last_seen, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_seen FROM (SELECT DISTINCT user_id, ts FROM events{})"
_GAP = "SELECT *, (epoch_us(next_seen) - epoch_us(last_seen)) / 1000000::DOUBLE AS gap_seconds FROM ({}) WHERE (epoch_us(next_seen) - epoch_us(last_seen)) / 1000000::DOUBLE > {}"


@_query(_GAP.format(_LEAD.format(""), 3960))
def lag_gaps(t):
    return ts.gaps(t("events"), ["user_id"], "ts", 1.1 * 3600)


@_query(_GAP.format(_LEAD.format(" WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20 23:59:59'"), 21600))
def interior_holes(t):
    return ts.gaps(ts.time_range(t("events"), "ts", "2024-01-05", "2024-01-20"), ["user_id"], "ts", 6 * 3600)


@_query("SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 23:59:59'")
def time_range_bare_dates(t):
    return ts.time_range(t("events"), "ts", "2024-01-10", "2024-01-12").select("event_id", "ts")


@_query("WITH i AS (SELECT o_custkey, o_orderdate AS a, o_orderdate + INTERVAL 20 DAY AS b FROM orders), f AS (SELECT *, CASE WHEN a > max(b) OVER (PARTITION BY o_custkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + INTERVAL 1 DAY THEN 1 ELSE 0 END AS new FROM i), g AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM f) SELECT o_custkey, min(a) AS start_at, max(b) AS end_at, count(*) AS merged FROM g GROUP BY o_custkey, g.g")
def merge_intervals(t):
    rows = t("orders").select("o_custkey", F.col("o_orderdate").alias("a"), (F.col("o_orderdate") + F.expr("interval 20 day")).alias("b"))
    return ts.merge_intervals(rows, ["o_custkey"], "a", "b")


@_query("SELECT c_nationkey, min(d) AS first_day, max(d) AS last_day, count(*) AS days FROM (SELECT c_nationkey, d, d - CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY d) AS INTEGER) AS i FROM (SELECT DISTINCT c_nationkey, CAST(o_orderdate AS DATE) AS d FROM orders JOIN customer ON o_custkey = c_custkey)) GROUP BY c_nationkey, i")
def day_islands(t):
    return ts.day_islands(t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")), ["c_nationkey"], "o_orderdate")


@_query("SELECT l_returnflag, CAST(l_shipdate AS DATE) AS day, min(l_shipdate) AS from_ts, max(l_shipdate) + INTERVAL 1 HOUR AS to_ts, count(*) AS n FROM lineitem WHERE l_tax = 0 GROUP BY ALL")
def null_day_ranges(t):
    return ts.null_day_ranges(t("lineitem").withColumn("v", F.nullif("l_tax", F.lit(0.0))), ["l_returnflag"], "l_shipdate", "v")


@_query("WITH p AS (SELECT event_type, h AS ts, value FROM (SELECT *, date_trunc('hour', ts) AS h, row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts, event_id) AS r FROM events WHERE hour(ts) % 4 = 0) WHERE r = 1), g AS (SELECT event_type, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM p GROUP BY event_type) SELECT event_type, ts, p.value IS NOT NULL AS is_point, last_value(p.value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value FROM g LEFT JOIN p USING (event_type, ts)")
def step_function_expand(t):
    hours = t("events").filter(F.hour("ts") % 4 == 0).withColumn("h", ts.floor_to("ts", "hour"))
    points = cp.latest_per_key(hours, ["event_type", "h"], ["ts", "event_id"]).select("event_type", F.col("h").alias("ts"), "value")
    return ts.expand_steps(points, ["event_type"], "ts", "value")


@_query(f"SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rank_in_group, CAST(s_acctbal AS DOUBLE) / CAST(sum(s_acctbal) OVER (PARTITION BY s_nationkey) AS DOUBLE) AS share FROM supplier", digits="share")
def rank_and_share(t):
    return ts.rank_and_share(t("supplier"), ["s_nationkey"], "s_acctbal", "s_suppkey").select("s_suppkey", "s_nationkey", "rank_in_group", "share")


@_query("SELECT event_id, ts, value FROM events WHERE minute(ts) = 0")
def decimate_hourly(t):
    return ts.decimate(t("events"), "ts").select("event_id", "ts", "value")


# quality


@_query("SELECT l_returnflag, count(*) FILTER (WHERE l_extendedprice BETWEEN 1000 AND 50000 AND l_tax <> 0) AS kept, count(*) FILTER (WHERE NOT (l_extendedprice BETWEEN 1000 AND 50000 AND l_tax <> 0)) AS rejected FROM lineitem GROUP BY ALL")
def range_validation(t):
    rows = t("lineitem").withColumn("v", F.when(F.col("l_tax") != 0, F.col("l_extendedprice")))
    kept, rejected = ql.validate_range(rows, "v", 1000.0, 50000.0)
    both = kept.select("l_returnflag", F.lit(1).alias("k")).unionByName(rejected.select("l_returnflag", F.lit(0).alias("k")))
    return both.groupBy("l_returnflag").agg(F.sum("k").alias("kept"), F.sum(1 - F.col("k")).alias("rejected"))


@_query("SELECT count(*) FILTER (WHERE l_tax <> 0 AND l_discount <> 0) AS accepted, count(*) FILTER (WHERE l_tax = 0 OR l_discount = 0) AS rejected FROM lineitem")
def not_null_guard(t):
    rows = t("lineitem").select(F.nullif("l_tax", F.lit(0.0)).alias("a"), F.nullif("l_discount", F.lit(0.0)).alias("b"))
    good, bad = ql.not_null_guard(rows, ["a", "b"])
    return good.agg(F.count("*").alias("accepted")).join(bad.agg(F.count("*").alias("rejected")), F.lit(True))


_PUBLISHED = "SELECT *, max(CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY {}) AS readable FROM lineitem"


@_query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_tax FROM ({_PUBLISHED.format('l_orderkey')}) WHERE NOT (readable = 1 AND l_linenumber > 2 AND l_tax = 0)")
def drop_unpublished_zeros(t):
    rows = t("lineitem")
    return ql.drop_unpublished_zeros(rows, rows.filter("l_linenumber <= 2"), "l_orderkey", "l_linenumber", "l_tax").select("l_orderkey", "l_linenumber", "l_partkey", "l_tax")


@_query(f"SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey, readable = 1 AND l_linenumber > 2 AND l_tax = 0 AS blanked, CASE WHEN NOT (readable = 1 AND l_linenumber > 2 AND l_tax = 0) THEN l_tax END AS l_tax FROM ({_PUBLISHED.format('l_orderkey, l_returnflag')})")
def blank_unpublished_zeros(t):
    rows = t("lineitem")
    return ql.blank_unpublished_zeros(rows, rows.filter("l_linenumber <= 2"), "l_orderkey", ["l_returnflag"], "l_linenumber", "l_tax").select("l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", "blanked", "l_tax")


@_query("SELECT event_type, count(*) AS n_rows FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY ALL")
def unmapped_names(t):
    known = t("events").select("event_type").distinct().filter("event_type in ('view', 'click')")
    return ql.unmapped_names(t("events"), "event_type", known)


@_query("(SELECT doc_id, 'left_only' AS side FROM documents EXCEPT ALL SELECT doc_id, 'left_only' FROM labels) UNION ALL (SELECT doc_id, 'right_only' AS side FROM labels EXCEPT ALL SELECT doc_id, 'right_only' FROM documents)")
def dimension_drift(t):
    return ql.drift(t("documents"), t("labels"), ["doc_id"])


@_query("SELECT 'duplicate' AS problem, count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'orphan', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def integrity_checks(t):
    n = lambda df, what: df.agg(F.lit(what).alias("problem"), F.count("*").alias("n"))
    return n(ql.duplicate_keys(t("lineitem"), ["l_orderkey", "l_linenumber"]), "duplicate").unionByName(n(ql.orphans(t("orders"), "o_custkey", t("customer"), "c_custkey"), "orphan"))


@_query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_tax <> 0 GROUP BY ALL")
def delete_null_marker(t):
    return ql.drop_null_marker(t("lineitem").withColumn("v", F.nullif("l_tax", F.lit(0.0))), "v").groupBy("l_returnflag").agg(F.count("*").alias("n"))


# shapes


_SIDES = "SELECT date_trunc('hour', ts) AS ts, sum(CASE WHEN event_type = 'purchase' THEN {v} END) AS a, sum(CASE WHEN event_type = 'error' THEN {v} END) AS c FROM events WHERE event_type IN ('purchase', 'error') GROUP BY ALL".format(v="value")


def _sides(t) -> DataFrame:
    side = F.when(F.col("event_type") == "purchase", "aggregated").otherwise("consumption")
    return t("events").filter("event_type in ('purchase', 'error')").select(ts.floor_to("ts", "hour").alias("ts"), side.alias("side"), "value")


@_query(f"SELECT ts, CAST(coalesce(a, 0) - coalesce(c, 0) AS DOUBLE) AS net_value FROM ({_SIDES})", digits="net_value")
def signed_netting(t):
    return sh.net_sides(_sides(t), ["ts"], "side", "value")


@_query("SELECT event_id, user_id, event_type, value FROM (SELECT *, min(event_type) OVER (PARTITION BY user_id) AS f FROM events WHERE event_type <> 'error') WHERE event_type = f")
def prefer_aggregated(t):
    """A user's event types are the series of a type, 'error' its consumption."""
    rows = t("events").withColumn("side", F.when(F.col("event_type") == "error", "Actual Consumption").otherwise("Actual Aggregated"))
    return sh.prefer_aggregated(rows, ["user_id"], "side", "event_type").select("event_id", "user_id", "event_type", "value")


@_query("SELECT user_id, CAST(ts AS DATE) AS day, " + ", ".join(f"coalesce(sum(CASE WHEN event_type IN ({n}) THEN value END), 0) AS {c}" for c, n in (("wind", "'view'"), ("solar", "'click'"), ("other", "'purchase', 'error', 'signup'"))) + " FROM events GROUP BY ALL", digits="wind solar other")
def fold_renewable_columns(t):
    rows = t("events").withColumn("day", F.to_date("ts"))
    return sh.map_wide(rows, ["user_id", "day"], "event_type", "value", {"view": "wind", "click": "solar", "purchase": "other", "error": "other", "signup": "other"}, 0.0)


_TYPES = ("view", "click", "purchase", "error", "signup")


@_query("SELECT user_id, CAST(ts AS DATE) AS day, " + ", ".join(f"sum(CASE WHEN event_type = '{c}' THEN value END) AS {c}_mw" for c in _TYPES) + " FROM events GROUP BY ALL", digits="view_mw click_mw purchase_mw error_mw signup_mw")
def null_preserving_pivot(t):
    return sh.map_wide(t("events").withColumn("day", F.to_date("ts")), ["user_id", "day"], "event_type", "value", {c: f"{c}_mw" for c in _TYPES})


@_query("SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_tax, 0), 0.0) + coalesce(nullif(l_discount, 0), 0.0) + coalesce(l_quantity, 0.0) AS total FROM lineitem")
def component_total(t):
    rows = t("lineitem").withColumn("a", F.nullif("l_tax", F.lit(0.0))).withColumn("b", F.nullif("l_discount", F.lit(0.0)))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", sh.null_as_zero_sum(["a", "b", "l_quantity"]).alias("total"))


@_query("SELECT c_custkey, c_acctbal * 1.0::DOUBLE + 273.15::DOUBLE AS balance_k, CAST(c_nationkey AS DOUBLE) * 0.01::DOUBLE + 0.0 AS nation_fraction FROM customer")
def unit_conversion(t):
    rows = t("customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    return sh.convert_units(rows, {"c_acctbal": ("balance_k", 1.0, 273.15), "nation": ("nation_fraction", 0.01, 0.0)})


@_query("SELECT s_suppkey, n_name AS country, r_name AS area FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def zone_to_country(t):
    nation, region = t("nation"), t("region")
    joined = t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select("s_suppkey", F.col("n_name").alias("country"), F.col("r_name").alias("area"))


@_query("SELECT n_name, CASE n_name WHEN 'NATION_1' THEN 'ZONE_A' WHEN 'NATION_2' THEN 'ZONE_B' ELSE n_name END AS zone FROM nation")
def purpose_zone_map(t):
    mapping = t("nation").filter("n_nationkey in (1, 2)").select("n_name", F.when(F.col("n_nationkey") == 1, "ZONE_A").otherwise("ZONE_B").alias("z"))
    return sh.lookup(t("nation").select("n_name"), "n_name", mapping, "n_name", "z", "zone")


@_query("SELECT s_suppkey, s_acctbal FROM supplier WHERE s_nationkey NOT IN (3, 5)")
def double_count_guard(t):
    return ql.orphans(t("supplier"), "s_nationkey", t("nation").filter("n_nationkey in (3, 5)"), "n_nationkey").select("s_suppkey", "s_acctbal")


@_query(f"SELECT p_brand, p_size, CAST(coalesce(lo, hi) AS DOUBLE) AS value_min, CAST(coalesce(hi, lo) AS DOUBLE) AS value_max, (CAST(coalesce(lo, hi) AS DOUBLE) + CAST(coalesce(hi, lo) AS DOUBLE)) / 2 AS value_mid FROM (SELECT p_brand, p_size, max(CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END) AS lo, max(CASE WHEN p_partkey % 2 = 1 THEN p_retailprice END) AS hi FROM part GROUP BY ALL)")
def week_ahead_envelope(t):
    rows = t("part").withColumn("kind", F.when(F.col("p_partkey") % 2 == 0, "min").otherwise("max"))
    return sh.min_max_envelope(rows, ["p_brand", "p_size"], "kind", "p_retailprice")


@_query("SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END, o_orderdate) AS run_time, 'actual' AS quality, TIMESTAMP '2024-01-01 00:00:00' AS written_at FROM orders")
def stamp_and_fill(t):
    rows = t("orders").select("o_orderkey", F.coalesce(F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")), "o_orderdate").alias("run_time"))
    return sh.stamp(rows, "actual", "2024-01-01 00:00:00")


# market views


@_query(f"SELECT n_name, mktsegment, n, CAST(price AS DOUBLE) AS price, CAST(tax AS DOUBLE) / nullif(CAST(price AS DOUBLE), 0) AS share FROM (SELECT n_name, c_mktsegment AS mktsegment, count(*) AS n, sum(o_totalprice) AS price, sum(li) AS tax FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS li FROM lineitem GROUP BY ALL) ON l_orderkey = o_orderkey GROUP BY ALL)", digits="price share")
def dashboard_view(t):
    lines = t("lineitem").groupBy("l_orderkey").agg(ts.total("l_extendedprice").alias("li"))
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    price = ts.total("o_totalprice")
    return rows.groupBy("n_name", F.col("c_mktsegment").alias("mktsegment")).agg(F.count("*").alias("n"), price.alias("price"), (F.sum("li").cast("double") / F.nullif(price, F.lit(0.0))).alias("share"))


@_query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(l_extendedprice - l_quantity * p_retailprice) AS abs_error, 100 * abs(l_extendedprice - l_quantity * p_retailprice) / nullif(l_extendedprice, 0) AS pct_error FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'")
def forecast_error(t):
    rows = t("lineitem").filter("l_returnflag = 'R'").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    error = F.abs(F.col("l_extendedprice") - F.col("l_quantity") * F.col("p_retailprice"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", error.alias("abs_error"), (100 * error / F.nullif("l_extendedprice", F.lit(0.0))).alias("pct_error"))


@_query("SELECT n_nationkey, o.m AS orders_latest, coalesce(o.n, 0) AS orders_count, s.m AS shipped_latest, coalesce(s.n, 0) AS shipped_count FROM nation LEFT JOIN (SELECT c_nationkey AS k, max(o_orderdate) AS m, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) o ON o.k = n_nationkey LEFT JOIN (SELECT s_nationkey AS k, max(l_shipdate) AS m, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL) s ON s.k = n_nationkey")
def completeness_snapshot(t):
    orders = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn("n_nationkey", F.col("c_nationkey"))
    shipped = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).withColumn("n_nationkey", F.col("s_nationkey"))
    return cp.snapshot(t("nation").select("n_nationkey"), "n_nationkey", {"orders": (orders, "o_orderdate"), "shipped": (shipped, "l_shipdate")})


@_query("SELECT CAST(l_shipdate AS DATE) AS day, count(*) FILTER (WHERE l_tax = 0) AS missing FROM lineitem GROUP BY ALL HAVING missing > 0")
def missing_publication_days(t):
    return cp.missing_days(t("lineitem").withColumn("v", F.nullif("l_tax", F.lit(0.0))), "l_shipdate", "v")


@_query("WITH h AS (SELECT l_suppkey, date_trunc('month', l_shipdate) AS month, count(DISTINCT CAST(l_shipdate AS DATE)) AS present FROM lineitem GROUP BY ALL), s AS (SELECT l_suppkey, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month, min(month) AS a FROM h GROUP BY l_suppkey) SELECT l_suppkey, month, coalesce(present, 0) AS present, CAST(day(last_day(month)) AS BIGINT) AS expected, CASE WHEN present IS NULL THEN 'MISSING' ELSE 'PARTIAL' END AS kind FROM s LEFT JOIN h USING (l_suppkey, month) WHERE month > a AND coalesce(present, 0) < day(last_day(month)) * 0.99")
def month_completeness(t):
    return cp.month_completeness(t("lineitem"), ["l_suppkey"], "l_shipdate", 1, "day")


@_query("SELECT k AS s_suppkey, m AS month FROM (SELECT DISTINCT l_suppkey AS k FROM lineitem) a, (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS m) b EXCEPT SELECT l_suppkey, date_trunc('month', l_shipdate) FROM lineitem")
def missing_months_plan(t):
    return cp.missing_months(t("lineitem").withColumnRenamed("l_suppkey", "s_suppkey"), ["s_suppkey"], "l_shipdate", "1995-01-01 00:00:00", "2001-12-01 00:00:00")


@_query("SELECT p_partkey, m AS latest FROM part LEFT JOIN (SELECT l_partkey AS k, max(l_shipdate) AS m FROM lineitem GROUP BY ALL) ON k = p_partkey WHERE m IS NULL OR m < TIMESTAMP '2001-11-01' - INTERVAL 7 DAY")
def resume_filter(t):
    return cp.to_resume(t("part").select("p_partkey"), t("lineitem").withColumnRenamed("l_partkey", "p_partkey"), "p_partkey", "l_shipdate", "2001-11-01 00:00:00")


# revision study

_EDGES = (0, 180, 365, 730, 1095, 1460, 1825)
_CASE = "CASE " + " ".join(f"WHEN age < {e} THEN '<{e}'" for e in _EDGES) + " ELSE '>=1825' END"


@_query(f"SELECT {_CASE} AS band, count(*) AS n, min(l_shipdate) AS first_target, max(l_shipdate) AS last_target FROM (SELECT *, {_AGE} AS age FROM {_AGED}) GROUP BY ALL")
def age_bands(t):
    return rv.age_bands(_aged(t), _age(), "l_shipdate", _EDGES)


@_query(f"SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE age < 365) AS unrevised, max(l_shipdate) FILTER (WHERE age >= 365) AS settled_through, min(l_shipdate) FILTER (WHERE age < 365) AS unrevised_from, 100.0::DOUBLE * count(*) FILTER (WHERE age < 365) / count(*) AS pct FROM (SELECT *, {_AGE} AS age FROM {_AGED}) GROUP BY ALL")
def exposure_by_country(t):
    return rv.exposure(_aged(t), ["l_returnflag"], _age(), "l_shipdate", 365)


def _effect_sql(den: str) -> str:
    s = lambda c, op: f"CAST(sum({c}) FILTER (WHERE age {op} 365) AS DOUBLE)"
    return f"SELECT l_linestatus, l_returnflag, n_old, n_young, (go / ro) / (gy / ry) AS effect, abs((go / ro) / (gy / ry) - 1) > 0.1 AS flagged FROM (SELECT l_linestatus, l_returnflag, count(*) FILTER (WHERE age >= 365) AS n_old, count(*) FILTER (WHERE age < 365) AS n_young, {s('l_extendedprice', '>=')} AS go, {s('l_extendedprice', '<')} AS gy, {s(den, '>=')} AS ro, {s(den, '<')} AS ry FROM (SELECT *, {_AGE} AS age FROM {_AGED} JOIN part ON l_partkey = p_partkey) GROUP BY ALL) WHERE n_old >= 200 AND n_young >= 200"


def _paired(t) -> DataFrame:
    return _aged(t).join(t("part"), F.col("l_partkey") == F.col("p_partkey"))


@_query(_effect_sql("p_retailprice"), digits="effect")
def vintage_effect(t):
    return rv.vintage_effect(_paired(t), ["l_linestatus", "l_returnflag"], "l_extendedprice", "p_retailprice", _age(), 365)


@_query(f"SELECT a.*, b.effect AS effect_confirm, CASE WHEN NOT a.flagged THEN 'screened only' WHEN b.effect IS NULL THEN 'no cover' WHEN abs(b.effect - 1) > 0.1 AND (b.effect > 1) = (a.effect > 1) THEN 'CONFIRMED' ELSE 'NOT CONFIRMED' END AS verdict FROM ({_effect_sql('p_retailprice')}) a LEFT JOIN ({_effect_sql('p_size')}) b USING (l_linestatus, l_returnflag)", digits="effect effect_confirm")
def vintage_confirm(t):
    return rv.confirmed_effects(_paired(t), ["l_linestatus", "l_returnflag"], "l_extendedprice", "p_retailprice", "p_size", _age(), 365)


@_query(f"SELECT CAST(floor(age / 60) AS BIGINT) AS bin, count(*) AS n, sum(l_extendedprice) / nullif(sum(l_quantity), 0) AS ratio FROM (SELECT *, {_AGE} AS age FROM {_AGED}) WHERE age >= 0 AND age < 1440 GROUP BY ALL HAVING count(*) >= 50", digits="ratio")
def age_profile(t):
    return rv.age_profile(_aged(t), "l_extendedprice", "l_quantity", _age(), 60.0, 24)


@_query(f"WITH b AS (SELECT l_returnflag, CAST(floor(age / 30 / 0.25) AS INTEGER) AS b, l_extendedprice AS g, l_quantity AS r FROM (SELECT *, {_AGE} AS age FROM {_AGED})), s AS (SELECT f AS l_returnflag, CAST(k AS INTEGER) AS k FROM (SELECT DISTINCT l_returnflag AS f FROM lineitem), generate_series(12, 180) x(k)), j AS (SELECT s.l_returnflag, k, count(*) FILTER (WHERE b < k) AS n1, count(*) FILTER (WHERE b >= k) AS n2, CAST(sum(g) FILTER (WHERE b < k) AS DOUBLE) / CAST(sum(r) FILTER (WHERE b < k) AS DOUBLE) AS r1, CAST(sum(g) FILTER (WHERE b >= k) AS DOUBLE) / CAST(sum(r) FILTER (WHERE b >= k) AS DOUBLE) AS r2 FROM s JOIN b ON b.l_returnflag = s.l_returnflag AND b >= k - 28 AND b < k + 28 GROUP BY ALL), x AS (SELECT *, greatest(r1 / r2, r2 / r1) AS jump, row_number() OVER (PARTITION BY l_returnflag ORDER BY greatest(r1 / r2, r2 / r1) DESC, k) AS rn FROM j WHERE n1 >= 200 AND n2 >= 200 AND l_returnflag IN (SELECT l_returnflag FROM b WHERE b <= 280 GROUP BY ALL HAVING count(*) >= 800)) SELECT l_returnflag, k * 0.25::DOUBLE AS split, r1, r2, jump, jump >= 1.1 AS is_boundary FROM x WHERE rn = 1", digits="r1 r2 jump")
def step_detector(t):
    return rv.step_detector(_aged(t), ["l_returnflag"], "l_extendedprice", "l_quantity", _age() / 30)


_PLACEBOS = f"SELECT split, count(*) AS n, count(*) FILTER (WHERE d < 0) AS n_before, count(*) FILTER (WHERE d >= 0) AS n_after, CAST(sum(value) FILTER (WHERE d < 0) AS DOUBLE) / count(*) FILTER (WHERE d < 0) AS before, CAST(sum(value) FILTER (WHERE d >= 0) AS DOUBLE) / count(*) FILTER (WHERE d >= 0) AS after, (CAST(sum(value) FILTER (WHERE d >= 0) AS DOUBLE) / count(*) FILTER (WHERE d >= 0)) / (CAST(sum(value) FILTER (WHERE d < 0) AS DOUBLE) / count(*) FILTER (WHERE d < 0)) AS effect FROM (SELECT value, split, (epoch_us(ts) - epoch_us(split)) / 86400000000::DOUBLE AS d FROM events, (SELECT unnest([TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-11', TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-18', TIMESTAMP '2024-01-22']) AS split)) WHERE d >= -5 AND d < 5 GROUP BY split"


@_query(_PLACEBOS, digits="before after effect")
def placebo_splits(t):
    return rv.split_effects(t("events"), "ts", "value", [f"2024-01-{d} 00:00:00" for d in ("08", "11", "15", "18", "22")], 5)


@_query("SELECT CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 'after' ELSE 'before' END AS side, count(value) AS n, avg(value) AS mean_value, stddev_pop(value) AS sd, stddev_pop(value) / sqrt(count(value)) AS se FROM events GROUP BY ALL", digits="mean_value sd se")
def two_sample_summary(t):
    return rv.two_samples(t("events"), F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), "value")


@_query(f"SELECT CAST(o_orderdate AS DATE) AS session, count(*) AS n, min(age) AS youngest, max(age) AS oldest FROM (SELECT *, {_AGE} AS age FROM {_AGED}) GROUP BY ALL HAVING count(*) >= 5 AND min(age) < 365 AND max(age) >= 365")
def write_session(t):
    return rv.write_sessions(_aged(t), "o_orderdate", _age(), 365, 5)


# sources, text, zones


@_query("SELECT event_type, date_trunc('hour', ts) AS ts, CAST(count(*) AS DOUBLE) AS quantity FROM events GROUP BY ALL")
def market_document_points(t):
    counts = t("events").groupBy("event_type", F.to_date("ts").alias("day"), (F.hour("ts") + 1).alias("position")).agg(F.count("*").alias("q"))
    point = F.format_string("<Point><position>%d</position><quantity>%d</quantity></Point>", "position", "q")
    docs = counts.groupBy("event_type", "day").agg(F.array_join(F.collect_list(point), "").alias("points"))
    xml = F.concat(F.lit('<GL_MarketDocument xmlns="urn:x"><createdDateTime>2024-02-01T00:00:00Z</createdDateTime><TimeSeries><Period><timeInterval><start>'), F.col("day").cast("string"), F.lit("T00:00Z</start></timeInterval><resolution>PT60M</resolution>"), F.col("points"), F.lit("</Period></TimeSeries></GL_MarketDocument>"))
    return readers.market_points(docs.select("event_type", xml.alias("xml"))).select("event_type", "ts", "quantity")


@_query("SELECT event_type, date_trunc('hour', ts) AS valid_at, CAST(count(*) AS DOUBLE) AS temperature FROM events GROUP BY ALL")
def hourly_arrays_to_rows(t):
    hours = t("events").groupBy("event_type", F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm").alias("h")).agg(F.count("*").cast("double").alias("v"))
    arrays = hours.groupBy("event_type", F.substring("h", 1, 10).alias("day")).agg(F.sort_array(F.collect_list(F.struct("h", "v"))).alias("x"))
    response = F.to_json(F.array(F.struct(F.struct(F.col("x.h").alias("time"), F.col("x.v").alias("temperature_2m")).alias("hourly"))))
    place = t("region").filter("r_regionkey = 0").select(F.col("r_regionkey").cast("int").alias("position"), F.col("r_name").alias("location"))
    return readers.hourly_rows(arrays.select("event_type", response.alias("body")), "body", place, {"temperature_2m": "temperature"}).select("event_type", "valid_at", "temperature")


@_query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n FROM events GROUP BY ALL")
def props_json(t):
    return t("events").groupBy("event_type", (F.from_json("props", "k bigint")["k"] % 10).alias("k")).agg(F.count("*").alias("n"))


@_query("SELECT p_type, CASE WHEN lower(trim(p_type)) = 'economy' THEN 'onshore' WHEN lower(trim(p_type)) LIKE 'prom%' THEN 'offshore' END AS tech, count(*) AS n FROM part GROUP BY ALL")
def classify_text(t):
    mapped = F.when(F.lower(F.trim("p_type")) == "economy", " Onshore").when(F.lower(F.trim("p_type")).startswith("prom"), "offshore wind")
    return t("part").groupBy("p_type", zn.wind_technology(mapped).alias("tech")).agg(F.count("*").alias("n"))


_NAMES = "|".join(tx.NAMES)
_REDACTED = f"regexp_replace(text, '(?i)\\b({_NAMES})(\\s*[=:]\\s*)\"[^\"]*\"', '\\1\\2\"***\"', 'g')"
for _q, _v in (('"', '"'), ('"', "''"), ("''", '"'), ("''", "''")):
    _REDACTED = f"regexp_replace({_REDACTED}, '(?i){_q}({_NAMES}){_q}(\\s*:\\s*){_v}[^{_v[0]}]*{_v}', '{_q}\\1{_q}\\2{_v}***{_v}', 'g')".replace("[^']", "[^'']")


@_query(f"SELECT doc_id, regexp_replace({_REDACTED}, '(?i)\\b({_NAMES})=[^\\s&\"''<>\\])]+', '\\1=***', 'g') AS redacted FROM documents")
def redact_text(t):
    return t("documents").select("doc_id", tx.redact(F.col("text")).alias("redacted"))


def _placed(t) -> DataFrame:
    return t("customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", (F.pmod(F.col("c_custkey") * 37, F.lit(200)) - 100.0).alias("lat"), (F.pmod(F.col("c_custkey") * 53, F.lit(400)) - 200.0).alias("lon"))


_PLACED = "SELECT *, CAST(c_custkey * 37 % 200 - 100 AS DOUBLE) AS lat, CAST(c_custkey * 53 % 400 - 200 AS DOUBLE) AS lon FROM customer"


@_query(f"SELECT c_custkey, lat, lon FROM ({_PLACED}) WHERE c_acctbal > 0 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180")
def clean_coordinates(t):
    return zn.clean_coordinates(_placed(t), "lat", "lon", "c_acctbal").select("c_custkey", "lat", "lon")


@_query(f"SELECT c_custkey, lat, lon FROM ({_PLACED}) WHERE c_nationkey >= 10 OR (lat BETWEEN -c_nationkey * 5 AND c_nationkey * 5 AND lon BETWEEN -90 AND 90)")
def bbox_filter(t):
    boxes = t("nation").filter("n_nationkey < 10").select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_nationkey") * -5.0).alias("lat_min"), (F.col("n_nationkey") * 5.0).alias("lat_max"), F.lit(-90.0).alias("lon_min"), F.lit(90.0).alias("lon_max"))
    return zn.inside_box(_placed(t), boxes, "c_nationkey").select("c_custkey", "lat", "lon")


@_query(f"SELECT c_nationkey, round(max(2 * 6371 * asin(sqrt(pow(sin(radians(lat - 0) / 2), 2) + cos(radians(lat)) * pow(sin(radians(lon - 0) / 2), 2)))), 6) AS radius_km FROM ({_PLACED}) GROUP BY ALL")
def haversine_radius(t):
    return _placed(t).groupBy("c_nationkey").agg(F.round(F.max(zn.haversine_km(F.lit(0.0), F.lit(0.0), F.col("lat"), F.col("lon"))), 6).alias("radius_km"))


@_query()
def zone_clusters(t):
    plants = zn.clean_coordinates(_placed(t), "lat", "lon", "c_acctbal")
    return zn.cluster_zones(plants, ["c_nationkey"], "c_custkey", "lat", "lon", "c_acctbal", 2500.0, 1000.0)


@_query("SELECT event_id, date_part('month', ts)::INTEGER AS month_no, CAST(floor(hour(ts) / 6) * 6 AS INTEGER) AS run_hour, date_trunc('day', ts) + INTERVAL 2 DAY - INTERVAL 1 SECOND AS day_ahead_end FROM events")
def month_labels(t):
    return t("events").select("event_id", F.month("ts").alias("month_no"), (F.floor(F.hour("ts") / 6) * 6).cast("int").alias("run_hour"), (ts.floor_to("ts", "day") + F.expr("interval 2 day") - F.expr("interval 1 second")).alias("day_ahead_end"))


@_query("SELECT c_mktsegment, o_orderkey, o_totalprice FROM (SELECT c_mktsegment, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders JOIN customer ON o_custkey = c_custkey) WHERE r <= 10")
def top_k_orders(t):
    from pyspark.sql import Window

    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.desc("o_totalprice"), "o_orderkey"))).filter("r <= 10").select("c_mktsegment", "o_orderkey", "o_totalprice")


@_query("SELECT DISTINCT s_suppkey, b.n_name AS neighbour FROM supplier JOIN nation a ON s_nationkey = a.n_nationkey JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey")
def border_expansion(t):
    nation = t("nation")
    edges = nation.alias("a").join(nation.alias("b"), (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") != F.col("b.n_nationkey"))).select(F.col("a.n_nationkey").alias("s_nationkey"), F.col("b.n_name").alias("neighbour"))
    return t("supplier").join(edges, "s_nationkey").select("s_suppkey", "neighbour").distinct()


# streams: each equals its batch twin


@_query(_SQL["hourly_mean"], digits="mean_value")
def stream_hourly_mean(spark, sf_dir):
    return jobs.collected(spark, jobs.hourly_mean(jobs.read_table(spark, sf_dir, "events"), ["event_type"], "ts", "value"), "update", ["event_type", "ts"])


#: The instant up to which a stream's watermark has come at the end of the table.
_MARK = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 7 DAY FROM events)"


@_query(f"SELECT * FROM ({_SQL['hourly_mean']}) WHERE ts + INTERVAL 1 HOUR <= {_MARK}", digits="mean_value")
def stream_closed_hours(spark, sf_dir):
    """Each hour once, when the watermark closes it and its state goes."""
    return jobs.collected(spark, jobs.hourly_mean(jobs.read_table(spark, sf_dir, "events", 1), ["event_type"], "ts", "value"), "append")


@_query("SELECT count(*) AS n FROM events")
def stream_dedupe(spark, sf_dir):
    rows = jobs.collected(spark, jobs.dedupe(jobs.read_table(spark, sf_dir, "events"), ["event_id"], "ts"), "append")
    return rows.agg(F.count("*").alias("n"))


@_query("SELECT user_id, count(*) AS n, min(ts) AS first_seen, max(ts) AS last_seen FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 21600000000 THEN 1 ELSE 0 END AS new FROM events)) GROUP BY user_id, s" + f" HAVING max(ts) + INTERVAL 6 HOUR <= {_MARK}")
def stream_sessions(spark, sf_dir):
    """Sessions that are over: those that a row could still go on with stay in the state."""
    return jobs.collected(spark, jobs.sessions(jobs.read_table(spark, sf_dir, "events", 1), ["user_id"], "ts"), "append")


@_query("SELECT user_id, max(ts) AS ts, max_by(event_id, ts) AS event_id, max_by(value, ts) AS value FROM events GROUP BY ALL")
def stream_latest(spark, sf_dir):
    with jobs.large_state(spark):
        return jobs.collected(spark, jobs.latest(jobs.read_table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id", "value"]), "update", ["user_id"])


from . import ingests, reports, stores  # noqa: E402, F401  (they add their queries)
