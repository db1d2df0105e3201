"""Plans of what to fetch again, repairs of stored rows, and the study of how old values change."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import completeness as cp
from ..operators import quality as ql
from ..operators import revision as rv
from ..operators import snapshots as sn
from ..operators import timeseries as ts


def gap_repair_plan(df: DataFrame, keys: list[str], ts_col: str, marker_col: str, asked: DataFrame | None = None, min_gap_seconds: float = 3960.0) -> DataFrame:
    """Ranges to fetch again with their hours: gaps, days with NULL markers and what a user asks for (keys, start_at, end_at), as one."""
    gap = ts.gaps(df, keys, ts_col, min_gap_seconds).select(*keys, F.col("last_seen").alias("start_at"), F.col("next_seen").alias("end_at"))
    null = ts.null_day_ranges(df, keys, ts_col, marker_col).select(*keys, F.col("from_ts").alias("start_at"), F.col("to_ts").alias("end_at"))
    every = gap.unionByName(null)
    every = every if asked is None else every.unionByName(asked.select(*keys, "start_at", "end_at"))
    hours = (ts.micros("end_at") - ts.micros("start_at")) / 3_600_000_000
    return ts.merge_intervals(every, keys, "start_at", "end_at").withColumn("hours", F.floor(hours))


def catch_up_plan(df: DataFrame, keys: list[str], ts_col: str, since: str, until: str, min_gap_hours: float = 6.0) -> DataFrame:
    """Windows to fetch for outages inside a range, with the rows each already holds: both ends known, an hour more at the end."""
    inside = ts.time_range(df, ts_col, since, until)
    holes = ts.gaps(inside, keys, ts_col, min_gap_hours * 3600)
    windows = holes.select(*keys, F.col("last_seen").alias("from_ts"), (F.col("next_seen") + F.expr("interval 1 hour")).alias("to_ts"), (F.col("gap_seconds") / 3600).alias("gap_hours"))
    return rows_in_windows(df, windows, keys, ts_col, "rows_before")


def rows_in_windows(df: DataFrame, windows: DataFrame, keys: list[str], ts_col: str, out: str) -> DataFrame:
    """Windows with the number of rows inside each, both ends included: instants and ends are sorted together once and counted on.

    The columns of a window go with its ends, which find each other by keys and instants: numbers given to rows differ from
    one computation to the next. Rows without a key lie in no window.
    """
    from pyspark.sql import Window

    at = lambda end, place: F.struct(F.col(end).alias("t_"), F.lit(place).alias("o_"))
    marks = windows.withColumn("m_", F.explode(F.array(at("from_ts", 0), at("to_ts", 2)))).select(*windows.columns, "m_.*")
    rows = df.dropna(subset=keys).select(*keys, F.col(ts_col).alias("t_"), F.lit(1).alias("o_"))
    order = Window.partitionBy(*keys).orderBy("t_", "o_").rowsBetween(Window.unboundedPreceding, 0)
    seen = marks.unionByName(rows, allowMissingColumns=True).withColumn("n_", F.count_if(F.col("o_") == 1).over(order)).filter("o_ <> 1")
    until = lambda place: F.max(F.when(F.col("o_") == place, F.col("n_"))).over(Window.partitionBy(*keys, "from_ts", "to_ts"))
    return seen.withColumn(out, until(2) - until(0)).filter("o_ = 2").select(*windows.columns, out)


def recovery(windows: DataFrame, df: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """What fetching a plan's windows has added: rows before, after, and recovered."""
    return rows_in_windows(df, windows, keys, ts_col, "rows_after").withColumn("recovered", F.col("rows_after") - F.col("rows_before"))


def publication_repair_plan(df: DataFrame, keys: list[str], ts_col: str, marker_col: str, chunk_days: int = 90) -> DataFrame:
    """Pieces of days to ask for again: runs of days with rows that lack the marker, cut into half-open pieces."""
    islands = ts.day_islands(df.filter(F.col(marker_col).isNull()), keys, ts_col)
    bounds = islands.select(*keys, F.col("first_day").cast("timestamp_ntz").alias("start_at"), (F.col("last_day").cast("timestamp_ntz") + F.expr("interval 1 day")).alias("end_at"))
    return ts.chunks(bounds, "start_at", "end_at", chunk_days).select(*keys, "chunk_start", "chunk_end")


def repair_publications(df: DataFrame, published: DataFrame, keys: list[str], ts_col: str, marker_col: str, start: str, end: str) -> DataFrame:
    """The table with its missing markers filled from what was fetched again, in a half-open range; others are left as they are."""
    newest = published.groupBy(*keys).agg(F.max(marker_col).alias(marker_col))
    return sn.null_only_update(df, newest, keys, marker_col, ts_col, start, end)


def month_plan(df: DataFrame, keys: list[str], ts_col: str, first: str, last: str, members: DataFrame | None = None) -> DataFrame:
    """Months to fetch, [month, next month), for members of the target table or of another one that has proved to have data."""
    wanted = df if members is None else members.select(*keys, F.lit(None).cast("timestamp_ntz").alias(ts_col)).unionByName(df.select(*keys, ts_col))
    plan = cp.missing_months(wanted, keys, ts_col, first, last)
    return plan.select(*keys, "month", (F.col("month") + F.expr("interval 1 month")).alias("month_end"), F.date_format("month", "yyyy-MM").alias("month_key"))


def drifts(pairs: dict[str, tuple[DataFrame, DataFrame, list[str]]]) -> DataFrame:
    """(dimension, side, member) of what only one side of each dimension holds."""
    out = None
    for name, (left, right, keys) in pairs.items():
        found = ql.drift(left, right, keys).select(F.lit(name).alias("dimension"), "side", F.concat_ws(":", *(F.col(k).cast("string") for k in keys)).alias("member"))
        out = found if out is None else out.unionByName(found)
    return out


MODES = ("exposure", "sweep", "confirm", "boundary", "spot")


def revision_study(df: DataFrame, keys: list[str], target_col: str, clock_col: str, value: str, reference: str, other: str, horizon: float, modes: tuple[str, ...] = MODES, min_rows: int = 200, tolerance: float = 0.10, **steps) -> dict[str, DataFrame]:
    """The study by modes, each a report by its name; ``value`` over ``reference`` is screened, over ``other`` confirmed.

    exposure: rows younger than the horizon; sweep: effects of age; confirm: effects that the other reference shows too;
    boundary: where the ratio steps, with ``boundary_profile``, the ratio by age; spot: write sessions with targets on both
    sides of the horizon, the newest first, and of the newest one ``spot_effects`` (the ratio's shift where the horizon lies,
    and its placebos), ``spot_verdict``, ``spot_samples`` and ``spot_detectable`` (see ``spot_check``).
    """
    unknown = sorted(set(modes) - set(MODES))
    if unknown:
        raise ValueError(f"unknown modes: {', '.join(unknown)}")
    age: Column = rv.age_days(clock_col, target_col)
    effect = lambda den: rv.vintage_effect(df, keys, value, den, age, horizon, min_rows, tolerance)
    reports = {
        "exposure": lambda: rv.exposure(df, keys, age, target_col, horizon),
        "sweep": lambda: effect(reference),
        "confirm": lambda: rv.confirmed_effects(df, keys, value, reference, other, age, horizon, min_rows, tolerance),
        "boundary": lambda: {"boundary": rv.step_detector(df, keys, value, reference, age, **steps), "boundary_profile": rv.age_profile(df, value, reference, age)},
        "spot": lambda: spot_check(df, target_col, clock_col, value, reference, horizon, min_rows),
    }
    found: dict[str, DataFrame] = {}
    for mode in modes:
        report = reports[mode]()
        found |= report if isinstance(report, dict) else {mode: report}
    return found


#: Days from the real split to its placebos; all lie in the older band, as the younger one is too short for a window.
PLACEBO_DAYS = (-30, -50, -70, -90, -110)


def spot_check(df: DataFrame, target_col: str, clock_col: str, value: str, reference: str, horizon: float, min_rows: int = 200, days: int = 20, least: int = 1000) -> dict[str, DataFrame]:
    """Whether the newest session that wrote targets on both sides of the horizon shows a step there.

    Rows of that session alone are compared: the ratio of ``value`` to ``reference`` in ``days`` days before and after the
    split, against placebo splits whose windows lie wholly before it, and the two samples of ``value`` by themselves with the
    smallest shift that they could show. Without such a session there are only the (no) sessions.
    """
    sessions = rv.write_sessions(df, clock_col, rv.age_days(clock_col, target_col), horizon, min_rows)
    newest = sessions.first()
    if newest is None:
        return {"spot": sessions}
    split = dt.datetime.combine(newest["session"], dt.time()) - dt.timedelta(days=horizon)
    rows = df.filter((F.to_date(clock_col) == F.lit(newest["session"])) & F.col(value).isNotNull())
    paired = rows.filter(F.col(reference).isNotNull())
    at = lambda offset: str(split + dt.timedelta(days=offset))
    effects = rv.split_effects(paired, target_col, value, [at(0), *(at(k) for k in PLACEBO_DAYS if k + days <= 0)], days, per_col=reference)
    near = F.abs((ts.seconds(target_col) - ts.seconds(F.lit(at(0)).cast("timestamp_ntz"))) / 86_400) <= days
    samples = rv.two_samples(rows.filter(near), F.col(target_col) >= F.lit(at(0)).cast("timestamp_ntz"), value)
    return {"spot": sessions, "spot_effects": effects, "spot_verdict": rv.placebo_verdict(effects, at(0), least), "spot_samples": samples, "spot_detectable": rv.minimum_detectable_effect(samples)}
