"""Whether a stored value depends on how old it was when it was written: magnitude-weighted ratios, bands, splits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .timeseries import number, seconds


#: Days of age up to which rows count for the step's floor.
OLDEST = 70


def age_days(clock: str, target: str) -> Column:
    return (seconds(clock) - seconds(target)) / 86_400


def age_bands(df: DataFrame, age: Column, target_col: str, edges: tuple[int, ...] = (0, 7, 14, 21, 28, 35, 90)) -> DataFrame:
    band = F.when(age < edges[0], f"<{edges[0]}")
    for e in edges[1:]:
        band = band.when(age < e, f"<{e}")
    return df.filter(age.isNotNull()).withColumn("band", band.otherwise(f">={edges[-1]}")).groupBy("band").agg(F.count("*").alias("n"), F.min(target_col).alias("first_target"), F.max(target_col).alias("last_target"))


def exposure(df: DataFrame, keys: list[str], age: Column, target_col: str, horizon: float) -> DataFrame:
    young = age < horizon
    n, u = F.count("*"), F.sum(young.cast("int"))
    return df.filter(age.isNotNull()).groupBy(*keys).agg(n.alias("n"), u.alias("unrevised"), F.max(F.when(~young, F.col(target_col))).alias("settled_through"), F.min(F.when(young, F.col(target_col))).alias("unrevised_from"), (100.0 * u / n).alias("pct"))


def vintage_effect(df: DataFrame, keys: list[str], num: str, den: str, age: Column, horizon: float, min_rows: int = 200, tolerance: float = 0.10) -> DataFrame:
    """(sum num / sum den, aged) over (the same, young): paired rows only, enough of them in both bands."""
    paired = df.filter(F.col(num).isNotNull() & F.col(den).isNotNull() & age.isNotNull()).withColumn("old_", age >= horizon)
    s = lambda c, old: F.sum(F.when(F.col("old_") == old, number(c))).cast("double")
    n = lambda old: F.sum((F.col("old_") == old).cast("int"))
    grouped = paired.groupBy(*keys).agg(n(True).alias("n_old"), n(False).alias("n_young"), *(s(c, o).alias(f"{p}_{q}") for c, p in ((num, "g"), (den, "r")) for o, q in ((True, "old"), (False, "young"))))
    grouped = grouped.filter((F.col("n_old") >= min_rows) & (F.col("n_young") >= min_rows) & (F.col("r_old") != 0) & (F.col("r_young") != 0) & (F.col("g_young") != 0) & (F.col("g_old") != 0))
    effect = (F.col("g_old") / F.col("r_old")) / (F.col("g_young") / F.col("r_young"))
    return grouped.withColumn("effect", effect).withColumn("flagged", F.abs(F.col("effect") - 1) > tolerance).drop("g_old", "g_young", "r_old", "r_young")


def verdicts(screened: DataFrame, confirmed: DataFrame, keys: list[str], tolerance: float = 0.10) -> DataFrame:
    """A flagged effect holds if an independent reference shows it too, on the same side of 1."""
    other = confirmed.select(*keys, F.col("effect").alias("effect_confirm"))
    return screened.join(other, keys, "left").withColumn("verdict", _verdict(tolerance))


def vintage_effects(df: DataFrame, keys: list[str], num: str, dens: list[str], age: Column, horizon: float, min_rows: int = 200, tolerance: float = 0.10) -> DataFrame:
    """``vintage_effect`` against several references, a row for each key and reference (``den``), in one pass over ``df``."""
    each = F.explode(F.array(*(F.struct(F.lit(d).alias("den"), F.col(d).cast("double").alias("value_")) for d in dens)))
    rows = df.select(*keys, F.col(num).alias("num_"), age.alias("age_"), each.alias("x")).select(*keys, "num_", "age_", "x.*")
    return vintage_effect(rows, [*keys, "den"], "num_", "value_", F.col("age_"), horizon, min_rows, tolerance)


def confirmed_effects(df: DataFrame, keys: list[str], num: str, den: str, other: str, age: Column, horizon: float, min_rows: int = 200, tolerance: float = 0.10) -> DataFrame:
    """``verdicts`` of ``num`` over ``den``, screened, and over ``other``, which confirms; ``df`` is read once."""
    both = vintage_effects(df, keys, num, [den, other], age, horizon, min_rows, tolerance)
    own = lambda d, c: F.max(F.when(F.col("den") == d, F.col(c)))
    wide = both.groupBy(*keys).agg(*(own(den, c).alias(c) for c in ("n_old", "n_young", "effect", "flagged")), own(other, "effect").alias("effect_confirm"))
    return wide.filter("effect is not null").withColumn("verdict", _verdict(tolerance))


def _verdict(tolerance: float) -> Column:
    said = F.when(~F.col("flagged"), "screened only").when(F.col("effect_confirm").isNull(), "no cover")
    same = (F.abs(F.col("effect_confirm") - 1) > tolerance) & ((F.col("effect_confirm") > 1) == (F.col("effect") > 1))
    return said.when(same, "CONFIRMED").otherwise("NOT CONFIRMED")


def age_profile(df: DataFrame, num: str, den: str, age: Column, width: float = 2.0, bins: int = 24, least: int = 50) -> DataFrame:
    binned = df.withColumn("bin", F.floor(age / width)).filter((F.col("bin") >= 0) & (F.col("bin") < bins))
    ratio = F.sum(number(num)).cast("double") / F.nullif(F.sum(number(den)).cast("double"), F.lit(0.0))
    return binned.groupBy("bin").agg(F.count("*").alias("n"), ratio.alias("ratio")).filter(F.col("n") >= least)


def step_scan(df: DataFrame, keys: list[str], num: str, den: str, age: Column, half: float = 7.0, step: float = 0.25, low: float = 3.0, high: float = 45.0, least: int = 200) -> DataFrame:
    """For every split h the ratios in [h - half, h) and [h, h + half): ages are binned to the step and windows slide over bins."""
    k = int(half / step)
    bins = df.withColumn("b", F.floor(age / step).cast("int")).filter((F.col("b") >= int(low / step) - k) & (F.col("b") < int(high / step) + k))
    sums = bins.groupBy(*keys, "b").agg(F.count("*").alias("n"), F.sum(number(num)).alias("g"), F.sum(number(den)).alias("r"))
    splits = sums.select(*keys).distinct().withColumn("b", F.explode(F.sequence(F.lit(int(low / step)), F.lit(int(high / step)))))
    full = splits.withColumn("is_split", F.lit(True)).join(sums, [*keys, "b"], "full")
    order = Window.partitionBy(*keys).orderBy("b")
    left, right = order.rangeBetween(-k, -1), order.rangeBetween(0, k - 1)
    side = lambda c, w: F.sum(c).over(w)
    seen = full.select(*keys, "b", "is_split", *(side(c, w).alias(f"{c}_{s}") for c in ("n", "g", "r") for s, w in (("left", left), ("right", right))))
    ratio = lambda s: F.col(f"g_{s}").cast("double") / F.nullif(F.col(f"r_{s}").cast("double"), F.lit(0.0))
    seen = seen.filter(F.col("is_split") & (F.col("n_left") >= least) & (F.col("n_right") >= least)).withColumn("r1", ratio("left")).withColumn("r2", ratio("right"))
    return seen.select(*keys, (F.col("b") * step).alias("split"), "r1", "r2", F.greatest(F.col("r1") / F.col("r2"), F.col("r2") / F.col("r1")).alias("jump")).filter("jump is not null")


def step_detector(df: DataFrame, keys: list[str], num: str, den: str, age: Column, least_jump: float = 1.10, **how) -> DataFrame:
    """The split of the largest jump per key; a boundary only if the jump is large enough.

    A key of fewer than four times ``least`` rows of age 70 days and less (800 by default) is too small to be judged.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("jump"), "split")
    enough = df.filter(F.col(num).isNotNull() & F.col(den).isNotNull() & (age <= OLDEST)).groupBy(*keys).agg(F.count("*").alias("n_")).filter(F.col("n_") >= 4 * how.get("least", 200)).select(*keys)
    scan = step_scan(df, keys, num, den, age, **how).join(enough, keys, "left_semi")
    best = scan.withColumn("rn_", F.row_number().over(order)).filter("rn_ = 1").drop("rn_")
    return best.withColumn("is_boundary", F.col("jump") >= least_jump)


def split_effects(df: DataFrame, ts_col: str, value_col: str, splits: list[str], days: int = 10, within: tuple[str, str] | None = None, per_col: str | None = None) -> DataFrame:
    """Mean before and after each of several splits in one pass (the real one and its placebos); with ``per_col`` the ratio of both sums.

    ``within``: splits whose window doesn't lie wholly in this range are left out, as placebos must lie inside one band.
    """
    if within:
        inside = lambda s: pd.Timestamp(within[0]) <= pd.Timestamp(s) - pd.Timedelta(days=days) and pd.Timestamp(s) + pd.Timedelta(days=days) <= pd.Timestamp(within[1])
        splits = [s for s in splits if inside(s)]
    every = F.array(*(F.lit(s).cast("timestamp_ntz") for s in splits))
    rows = df.withColumn("split", F.explode(every)).withColumn("d", (seconds(ts_col) - seconds("split")) / 86_400).filter((F.col("d") >= -days) & (F.col("d") < days))
    per = number(per_col) if per_col else F.lit(1)
    mean = lambda after: F.sum(F.when((F.col("d") >= 0) == after, number(value_col))).cast("double") / F.nullif(F.sum(F.when((F.col("d") >= 0) == after, per)).cast("double"), F.lit(0.0))
    return rows.groupBy("split").agg(F.count("*").alias("n"), F.count_if(F.col("d") < 0).alias("n_before"), F.count_if(F.col("d") >= 0).alias("n_after"), mean(False).alias("before"), mean(True).alias("after")).withColumn("effect", F.col("after") / F.col("before"))


def two_samples(df: DataFrame, after: Column, value_col: str) -> DataFrame:
    """n, mean, population sd and standard error of each side."""
    n, sd = F.count(value_col), F.stddev_pop(value_col)
    return df.withColumn("side", F.when(after, "after").otherwise("before")).groupBy("side").agg(n.alias("n"), F.avg(value_col).alias("mean_value"), sd.alias("sd"), (sd / F.sqrt(n.cast("double"))).alias("se"))


def minimum_detectable_effect(sides: DataFrame, reference: str = "after", errors: float = 2.0) -> DataFrame:
    """The smallest relative shift of level that two samples could show: some standard errors of their difference over the mean."""
    mean = F.max(F.when(F.col("side") == reference, F.col("mean_value")))
    return sides.agg(F.sum("n").alias("n"), (errors * F.sqrt(F.sum(F.col("se") * F.col("se"))) / F.nullif(mean, F.lit(0.0))).alias("min_detectable_effect"))


def placebo_verdict(effects: DataFrame, real: str, least: int = 1000, factor: float = 3.0) -> DataFrame:
    """Whether the real split's shift is more than ``factor`` times the largest of its placebos; samples of ``least`` rows and fewer don't count."""
    rows = effects.filter((F.col("n_before") > least) & (F.col("n_after") > least)).withColumn("shift", F.abs(F.col("effect") - 1))
    is_real = F.col("split") == F.lit(real).cast("timestamp_ntz")
    both = rows.agg(F.max(F.when(is_real, F.col("shift"))).alias("real_shift"), F.max(F.when(~is_real, F.col("shift"))).alias("worst_placebo"), F.count_if(~is_real).alias("placebos"))
    return both.withColumn("is_effect", F.col("real_shift") > factor * F.col("worst_placebo"))


def write_sessions(df: DataFrame, clock_col: str, age: Column, horizon: float, least: int) -> DataFrame:
    """Write days of many rows whose targets lie on both sides of the horizon, newest first."""
    return df.groupBy(F.to_date(clock_col).alias("session")).agg(F.count("*").alias("n"), F.min(age).alias("youngest"), F.max(age).alias("oldest")).filter((F.col("n") >= least) & (F.col("youngest") < horizon) & (F.col("oldest") >= horizon)).orderBy(F.desc("session"))
