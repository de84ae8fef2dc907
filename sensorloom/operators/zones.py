"""Zone grids ``zone_samples(building, zone, ts, actual, setpoint, gain, grid_idx, is_empty, is_bad)``: statistics, regimes, energy proxy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import staged
from . import order
from .series import running, running_all

KEY = ["building", "zone"]

# Thresholds of the heating analyses.
RULES = {
    "dead_gain_max": 0.0,
    "stuck_min_rows": 1000,
    "stuck_max_distinct": 3,
    "stuck_max_std": 0.05,
    "binary_share": 0.98,
    "kn_values": (50.0, 33.33, 66.67, 25.0, 75.0, 20.0, 40.0, 60.0, 80.0),
    "modulating_min_distinct": 500,
    "modulating_min_interior": 0.2,
    "season_months": (10, 11, 12, 1, 2, 3, 4),
    "season_max_outdoor": 12.0,
    "winter_months": (12, 1, 2),
    "summer_months": (6, 7, 8),
    "min_active_duty": 2.0,
    "dominance": 1.25,
    "min_sp_drop": 1.0,
    "gain_off": 5.0,
    "gain_on": 20.0,
    "max_window": 480,
    "min_window_t63": 240,
    "plateau_min_drop": 1.5,
    "outdoor_bins": (-5, 0, 5, 10),
    "fast_max": 90,
    "slow_min": 240,
    "floor_median": 480,
    "floor_share": 0.5,
    "min_events": 10,
}
#: Grid rows of a zone that one task orders.
CHUNK = 1 << 16
#: Caps of the histograms.
T_CAP, SP_CAP, GAIN_CAP, TOP_VALUES = 512, 64, 4096, 8


MEASURES = {"t": "actual", "sp": "setpoint", "gain": "gain", "comfort": "comfort"}


def _chunk_facts(samples: DataFrame) -> DataFrame:
    """A row per zone and chunk: counts and bounds of each measure, changes inside the chunk, and its first and last known values.

    One shuffle by (zone, chunk) serves the lags and all sums.
    """
    before = Window.partitionBy(*KEY, "_chunk").orderBy("grid_idx").rowsBetween(Window.unboundedPreceding, -1)
    rows = samples.withColumns({"_t": F.last("actual", ignorenulls=True).over(before), "_sp": F.last("setpoint", ignorenulls=True).over(before)})
    data = ~F.col("is_empty") & ~F.col("is_bad")
    at = lambda c: F.when(F.col(c).isNotNull(), F.col("grid_idx"))
    sums = [x for name, c in MEASURES.items() for x in (F.count(c).alias(f"{name}_n"), F.min(c).alias(f"{name}_min"), F.max(c).alias(f"{name}_max"))]
    return rows.groupBy(*KEY, "_chunk").agg(
        F.count("*").alias("n_grid"),
        F.count_if(data).alias("n_data"),
        F.count_if("is_bad").alias("n_bad"),
        F.min(F.when(data, F.col("ts"))).alias("first_ts"),
        F.max(F.when(data, F.col("ts"))).alias("last_ts"),
        *sums,
        F.count_if(F.col("gain") == 0).alias("gain_0"),
        F.count_if(F.col("gain") == 100).alias("gain_100"),
        F.count_if((F.col("gain") > 0) & (F.col("gain") < 100)).alias("gain_interior"),
        F.count_if(F.col("comfort") < -1).alias("cold"),
        F.count_if(F.col("comfort") > 1).alias("warm"),
        F.count_if(F.col("actual") != F.col("_t")).alias("t_changes"),
        F.count_if(F.col("setpoint") != F.col("_sp")).alias("sp_steps"),
        F.min_by("actual", at("actual")).alias("t0"), F.max_by("actual", at("actual")).alias("t1"),
        F.min_by("setpoint", at("setpoint")).alias("sp0"), F.max_by("setpoint", at("setpoint")).alias("sp1"),
    )


def _zone_facts(chunks: DataFrame) -> DataFrame:
    """Chunks of a zone together, with changes across borders too."""
    before = Window.partitionBy(*KEY).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    rows = chunks.withColumns({"_t": F.last("t1", ignorenulls=True).over(before), "_sp": F.last("sp1", ignorenulls=True).over(before)})
    bounds = [x for m in MEASURES for x in (F.sum(f"{m}_n").alias(f"{m}_n"), F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max"))]
    changes = lambda inside, first, last: F.sum(F.col(inside) + F.coalesce((F.col(first) != F.col(last)).cast("long"), F.lit(0)))
    return rows.groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in ("n_grid", "n_data", "n_bad")],
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        *bounds,
        *[F.sum(c).alias(c) for c in ("gain_0", "gain_100", "gain_interior", "cold", "warm")],
        F.when(F.sum("t_n") > 0, changes("t_changes", "t0", "_t")).alias("t_changes"),
        F.when(F.sum("sp_n") > 0, changes("sp_steps", "sp0", "_sp")).alias("sp_steps"),
    )


def _histograms(samples: DataFrame) -> DataFrame:
    """Per zone and signal: mean and deviation, distinct values (null beyond the cap) and the most frequent values of set point and gain.

    From counts per value, never a whole list; the signals share one shuffle. Values are summed in the order of their ranks, so
    no chunking and no rerun changes a digit of the moments.
    """
    pair = lambda name, column: F.struct(F.lit(name).alias("signal"), F.col(column).alias("value"))
    cells = samples.select(*KEY, "grid_idx", F.explode(F.array(*[pair(name, c) for name, c in MEASURES.items()])).alias("c"))
    counts = cells.select(*KEY, "grid_idx", "c.*").where("value is not null").groupBy(*KEY, "signal", "value").agg(F.count("*").alias("count"), F.min("grid_idx").alias("seen"))
    group = Window.partitionBy(*KEY, "signal").orderBy(F.desc("count"), "seen", "value")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    value, n = F.col("value"), F.col("count")
    ranked = counts.withColumns({"_rn": F.row_number().over(group), "_n": F.count("*").over(whole), "_rows": F.sum(n).over(whole), "_sum": F.sum(value * n).over(whole)})
    ranked = ranked.withColumn("_mean", F.col("_sum") / F.col("_rows"))
    ranked = ranked.withColumn("_spread", F.sum((value - F.col("_mean")) * (value - F.col("_mean")) * n).over(whole))
    ranked = ranked.withColumn("_std", F.when(F.col("_rows") > 1, F.sqrt(F.col("_spread") / (F.col("_rows") - 1))).otherwise(0.0))
    top = F.when(F.col("signal") == "sp", SP_CAP).when(F.col("signal") == "gain", TOP_VALUES).otherwise(1)
    ranked = ranked.where(F.col("_rn") <= top)
    of = lambda name: F.col("signal") == name
    distinct = lambda name, cap: F.max(F.when(of(name) & (F.col("_n") <= cap), F.col("_n"))).alias(f"{name}_distinct")
    listed = lambda name: F.transform(F.sort_array(F.collect_list(F.when(of(name), F.struct("_rn", "value", "count")))), lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count")))
    some = lambda name: F.when(F.count(F.when(of(name), 1)) > 0, listed(name)).alias(f"{name}_top")
    moments = [F.max(F.when(of(m), F.col(f"_{x}"))).alias(f"{m}_{x}") for m in MEASURES for x in ("mean", "std")]
    return ranked.groupBy(*KEY).agg(*moments, distinct("t", T_CAP), distinct("sp", SP_CAP), distinct("gain", GAIN_CAP), some("sp"), some("gain"))


def zone_stats(samples: DataFrame) -> DataFrame:
    """A row per zone: grid counts, moments of temperature, set point, gain and comfort, histograms, changes and quality flags."""
    samples = samples.withColumn("comfort", F.col("actual") - F.col("setpoint"))
    chunks = _chunk_facts(samples.withColumn("_chunk", F.floor(F.col("grid_idx") / CHUNK)))
    facts, values = _zone_facts(chunks), _histograms(samples).withColumnsRenamed({k: f"_{k}" for k in KEY})
    facts = facts.join(values, [facts[k].eqNullSafe(values[f"_{k}"]) for k in KEY], "left").drop(*[f"_{k}" for k in KEY])
    moments = [f"{m}_{x}" for m in MEASURES for x in ("n", "min", "max", "mean", "std")]
    counts = ["n_grid", "n_data", "n_bad", "first_ts", "last_ts"]
    facts = facts.select(*KEY, *counts, *moments, *[c for c in facts.columns if c not in (*KEY, *counts, *moments)])
    share = lambda c: F.when(F.col("gain_n") > 0, F.col(c) / F.col("gain_n"))
    facts = facts.withColumns({"pct_0": share("gain_0"), "pct_100": share("gain_100"), "pct_interior": share("gain_interior")})
    r = RULES
    flags = F.array_compact(
        F.array(
            F.when(F.col("n_data") == 0, "empty"),
            F.when(F.col("gain_max") == r["dead_gain_max"], "dead_gain"),
            F.when((F.col("t_n") >= r["stuck_min_rows"]) & ((F.col("t_distinct") <= r["stuck_max_distinct"]) | (F.col("t_std") <= r["stuck_max_std"])), "stuck_sensor_suspect"),
            F.when(F.col("sp_distinct").isNull() & (F.col("sp_n") > 0), "sp_levels_capped"),
        )
    )
    return facts.withColumn("flags", flags)


def gain_regime(stats: DataFrame) -> DataFrame:
    """no_data, dead, binary, modulating or mixed, from a zone's gain histogram."""
    r = RULES
    near = F.array(*[F.lit(v) for v in r["kn_values"]])
    hits = F.filter(F.coalesce("gain_top", F.array().cast("array<struct<value:double,count:bigint>>")), lambda x: F.exists(near, lambda k: F.abs(x["value"] - k) <= 0.05))
    kn = F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, x: a + x["count"]) / F.col("gain_n")
    out = stats.withColumn("pct_kn", F.when(F.col("gain_n") > 0, kn))
    regime = (
        F.when(F.coalesce("gain_n", F.lit(0)) == 0, "no_data")
        .when(F.col("gain_max") <= r["dead_gain_max"], "dead")
        .when(F.col("pct_0") + F.col("pct_100") + F.col("pct_kn") >= r["binary_share"], "binary")
        .when(F.col("gain_distinct").isNull() | (F.col("gain_distinct") >= r["modulating_min_distinct"]) | (F.col("pct_interior") >= r["modulating_min_interior"]), "modulating")
        .otherwise("mixed")
    )
    return out.select(*KEY, "pct_0", "pct_100", "pct_interior", "pct_kn", regime.alias("regime"))


def regime_counts(regimes: DataFrame) -> DataFrame:
    kinds = ["no_data", "dead", "binary", "modulating", "mixed"]
    return regimes.groupBy("building").agg(*[F.count_if(F.col("regime") == k).alias(k) for k in kinds], F.count("*").alias("zones"))


def hourly_proxy(samples: DataFrame) -> DataFrame:
    """Mean gain and samples per zone and UTC hour; hours without a reading have no row."""
    hours = samples.where("gain is not null").groupBy(*KEY, F.date_trunc("hour", "ts").alias("hour"))
    return hours.agg(F.avg("gain").alias("mean_gain"), F.count("*").alias("n"))


def daily_duty(hourly: DataFrame) -> DataFrame:
    """Coverage-weighted mean gain per building and day."""
    return hourly.groupBy("building", F.to_date("hour").alias("day")).agg((F.sum(F.col("mean_gain") * F.col("n")) / F.sum("n")).alias("duty"), F.sum("n").alias("n"))


def orientation(hourly: DataFrame) -> DataFrame:
    """Heating, cooling, dual or idle, by winter and summer duty of a zone."""
    r, month = RULES, F.month("hour")

    def duty(months):
        inside = month.isin(*months)
        return F.sum(F.when(inside, F.col("mean_gain") * F.col("n"))), F.sum(F.when(inside, F.col("n")))

    (wg, wn), (sg, sn) = duty(r["winter_months"]), duty(r["summer_months"])
    out = hourly.groupBy(*KEY).agg(wg.alias("_wg"), wn.alias("_wn"), sg.alias("_sg"), sn.alias("_sn")).where("_wn is not null or _sn is not null")
    out = out.withColumn("_w", F.coalesce(F.col("_wg") / F.col("_wn"), F.lit(0.0))).withColumn("_s", F.coalesce(F.col("_sg") / F.col("_sn"), F.lit(0.0)))
    low, ratio = r["min_active_duty"], r["dominance"]
    kind = F.when((F.col("_w") < low) & (F.col("_s") < low), "idle").when((F.col("_s") > ratio * F.col("_w")) & (F.col("_s") >= low), "cooling").when(F.col("_w") > ratio * F.col("_s"), "heating").otherwise("dual")
    return out.select(*KEY, F.round("_w", 2).alias("winter_duty"), F.round("_s", 2).alias("summer_duty"), kind.alias("orientation"))


def setpoint_steps(samples: DataFrame, lo: str, hi: str) -> DataFrame:
    """Upward set-point steps inside a window of dates, by minute of the day; the earlier value must lie inside too."""
    inside = samples.where(F.col("setpoint").isNotNull() & (F.to_date("ts") >= F.lit(lo).cast("date")) & (F.to_date("ts") <= F.lit(hi).cast("date")))
    steps = running(inside, KEY, F.col("setpoint"), F.floor(F.col("grid_idx") / CHUNK), "grid_idx", "last", "_p").where(F.col("setpoint") > F.col("_p"))
    return steps.select(*KEY, (F.hour("ts") * 60 + F.minute("ts")).alias("minute"), "grid_idx")


def step_modes(steps: DataFrame, top: int = 3) -> DataFrame:
    """The ``top`` most frequent minutes of a building; ties go to the one seen first."""
    counts = steps.groupBy("building", "minute").agg(F.count("*").alias("n"), F.min(F.struct("zone", "grid_idx")).alias("seen"))
    rank = F.row_number().over(Window.partitionBy("building").orderBy(F.desc("n"), "seen"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= top).drop("seen")


def tracking_error(samples: DataFrame) -> DataFrame:
    """Actual minus set point in the winter half-year, all and split at the middle of the 10th and 90th ranked set points."""
    rows = samples.where(F.col("actual").isNotNull() & F.col("setpoint").isNotNull() & F.month("ts").isin(10, 11, 12, 1, 2, 3))
    counts = rows.groupBy(*KEY).agg(F.count("*").alias("_n"))
    tenth = F.array(F.struct(F.lit("lo").alias("end"), F.floor(F.col("_n") / 10).alias("pos")), F.struct(F.lit("hi").alias("end"), F.floor(9 * F.col("_n") / 10).alias("pos")))
    ends = staged(counts.select(*KEY, F.explode(tenth).alias("e")).select(*KEY, "e.*"))
    cut = ends.join(order.at_positions(rows, KEY, "setpoint", ends), [*KEY, "pos"]).groupBy(*KEY).agg((F.sum("setpoint") / 2).alias("_mid"))
    e = F.col("actual") - F.col("setpoint")
    split = rows.join(cut, KEY)
    split = split.withColumn("part", F.explode(F.array(F.lit("all"), F.when(F.col("setpoint") >= F.col("_mid"), "comfort").otherwise("setback"))))
    return split.groupBy(*KEY, "part").agg(F.count("*").alias("n"), F.round(F.avg(F.abs(e)), 2).alias("mean_abs"), F.round(F.max(F.abs(e)), 2).alias("max_abs"), F.round(F.avg(e), 2).alias("bias"), F.round(100 * F.avg((F.abs(e) <= 1).cast("int")), 1).alias("within_1k"))


def control_behaviour(samples: DataFrame) -> DataFrame:
    """How a zone's gain moves: shares at the ends and between, different values, on/off changes per day, mean step."""
    grid = samples.groupBy(*KEY).agg(F.count("*").alias("_grid"))
    state = F.when((F.col("gain") < 10) | (F.col("gain") > 90), F.col("gain") > 90)
    rows = samples.where("gain is not null").select(*KEY, "grid_idx", "gain", state.alias("_s"))
    rows = running_all(rows, KEY, {"_g": (F.col("gain"), "last"), "_p": (F.col("_s"), "last")}, F.floor(F.col("grid_idx") / CHUNK), "grid_idx")
    rows = rows.withColumn("_d", F.abs(F.col("gain") - F.col("_g")))
    facts = rows.groupBy(*KEY).agg(
        F.count_if(F.col("_s") != F.col("_p")).alias("_turns"),
        F.count("*").alias("n"),
        F.round(100 * F.avg((F.col("gain") <= 0.5).cast("int")), 1).alias("pct_off"),
        F.round(100 * F.avg((F.col("gain") >= 99.5).cast("int")), 1).alias("pct_full"),
        F.round(100 * F.avg(((F.col("gain") > 0.5) & (F.col("gain") < 99.5)).cast("int")), 1).alias("pct_between"),
        F.count_distinct(F.round("gain", 1)).alias("levels"),
        F.round(F.avg(F.when(F.col("_d") > 0, F.col("_d"))), 2).alias("mean_step"),
    )
    out = facts.join(grid, KEY)
    return out.select(*KEY, "n", "pct_off", "pct_full", "pct_between", "levels", F.round(F.col("_turns") / (F.col("_grid") / 1440), 2).alias("turns_per_day"), "mean_step")


def signal_summary(samples: DataFrame, column: str) -> DataFrame:
    """Count, mean, range, first and last of one signal per zone."""
    rows = samples.where(F.col(column).isNotNull())
    return rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.avg(column).alias("mean"), F.min(column).alias("min"), F.max(column).alias("max"), F.min_by(column, "grid_idx").alias("first"), F.max_by(column, "grid_idx").alias("last"))


#: Roles of a zone's signals and their columns.
SIGNALS = {"r": "setpoint", "y": "actual", "u": "gain"}


def signal(samples: DataFrame, building: str, zone: str, name: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """``(ts, value)`` of one signal of a zone, by column or role, from ``start`` to ``end``: times or their beginnings, both included."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    rows = samples.where((F.col("building") == building) & (F.col("zone") == zone))
    if start:
        rows = rows.where(text >= start)
    if end:
        rows = rows.where(F.substring(text, 1, len(end)) <= end)
    return rows.select("ts", F.col(SIGNALS.get(name, name)).alias("value"))
