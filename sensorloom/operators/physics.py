"""Whether heating data agree with what is known of them: duty against weather and meters, orientation, pinned facts, time zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import pearson
from .zones import KEY, RULES

#: Days that a correlation needs, the share of cooling or dual zones that calls for a warning.
MIN_DAYS, ODD_SHARE = 30, 0.2
#: Minutes by which steps of the day move between winter and summer in UTC, and in local time.
UTC_SHIFT, LOCAL_SHIFT = (45, 75), (-15, 15)


def season_days(duty: DataFrame, weather: DataFrame) -> DataFrame:
    """Days of ``duty(building, day, duty)`` in a month of the heating season that ``weather(day, temp)`` calls cold enough."""
    days = duty.join(weather, "day")
    return days.where(F.month("day").isin(*RULES["season_months"]) & (F.col("temp") < RULES["season_max_outdoor"]))


def duty_checks(duty: DataFrame, weather: DataFrame, meters: DataFrame, electric: DataFrame) -> DataFrame:
    """``(building, measure, n, r, verdict)``: duty must fall with outdoor temperature, and in buildings heated by
    electricity alone (``electric(building)``) rise with the energy of ``meters(building, day, energy)``.

    ``duty`` is that of heating zones. INCONCLUSIVE: under MIN_DAYS common days, or no correlation.
    """
    days = season_days(duty, weather)
    outdoor = days.groupBy("building").agg(F.count("*").alias("n"), pearson("duty", "temp").alias("r")).withColumns({"measure": F.lit("outdoor"), "want": F.lit(-1)})
    metered = days.join(electric.select("building").distinct(), "building", "left_semi").join(meters, ["building", "day"])
    metered = metered.groupBy("building").agg(F.count("*").alias("n"), pearson("duty", "energy").alias("r")).withColumns({"measure": F.lit("meter"), "want": F.lit(1)})
    both = outdoor.unionByName(metered)
    verdict = F.when((F.col("n") < MIN_DAYS) | F.col("r").isNull(), "INCONCLUSIVE").when(F.col("r") * F.col("want") > 0, "PASS").otherwise("CONFLICT")
    return both.select("building", "measure", "n", "r", verdict.alias("verdict"))


def orientation_counts(zones: DataFrame) -> DataFrame:
    """Zones of ``zones(building, zone, orientation)`` by orientation, with a warning where over a fifth cool or do both, and
    whether the duty checks skip the building because no zone heats."""
    kinds = ("heating", "cooling", "dual", "idle")
    out = zones.groupBy("building").agg(*[F.count_if(F.col("orientation") == k).alias(k) for k in kinds], F.count("*").alias("zones"))
    return out.withColumns({"warning": F.col("cooling") + F.col("dual") > F.col("zones") * ODD_SHARE, "skipped": F.col("heating") == 0})


def pinned(facts: DataFrame, want: DataFrame) -> DataFrame:
    """``want(building, zone, kind, expected)`` against ``facts(building, zone, file_kind, regime, flags)``, for buildings that are there.

    ``kind``: ``regime`` of a zone, a ``flag`` that it has, ``file`` kind, ``both`` regimes (binary and modulating) in a building, or the
    ``zones`` of triple files that it has. Returns ``(building, zone, kind, expected, got, ok)``.
    """
    here = want.join(facts.select("building").distinct(), "building", "left_semi")
    known = facts.select(*KEY, "file_kind", "regime", F.array_join("flags", ",").alias("_flags"), "flags")
    single = here.where("kind in ('regime', 'flag', 'file')").join(known, KEY, "left")
    got = F.when(F.col("kind") == "regime", F.col("regime")).when(F.col("kind") == "flag", F.col("_flags")).otherwise(F.col("file_kind"))
    ok = F.when(F.col("kind") == "flag", F.array_contains("flags", F.col("expected"))).otherwise(got == F.col("expected"))
    single = single.select(*KEY, "kind", "expected", got.alias("got"), F.coalesce(ok, F.lit(False)).alias("ok"))
    total = facts.groupBy("building").agg(F.array_join(F.array_sort(F.collect_set("regime")), ",").alias("_regimes"), F.count_if(F.col("file_kind") == "t_triple").cast("string").alias("_n"))
    whole = here.where("kind in ('both', 'zones')").join(total, "building")
    got = F.when(F.col("kind") == "zones", F.col("_n")).otherwise(F.col("_regimes"))
    ok = F.when(F.col("kind") == "zones", F.col("_n") == F.col("expected")).otherwise(F.contains("_regimes", F.lit("binary")) & F.contains("_regimes", F.lit("modulating")))
    return single.unionByName(whole.select(*KEY, "kind", "expected", got.alias("got"), ok.alias("ok")))


def first_mode(steps: DataFrame) -> DataFrame:
    """``(building, zone, minute, n)``: the minute of the day with the most steps of a zone, of equals the one seen first."""
    counts = steps.groupBy(*KEY, "minute").agg(F.count("*").alias("n"), F.min("grid_idx").alias("_seen"))
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("n"), "_seen"))  # minutes of a day
    return counts.withColumn("_rank", rank).where("_rank = 1").select(*KEY, "minute", "n")


def shift_votes(winter: DataFrame, summer: DataFrame) -> DataFrame:
    """``(building, zone, shift, vote)`` from set-point steps of two windows: by how many minutes a zone's first mode comes earlier in
    summer. A schedule in local time moves by an hour in UTC and stays in local stamps."""
    a, b = first_mode(winter).withColumnRenamed("minute", "_w"), first_mode(summer).withColumnRenamed("minute", "_s")
    both = a.select(*KEY, "_w").join(b.select(*KEY, "_s"), KEY).withColumn("shift", F.col("_w") - F.col("_s"))
    vote = F.when(F.col("shift").between(*UTC_SHIFT), "utc").when(F.col("shift").between(*LOCAL_SHIFT), "local").otherwise("other")
    return both.select(*KEY, "shift", vote.alias("vote"))


def timestamp_verdict(votes: DataFrame) -> DataFrame:
    """One row: votes for UTC and for local time, others, and the verdict."""
    count = lambda v: F.count_if(F.col("vote") == v).alias(v)
    out = votes.agg(count("utc"), count("local"), count("other"))
    return out.withColumn("verdict", F.when(F.col("utc") > F.col("local"), "UTC").when(F.col("local") > F.col("utc"), "LOCAL").otherwise("INCONCLUSIVE"))
