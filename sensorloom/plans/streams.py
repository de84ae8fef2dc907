"""Streams with state per key, fed in slices with a restart before each, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as ev
from ..sources.shared import staged
from ..streaming import stateful
from .heating import WIN06_SQL
from .series import STRAY_SQL, rounded
from .views import POINTS, points, zone_samples


def str04(spark, d):
    """Set-back events of a stream of zone rows in four slices; a last slice of a clock's rows lets open events end."""
    rows = staged(zone_samples(spark, d))
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    step = (high - low) / 4
    inside = lambda k: (F.col("ts") >= low + k * step) & ((F.col("ts") < low + (k + 1) * step) if k < 3 else F.lit(True))
    slices = [rows.where(inside(k)) for k in range(4)]
    clock = F.lit(high) + F.expr("interval 2 days")
    tick = rows.limit(1).withColumns({"building": F.lit("clock"), "zone": F.lit("clock"), "ts": clock, "grid_idx": F.lit(1).cast("long"), "is_empty": F.lit(False), "is_bad": F.lit(False)})
    got = stateful.run_in_slices([*slices, tick], stateful.open_decays)
    got = rounded(got.withColumn("season", ev.season("ts0")), "t0", "slope_first_hour", "drop_at_2h")
    return got.withColumn("ts0", F.date_format("ts0", "yyyy-MM-dd HH:mm:ss"))


def str03(spark, d):
    """Late rows and falls of each label, counted by a stream in three slices of arrival."""
    rows = staged(points(spark, d))
    top = rows.agg(F.max("arrival")).first()[0]
    cut = [-1, top // 3, 2 * top // 3, top]
    slices = [rows.where((F.col("arrival") > a) & (F.col("arrival") <= b)) for a, b in zip(cut, cut[1:])]
    got = stateful.run_in_slices(slices, stateful.late_rows)
    last = F.max_by(F.struct("out_of_order", "n_decreases"), "n_num").alias("l")
    return got.groupBy("raw_label").agg(F.max("n_num").alias("n_num"), last).select("raw_label", "n_num", "l.*")


QUERIES = {"str03_stream_late": str03, "str04_open_events": str04}
SQL = {
    "str03_stream_late": f"WITH {POINTS}, {STRAY_SQL} SELECT raw_label, count(*) AS n_num, count(*) FILTER (stray) AS out_of_order, count(*) FILTER (decrease) AS n_decreases FROM dec GROUP BY 1",
    "str04_open_events": WIN06_SQL,
}
