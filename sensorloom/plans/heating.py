"""Queries over zone grids, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import pearson
from ..operators import events as ev
from ..operators import zones as zo
from .series import PEARSON_SQL, rounded
from .views import WEATHER, ZONES, weather, zone_samples

def agg08(spark, d):
    out = zo.zone_stats(zone_samples(spark, d))
    names = [f"{s}_{m}" for s in ("t", "sp", "gain", "comfort") for m in ("mean", "std", "min", "max")] + ["pct_0", "pct_100", "pct_interior"]
    out = rounded(out, *names).withColumns({"flags": F.array_join("flags", ","), "first_ts": F.date_format("first_ts", "yyyy-MM-dd HH:mm:ss"), "last_ts": F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss")})
    tops = {f"{n}_top": F.array_join(F.transform(f"{n}_top", lambda x: F.concat_ws(":", F.floor(x["value"]).cast("string"), x["count"].cast("string"))), ",") for n in ("sp", "gain")}
    return out.withColumns(tops)


def _moments_sql(x: str, n: str) -> str:
    return f"count({x}) AS {n}_n, round(min({x}), 6) AS {n}_min, round(max({x}), 6) AS {n}_max, round(avg({x}), 6) AS {n}_mean, round(CASE WHEN count({x}) > 0 THEN coalesce(stddev_samp({x}), 0) END, 6) AS {n}_std"


def _top_sql(x: str, top: int, name: str) -> str:
    return f"""{name} AS (SELECT building, zone, max(n) AS dv, string_agg(CASE WHEN rn <= {top} THEN floor(value)::BIGINT || ':' || c END, ',' ORDER BY rn) AS top FROM (
  SELECT *, row_number() OVER (PARTITION BY building, zone ORDER BY c DESC, seen) AS rn, count(*) OVER (PARTITION BY building, zone) AS n FROM (
    SELECT building, zone, {x} AS value, count(*) AS c, min(grid_idx) AS seen FROM zs WHERE {x} IS NOT NULL GROUP BY 1, 2, 3)) GROUP BY 1, 2)"""


ZSTATS_SQL = f"""
cz AS (SELECT *, actual - setpoint AS comfort FROM zs),
{_top_sql("actual", 1, "ht")}, {_top_sql("setpoint", 64, "hs")}, {_top_sql("gain", 8, "hg")},
tc AS (SELECT building, zone, count(*) FILTER (actual <> p) AS t_changes FROM (SELECT *, lag(actual) OVER (PARTITION BY building, zone ORDER BY grid_idx) AS p FROM zs WHERE actual IS NOT NULL) GROUP BY 1, 2),
sc AS (SELECT building, zone, count(*) FILTER (setpoint <> p) AS sp_steps FROM (SELECT *, lag(setpoint) OVER (PARTITION BY building, zone ORDER BY grid_idx) AS p FROM zs WHERE setpoint IS NOT NULL) GROUP BY 1, 2),
za AS (SELECT building, zone, count(*) AS n_grid, count(*) FILTER (NOT is_empty AND NOT is_bad) AS n_data, count(*) FILTER (is_bad) AS n_bad,
  strftime(min(ts) FILTER (NOT is_empty AND NOT is_bad), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts) FILTER (NOT is_empty AND NOT is_bad), '%Y-%m-%d %H:%M:%S') AS last_ts,
  {_moments_sql("actual", "t")}, {_moments_sql("setpoint", "sp")}, {_moments_sql("gain", "gain")}, {_moments_sql("comfort", "comfort")},
  count(*) FILTER (gain = 0) AS gain_0, count(*) FILTER (gain = 100) AS gain_100, count(*) FILTER (gain > 0 AND gain < 100) AS gain_interior,
  count(*) FILTER (comfort < -1) AS cold, count(*) FILTER (comfort > 1) AS warm FROM cz GROUP BY 1, 2),
zt AS (SELECT za.*, CASE WHEN ht.dv <= 512 THEN ht.dv END AS t_distinct, CASE WHEN hs.dv <= 64 THEN hs.dv END AS sp_distinct, hs.top AS sp_top, CASE WHEN hg.dv <= 4096 THEN hg.dv END AS gain_distinct, hg.top AS gain_top,
  t_changes, sp_steps, round(gain_0 / gain_n, 6) AS pct_0, round(gain_100 / gain_n, 6) AS pct_100, round(gain_interior / gain_n, 6) AS pct_interior
  FROM za LEFT JOIN ht USING (building, zone) LEFT JOIN hs USING (building, zone) LEFT JOIN hg USING (building, zone) LEFT JOIN tc USING (building, zone) LEFT JOIN sc USING (building, zone))"""

FLAGS_SQL = "concat_ws(',', CASE WHEN n_data = 0 THEN 'empty' END, CASE WHEN gain_max = 0 THEN 'dead_gain' END, CASE WHEN t_n >= 1000 AND (t_distinct <= 3 OR t_std <= 0.05) THEN 'stuck_sensor_suspect' END, CASE WHEN sp_distinct IS NULL AND sp_n > 0 THEN 'sp_levels_capped' END) AS flags"

REGIME_SQL = """
kn AS (SELECT building, zone, sum(c) AS hits FROM (SELECT *, row_number() OVER (PARTITION BY building, zone ORDER BY c DESC, seen) AS rn FROM (SELECT building, zone, gain AS value, count(*) AS c, min(grid_idx) AS seen FROM zs WHERE gain IS NOT NULL GROUP BY 1, 2, 3))
  WHERE rn <= 8 AND len(list_filter([50.0, 33.33, 66.67, 25.0, 75.0, 20.0, 40.0, 60.0, 80.0], lambda k: abs(value - k) <= 0.05)) > 0 GROUP BY 1, 2),
rg AS (SELECT building, zone, round(gain_0 / gain_n, 6) AS pct_0, round(gain_100 / gain_n, 6) AS pct_100, round(gain_interior / gain_n, 6) AS pct_interior, round(coalesce(hits, 0) / gain_n, 6) AS pct_kn,
  CASE WHEN gain_n = 0 THEN 'no_data' WHEN gain_max <= 0 THEN 'dead' WHEN (gain_0 + gain_100 + coalesce(hits, 0)) / gain_n >= 0.98 THEN 'binary'
       WHEN gain_distinct IS NULL OR gain_distinct >= 500 OR gain_interior / gain_n >= 0.2 THEN 'modulating' ELSE 'mixed' END AS regime FROM zt LEFT JOIN kn USING (building, zone))"""


def agg13(spark, d):
    return rounded(zo.gain_regime(zo.zone_stats(zone_samples(spark, d))), "pct_0", "pct_100", "pct_interior", "pct_kn")


def agg14(spark, d):
    return zo.regime_counts(zo.gain_regime(zo.zone_stats(zone_samples(spark, d))))


def agg10(spark, d):
    return rounded(zo.hourly_proxy(zone_samples(spark, d)), "mean_gain").withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


HOURLY = "hp AS (SELECT building, zone, date_trunc('hour', ts) AS hour, avg(gain) AS mean_gain, count(*) AS n FROM zs WHERE gain IS NOT NULL GROUP BY 1, 2, 3)"


def agg11(spark, d):
    return rounded(zo.daily_duty(zo.hourly_proxy(zone_samples(spark, d))), "duty").withColumn("day", F.col("day").cast("string"))


def agg12(spark, d):
    return zo.orientation(zo.hourly_proxy(zone_samples(spark, d)))


ORIENT = """ori AS (SELECT building, zone, round(w, 2) AS winter_duty, round(s, 2) AS summer_duty, CASE WHEN w < 2 AND s < 2 THEN 'idle' WHEN s > 1.25 * w AND s >= 2 THEN 'cooling' WHEN w > 1.25 * s THEN 'heating' ELSE 'dual' END AS orientation FROM (
  SELECT building, zone, coalesce(sum(mean_gain * n) FILTER (month(hour) IN (12, 1, 2)) / sum(n) FILTER (month(hour) IN (12, 1, 2)), 0) AS w, coalesce(sum(mean_gain * n) FILTER (month(hour) IN (6, 7, 8)) / sum(n) FILTER (month(hour) IN (6, 7, 8)), 0) AS s
  FROM hp GROUP BY 1, 2 HAVING count(*) FILTER (month(hour) IN (12, 1, 2, 6, 7, 8)) > 0))"""

#: Dates of the set-point step query.
STEP_DATES = ("2024-01-02", "2024-01-20")


def agg21(spark, d):
    return zo.step_modes(zo.setpoint_steps(zone_samples(spark, d), *STEP_DATES))


def agg23(spark, d):
    return rounded(zo.signal_summary(zone_samples(spark, d), "actual"), "mean", "min", "max", "first", "last")


def agg24(spark, d):
    return zo.tracking_error(zone_samples(spark, d))


def agg25(spark, d):
    return zo.control_behaviour(zone_samples(spark, d))


def jon20(spark, d):
    s = ev.last_known(ev.last_known(zone_samples(spark, d), "setpoint", "last_setpoint"), "actual", "last_actual")
    return rounded(s.select("building", "zone", "grid_idx", "last_setpoint", "last_actual"), "last_actual")


def win06(spark, d):
    out = rounded(ev.decay_events(zone_samples(spark, d)), "t0", "slope_first_hour", "drop_at_2h")
    return out.withColumn("ts0", F.date_format("ts0", "yyyy-MM-dd HH:mm:ss"))


DECAY_SQL = """
dr AS (SELECT *, last_value(setpoint IGNORE NULLS) OVER w AS lsp, last_value(actual IGNORE NULLS) OVER w AS lt FROM zs WHERE NOT is_empty AND NOT is_bad WINDOW w AS (PARTITION BY building, zone ORDER BY grid_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT building, zone, grid_idx AS i0, ts AS ts0, lsp AS sp_from, setpoint AS sp_to, coalesce(actual, lt) AS t0 FROM dr WHERE lsp - setpoint >= 1),
j AS (SELECT c.*, r.grid_idx - i0 AS off, r.actual, r.setpoint, r.gain, r.grid_idx - i0 > 480 AS over FROM c JOIN dr r ON r.building = c.building AND r.zone = c.zone AND r.grid_idx > i0
      AND r.grid_idx <= coalesce((SELECT min(x.grid_idx) FROM dr x WHERE x.building = c.building AND x.zone = c.zone AND x.grid_idx > c.i0 + 480), c.i0 + 480)),
two AS (SELECT building, zone, i0, min(off) AS two FROM (SELECT *, lag(gain) OVER (PARTITION BY building, zone, i0 ORDER BY off) AS g FROM j WHERE gain IS NOT NULL) WHERE gain >= 20 AND g >= 20 GROUP BY 1, 2, 3),
e AS (SELECT j.building, j.zone, j.i0, least(coalesce(min(off) FILTER (over OR setpoint > sp_to + 0.1), 1::BIGINT << 40), coalesce(any_value(two), 1::BIGINT << 40)) AS close, any_value(two) AS two FROM j LEFT JOIN two USING (building, zone, i0) GROUP BY 1, 2, 3),
sp AS (SELECT c.building, c.zone, c.i0, c.i0 + coalesce(close, 1::BIGINT << 40) AS stop FROM c LEFT JOIN e USING (building, zone, i0)),
rk AS (SELECT *, row_number() OVER (PARTITION BY building, zone ORDER BY i0) AS rn FROM sp),
kp AS (SELECT building, zone, i0 FROM walk WHERE keep),
qs AS (SELECT j.*, e.close, coalesce(e.two = e.close, false) AS reheat, CASE WHEN off < e.close AND NOT over AND actual IS NOT NULL THEN off END AS s, CASE WHEN off <= 15 AND off <= e.close THEN gain END AS early
       FROM j JOIN kp USING (building, zone, i0) JOIN e USING (building, zone, i0)),
ql AS (SELECT *, max(s) OVER (PARTITION BY building, zone, i0) AS last FROM qs),
qp AS (SELECT *, avg(actual) FILTER (s >= last - 30) OVER (PARTITION BY building, zone, i0) AS plateau FROM ql),
de AS (SELECT building, zone, i0, ts0, sp_from, sp_to, t0, reheat, min(s) FILTER (actual <= t0 - 1) AS minutes_to_1k, CASE WHEN count(*) FILTER (s <= 60) >= 5 THEN regr_slope(actual, s) FILTER (s <= 60) * 60 END AS slope_first_hour,
  max_by(t0 - actual, s) FILTER (s BETWEEN 105 AND 135) AS drop_at_2h, min(s) FILTER (last >= 240 AND t0 - plateau >= 1.5 AND actual <= t0 - 0.632 * (t0 - plateau)) AS t63_minutes, max(s) AS window_min
  FROM qp GROUP BY ALL HAVING t0 IS NOT NULL AND count(s) >= 5 AND coalesce(avg(early), 0) <= 5)"""
#: The greedy choice in SQL walks each zone's candidates.
WALK = """walk AS (SELECT building, zone, i0, rn, true AS keep, stop AS upto FROM rk WHERE rn = 1
  UNION ALL SELECT r.building, r.zone, r.i0, r.rn, r.i0 >= w.upto, CASE WHEN r.i0 >= w.upto THEN r.stop ELSE w.upto END FROM walk w JOIN rk r ON r.building = w.building AND r.zone = w.zone AND r.rn = w.rn + 1)"""
DECAY_SQL = DECAY_SQL.replace("kp AS", WALK + ",\nkp AS")
SEASON_SQL = "(year(ts0) - CASE WHEN month(ts0) < 8 THEN 1 ELSE 0 END)"
SEASON_SQL = f"{SEASON_SQL} || '-' || lpad((({SEASON_SQL} + 1) % 100)::VARCHAR, 2, '0')"
WIN06_SQL = f"WITH RECURSIVE {ZONES}, {DECAY_SQL} SELECT building, zone, i0, strftime(ts0, '%Y-%m-%d %H:%M:%S') AS ts0, sp_from, sp_to, round(t0, 6) AS t0, reheat, minutes_to_1k, round(slope_first_hour, 6) AS slope_first_hour, round(drop_at_2h, 6) AS drop_at_2h, t63_minutes, window_min, {SEASON_SQL} AS season FROM de"


def agg16(spark, d):
    out = ev.step_summary(ev.decay_events(zone_samples(spark, d)), weather(spark, d))
    return rounded(out, "median_1k", "iqr_1k", "no_drop_share", "median_slope", "median_t63")


def _quantile_sql(v: str, k: int) -> str:
    at = f"least(greatest(floor({k} * (len({v}) + 1) / 4)::INT, 1), len({v}) - 1)"
    return f"(({v})[{at}] * (4 - ({k} * (len({v}) + 1) - {at} * 4)) + ({v})[{at} + 1] * ({k} * (len({v}) + 1) - {at} * 4)) / 4.0"


def _median_sql(v: str) -> str:
    return f"CASE WHEN len({v}) = 0 THEN NULL WHEN len({v}) >= 4 THEN {_quantile_sql(v, 2)} ELSE list_median({v}) END".replace("list_median", "list_aggregate").replace(f"list_aggregate({v})", f"list_aggregate({v}, 'median')")


SUMMARY_SQL = f"""
bn AS (SELECT de.*, {SEASON_SQL} AS season, CASE WHEN temp IS NULL THEN NULL WHEN temp < -5 THEN '<-5' WHEN temp < 0 THEN '<0' WHEN temp < 5 THEN '<5' WHEN temp < 10 THEN '<10' ELSE '>=10' END AS bin FROM de LEFT JOIN wx ON wx.day = de.ts0::DATE),
gs AS (SELECT building, zone, 'all' AS grouping, 'all' AS key, * EXCLUDE (building, zone) FROM bn UNION ALL SELECT building, zone, 'season', season, * EXCLUDE (building, zone) FROM bn WHERE minutes_to_1k IS NOT NULL
       UNION ALL SELECT building, zone, 'outdoor', bin, * EXCLUDE (building, zone) FROM bn WHERE minutes_to_1k IS NOT NULL AND bin IS NOT NULL),
gl AS (SELECT building, zone, grouping, key, count(*) AS n_events, coalesce(list(minutes_to_1k::DOUBLE ORDER BY minutes_to_1k) FILTER (minutes_to_1k IS NOT NULL), []) AS m, coalesce(list(slope_first_hour ORDER BY slope_first_hour) FILTER (slope_first_hour IS NOT NULL), []) AS sl,
  coalesce(list(t63_minutes::DOUBLE ORDER BY t63_minutes) FILTER (t63_minutes IS NOT NULL), []) AS t6, count(*) FILTER (minutes_to_1k IS NULL AND window_min >= 120 AND NOT reheat) AS nd FROM gs GROUP BY 1, 2, 3, 4),
ss AS (SELECT building, zone, grouping, key, n_events, CASE WHEN len(m) > 0 THEN len(m) END AS n_1k, {_median_sql("m")} AS median_1k, CASE WHEN len(m) >= 4 THEN {_quantile_sql("m", 3)} - {_quantile_sql("m", 1)} END AS iqr_1k,
  CASE WHEN grouping = 'all' AND nd + len(m) > 0 THEN nd / (nd + len(m)) END AS no_drop_share, {_median_sql("sl")} AS median_slope, {_median_sql("t6")} AS median_t63 FROM gl)"""
AGG16_SQL = f"WITH RECURSIVE {ZONES}, {WEATHER}, {DECAY_SQL}, {SUMMARY_SQL} SELECT building, zone, grouping, key, n_events, n_1k, round(median_1k, 6) AS median_1k, round(iqr_1k, 6) AS iqr_1k, round(no_drop_share, 6) AS no_drop_share, round(median_slope, 6) AS median_slope, round(median_t63, 6) AS median_t63 FROM ss"


def win07(spark, d):
    return rounded(ev.rise_events(zone_samples(spark, d)), "rise_k", "gain_k_per_duty", "slope_first_30")


RISE_SQL = """
rr AS (SELECT building, zone, grid_idx, actual, gain, lead(gain) OVER w AS nxt, last_value(CASE WHEN actual IS NOT NULL THEN {'i': grid_idx, 't': actual} END IGNORE NULLS) OVER (PARTITION BY building, zone ORDER BY grid_idx ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS near, min(grid_idx) OVER (PARTITION BY building, zone) AS fst
       FROM zs WINDOW w AS (PARTITION BY building, zone ORDER BY grid_idx)),
rc AS (SELECT building, zone, grid_idx AS i0, CASE WHEN grid_idx - fst < 15 AND near.i = fst THEN NULL ELSE near.t END AS t_start FROM rr WHERE gain <= 5 AND nxt >= 50),
rj AS (SELECT rc.*, rr.grid_idx - i0 AS off, rr.actual, rr.gain FROM rc JOIN rr ON rr.building = rc.building AND rr.zone = rc.zone AND rr.grid_idx > i0 AND rr.grid_idx <= i0 + 360),
rl AS (SELECT building, zone, i0, min(off) AS stop FROM (SELECT *, lag(gain) OVER (PARTITION BY building, zone, i0 ORDER BY off) AS g FROM rj WHERE gain IS NOT NULL) WHERE gain < 20 AND g < 20 GROUP BY 1, 2, 3),
re AS (SELECT rc.building, rc.zone, rc.i0, coalesce(stop, 361) AS close FROM rc LEFT JOIN rl USING (building, zone, i0)),
rk AS (SELECT building, zone, i0, i0 + close AS stop, row_number() OVER (PARTITION BY building, zone ORDER BY i0) AS rn FROM re),
""" + WALK + """,
rq AS (SELECT rj.*, close, CASE WHEN off < close AND actual IS NOT NULL THEN off END AS s FROM rj JOIN (SELECT building, zone, i0 FROM walk WHERE keep) k USING (building, zone, i0) JOIN re USING (building, zone, i0) WHERE off <= close),
rw AS (SELECT *, max(s) OVER (PARTITION BY building, zone, i0) AS last FROM rq),
rp AS (SELECT *, avg(actual) FILTER (s >= last - 30) OVER (PARTITION BY building, zone, i0) AS plateau FROM rw),
ro AS (SELECT building, zone, i0, t_start, last, plateau, count(s) AS n, plateau - t_start AS rise_k, min(s) FILTER (actual >= t_start + 0.632 * (plateau - t_start)) AS tau63_min, avg(gain) AS u,
  CASE WHEN count(*) FILTER (s <= 30) >= 5 THEN (max_by(actual, s) FILTER (s <= 30) - min_by(actual, s) FILTER (s <= 30)) / greatest(max(s) FILTER (s <= 30) - min(s) FILTER (s <= 30), 1) * 60 END AS slope FROM rp GROUP BY 1, 2, 3, 4, 5, 6)
"""
WIN07_SQL = f"WITH RECURSIVE {ZONES}, {RISE_SQL} SELECT building, zone, i0, round(rise_k, 6) AS rise_k, tau63_min, round(CASE WHEN u <> 0 THEN rise_k / (u / 100) END, 6) AS gain_k_per_duty, round(slope, 6) AS slope_first_30 FROM ro WHERE t_start IS NOT NULL AND n >= 30 AND last >= 60 AND rise_k >= 0.5"


def agg34(spark, d):
    return rounded(ev.rise_summary(ev.rise_events(zone_samples(spark, d))), "rise_k", "tau63_min", "gain_k_per_duty", "slope_first_30")


AGG34_SQL = f"WITH RECURSIVE {ZONES}, {RISE_SQL} SELECT building, zone, count(*) AS n, round(median(rise_k), 6) AS rise_k, round(median(tau63_min), 6) AS tau63_min, round(median(CASE WHEN u <> 0 THEN rise_k / (u / 100) END), 6) AS gain_k_per_duty, round(median(slope), 6) AS slope_first_30 FROM ro WHERE t_start IS NOT NULL AND n >= 30 AND last >= 60 AND rise_k >= 0.5 GROUP BY 1, 2"


def types(spark, d):
    s = zone_samples(spark, d)
    summary = ev.step_summary(ev.decay_events(s), weather(spark, d)).where("grouping = 'all'").select("building", "zone", "n_events", "median_1k", "no_drop_share")
    prior = F.when(F.col("building") == "B0", "electric").when(F.col("building") == "B1", "hydronic")
    return ev.heating_type(zo.gain_regime(zo.zone_stats(s)).select("building", "zone", "regime").join(summary, ["building", "zone"], "left").withColumn("prior", prior))


def chk13(spark, d):
    return rounded(types(spark, d), "median_1k", "no_drop_share")


TYPES_SQL = """
ty AS (SELECT building, zone, regime, n_events, median_1k, no_drop_share, CASE WHEN regime IN ('dead', 'no_data') THEN {'v': 'excluded', 'c': 1.0} WHEN coalesce(n_events, 0) < 10 OR (median_1k IS NULL AND coalesce(no_drop_share, 0) = 0) THEN {'v': 'ambiguous', 'c': 0.3}
  WHEN median_1k <= 90 AND regime = 'binary' THEN {'v': 'electric-fast', 'c': CASE building WHEN 'B0' THEN 0.9 WHEN 'B1' THEN 0.55 ELSE 0.8 END} WHEN coalesce(no_drop_share, 0) >= 0.5 OR median_1k >= 480 THEN {'v': 'floor-slow', 'c': CASE WHEN building = 'B1' THEN 0.6 ELSE 0.5 END}
  WHEN median_1k >= 240 THEN {'v': 'hydronic-slow', 'c': CASE WHEN building = 'B1' THEN 0.75 ELSE 0.55 END} ELSE {'v': 'ambiguous', 'c': 0.4} END AS x
  FROM rg LEFT JOIN (SELECT * FROM ss WHERE grouping = 'all') q USING (building, zone))"""
BASE = f"WITH RECURSIVE {ZONES}, {WEATHER}, {DECAY_SQL}, {SUMMARY_SQL}, {ZSTATS_SQL}, {REGIME_SQL}, {TYPES_SQL}"
CHK13_SQL = BASE + " SELECT building, zone, regime, n_events, round(median_1k, 6) AS median_1k, round(no_drop_share, 6) AS no_drop_share, x.v AS verdict, x.c::DOUBLE AS confidence FROM ty"


def srt02(spark, d):
    return rounded(ev.flexibility(types(spark, d), zo.orientation(zo.hourly_proxy(zone_samples(spark, d)))), "median_1k")


SRT02_SQL = BASE + f""", {HOURLY}, {ORIENT} SELECT row_number() OVER (ORDER BY CASE x.v WHEN 'electric-fast' THEN 0 WHEN 'hydronic-slow' THEN 1 WHEN 'floor-slow' THEN 2 WHEN 'ambiguous' THEN 3 ELSE 4 END, coalesce(median_1k, 9999), zone, building)::INT AS rank,
  building, zone, x.v AS verdict, round(median_1k, 6) AS median_1k, coalesce(orientation, 'unknown') AS orientation, round(100 - winter_duty, 1) AS headroom FROM ty LEFT JOIN ori USING (building, zone)"""


def agg17(spark, d):
    """Building medians of zone medians, and whether the electric buildings cool faster."""
    z = types(spark, d).where("median_1k is not null").withColumn("kind", F.when(F.col("building") == "B0", "electric").when(F.col("building") == "B1", "hydronic").otherwise("other"))
    med = lambda c: F.percentile(c, F.lit(0.5))
    e, h = F.when(F.col("kind") == "electric", F.col("median_1k")), F.when(F.col("kind") == "hydronic", F.col("median_1k"))
    out = z.agg(med(e).alias("electric"), med(h).alias("hydronic"), F.count(e).alias("n_electric"), F.count(h).alias("n_hydronic"))
    return rounded(out.withColumn("verdict", F.when(F.col("electric") < F.col("hydronic"), "CONFIRMED").otherwise("REJECTED")), "electric", "hydronic")


AGG17_SQL = BASE + " SELECT round(e, 6) AS electric, round(h, 6) AS hydronic, n_electric, n_hydronic, CASE WHEN e < h THEN 'CONFIRMED' ELSE 'REJECTED' END AS verdict FROM (SELECT median(median_1k) FILTER (building = 'B0') AS e, median(median_1k) FILTER (building = 'B1') AS h, count(median_1k) FILTER (building = 'B0') AS n_electric, count(median_1k) FILTER (building = 'B1') AS n_hydronic FROM ty WHERE median_1k IS NOT NULL)"


def agg18(spark, d):
    """Share of live zones with the regime expected of the building, and a warning below half."""
    r = zo.gain_regime(zo.zone_stats(zone_samples(spark, d))).where("regime not in ('dead', 'no_data')")
    want = F.when(F.col("building") == "B0", "binary").otherwise("modulating")
    out = r.groupBy("building").agg(F.count("*").alias("live"), F.round(F.avg((F.col("regime") == want).cast("int")), 6).alias("share"))
    return out.withColumn("warning", F.col("share") < 0.5)


def agg20(spark, d):
    """Daily duty of heating zones against outdoor temperature in the heating season, per building."""
    hourly = zo.hourly_proxy(zone_samples(spark, d))
    heating = zo.orientation(hourly).where("orientation = 'heating'").select("building", "zone")
    duty = zo.daily_duty(hourly.join(heating, ["building", "zone"], "left_semi"))
    days = duty.join(weather(spark, d), "day").where(F.month("day").isin(*zo.RULES["season_months"]) & (F.col("temp") < zo.RULES["season_max_outdoor"]))
    out = days.groupBy("building").agg(F.count("*").alias("n"), F.round(pearson("duty", "temp"), 6).alias("r"))
    return out.withColumn("verdict", F.when(F.col("n") < 30, "INCONCLUSIVE").when(F.col("r") < 0, "PASS").otherwise("CONFLICT"))


AGG20_SQL = f"""WITH {ZONES}, {WEATHER}, {HOURLY}, {ORIENT}, dd AS (SELECT building, hour::DATE AS day, sum(mean_gain * n) / sum(n) AS duty FROM hp JOIN (SELECT building, zone FROM ori WHERE orientation = 'heating') USING (building, zone) GROUP BY 1, 2)
SELECT building, n, round(r, 6) AS r, CASE WHEN n < 30 THEN 'INCONCLUSIVE' WHEN r < 0 THEN 'PASS' ELSE 'CONFLICT' END AS verdict FROM (SELECT building, count(*) AS n, {PEARSON_SQL.format(x="duty", y="temp")} AS r FROM dd JOIN wx USING (day) WHERE month(day) IN (10, 11, 12, 1, 2, 3, 4) AND temp < 12 GROUP BY 1)"""

QUERIES = {
    "agg08_zone_stats": agg08,
    "agg10_hourly_proxy": agg10,
    "agg11_daily_duty": agg11,
    "agg12_orientation": agg12,
    "agg13_gain_regime": agg13,
    "agg14_regime_counts": agg14,
    "agg16_step_summary": agg16,
    "agg17_group_medians": agg17,
    "agg18_regime_priors": agg18,
    "agg20_duty_physics": agg20,
    "agg21_setpoint_modes": agg21,
    "agg23_signal_summary": agg23,
    "agg24_tracking_error": agg24,
    "agg25_control_behaviour": agg25,
    "agg34_rise_summary": agg34,
    "jon20_last_known": jon20,
    "win06_decay_events": win06,
    "win07_rise_events": win07,
    "chk13_heating_type": chk13,
    "srt02_flexibility": srt02,
}
Z = f"WITH {ZONES}"
SQL = {
    "agg08_zone_stats": f"{Z}, {ZSTATS_SQL} SELECT *, {FLAGS_SQL} FROM zt",
    "agg10_hourly_proxy": f"{Z}, {HOURLY} SELECT building, zone, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, round(mean_gain, 6) AS mean_gain, n FROM hp",
    "agg11_daily_duty": f"{Z}, {HOURLY} SELECT building, hour::DATE::VARCHAR AS day, round(sum(mean_gain * n) / sum(n), 6) AS duty, sum(n)::BIGINT AS n FROM hp GROUP BY 1, 2",
    "agg12_orientation": f"{Z}, {HOURLY}, {ORIENT} SELECT * FROM ori",
    "agg13_gain_regime": f"{Z}, {ZSTATS_SQL}, {REGIME_SQL} SELECT * FROM rg",
    "agg14_regime_counts": f"{Z}, {ZSTATS_SQL}, {REGIME_SQL} SELECT building, count(*) FILTER (regime = 'no_data') AS no_data, count(*) FILTER (regime = 'dead') AS dead, count(*) FILTER (regime = 'binary') AS binary, count(*) FILTER (regime = 'modulating') AS modulating, count(*) FILTER (regime = 'mixed') AS mixed, count(*) AS zones FROM rg GROUP BY 1",
    "agg16_step_summary": AGG16_SQL,
    "agg17_group_medians": AGG17_SQL,
    "agg18_regime_priors": f"{Z}, {ZSTATS_SQL}, {REGIME_SQL} SELECT building, count(*) AS live, round(avg((regime = CASE WHEN building = 'B0' THEN 'binary' ELSE 'modulating' END)::INT), 6) AS share, avg((regime = CASE WHEN building = 'B0' THEN 'binary' ELSE 'modulating' END)::INT) < 0.5 AS warning FROM rg WHERE regime NOT IN ('dead', 'no_data') GROUP BY 1",
    "agg20_duty_physics": AGG20_SQL,
    "agg21_setpoint_modes": f"{Z}, st AS (SELECT building, zone, grid_idx, (hour(ts) * 60 + minute(ts))::INT AS minute FROM (SELECT *, lag(setpoint) OVER (PARTITION BY building, zone ORDER BY grid_idx) AS p FROM zs WHERE setpoint IS NOT NULL AND ts::DATE BETWEEN DATE '{STEP_DATES[0]}' AND DATE '{STEP_DATES[1]}') WHERE setpoint > p), ct AS (SELECT building, minute, count(*) AS n, min({{'zone': zone, 'i': grid_idx}}) AS seen FROM st GROUP BY 1, 2) SELECT building, minute, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY building ORDER BY n DESC, seen)::INT AS rank FROM ct) WHERE rank <= 3",
    "agg23_signal_summary": f"{Z} SELECT building, zone, count(*) AS n, round(avg(actual), 6) AS mean, round(min(actual), 6) AS min, round(max(actual), 6) AS max, round(min_by(actual, grid_idx), 6) AS first, round(max_by(actual, grid_idx), 6) AS last FROM zs WHERE actual IS NOT NULL GROUP BY 1, 2",
    "agg24_tracking_error": f"{Z}, r AS (SELECT *, row_number() OVER (PARTITION BY building, zone ORDER BY setpoint, grid_idx) - 1 AS rn, count(*) OVER (PARTITION BY building, zone) AS n FROM zs WHERE actual IS NOT NULL AND setpoint IS NOT NULL AND month(ts) IN (10, 11, 12, 1, 2, 3)), c AS (SELECT building, zone, (max(setpoint) FILTER (rn = n // 10) + max(setpoint) FILTER (rn = 9 * n // 10)) / 2 AS mid FROM r GROUP BY 1, 2), p AS (SELECT r.*, unnest(['all', CASE WHEN setpoint >= mid THEN 'comfort' ELSE 'setback' END]) AS part FROM r JOIN c USING (building, zone)) SELECT building, zone, part, count(*) AS n, round(avg(abs(actual - setpoint)), 2) AS mean_abs, round(max(abs(actual - setpoint)), 2) AS max_abs, round(avg(actual - setpoint), 2) AS bias, round(100 * avg((abs(actual - setpoint) <= 1)::INT), 1) AS within_1k FROM p GROUP BY 1, 2, 3",
    "agg25_control_behaviour": f"{Z}, g AS (SELECT *, abs(gain - lag(gain) OVER (PARTITION BY building, zone ORDER BY grid_idx)) AS dl FROM zs WHERE gain IS NOT NULL), t AS (SELECT building, zone, count(*) FILTER (s <> p) AS turns FROM (SELECT *, gain > 90 AS s, lag(gain > 90) OVER (PARTITION BY building, zone ORDER BY grid_idx) AS p FROM zs WHERE gain < 10 OR gain > 90) GROUP BY 1, 2), n AS (SELECT building, zone, count(*) AS grid FROM zs GROUP BY 1, 2) SELECT building, zone, count(*) AS n, round(100 * avg((gain <= 0.5)::INT), 1) AS pct_off, round(100 * avg((gain >= 99.5)::INT), 1) AS pct_full, round(100 * avg((gain > 0.5 AND gain < 99.5)::INT), 1) AS pct_between, count(DISTINCT round(gain, 1)) AS levels, round(coalesce(any_value(turns), 0) / (any_value(grid) / 1440), 2) AS turns_per_day, round(avg(dl) FILTER (dl > 0), 2) AS mean_step FROM g LEFT JOIN t USING (building, zone) JOIN n USING (building, zone) GROUP BY 1, 2",
    "agg34_rise_summary": AGG34_SQL,
    "jon20_last_known": f"{Z} SELECT building, zone, grid_idx, last_value(setpoint IGNORE NULLS) OVER w AS last_setpoint, round(last_value(actual IGNORE NULLS) OVER w, 6) AS last_actual FROM zs WINDOW w AS (PARTITION BY building, zone ORDER BY grid_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
    "win06_decay_events": WIN06_SQL,
    "win07_rise_events": WIN07_SQL,
    "chk13_heating_type": CHK13_SQL,
    "srt02_flexibility": SRT02_SQL,
}
