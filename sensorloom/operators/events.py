"""Mining of set-back decays and heater rises from zone grids, without per-row Python.

A zone's candidates are joined to the rows of their window by zone and row bucket, so the work grows with
candidates times window, never with the square of a zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import staged
from . import order
from .series import running, running_all
from .zones import CHUNK, KEY, RULES

EVENT = [*KEY, "i0"]


def last_known(samples: DataFrame, column: str, out: str) -> DataFrame:
    """``out``: the last non-null value of ``column`` before each row of a zone."""
    return running(samples, KEY, F.col(column), F.floor(F.col("grid_idx") / CHUNK), "grid_idx", "last", out)


def window_rows(starts: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """``starts(KEY, i0, ...)`` with the ``rows`` of the zone at 0 < off <= ``width``: an equi-join on buckets as wide as the window."""
    s = starts.withColumn("_b", F.explode(F.array(F.floor(F.col("i0") / width), F.floor(F.col("i0") / width) + 1)))
    r = rows.withColumn("_b", F.floor(F.col("grid_idx") / width))
    joined = s.join(r, [*KEY, "_b"]).drop("_b")
    return joined.withColumn("off", F.col("grid_idx") - F.col("i0")).where((F.col("off") > 0) & (F.col("off") <= width))


def first_after(starts: DataFrame, rows: DataFrame, at) -> DataFrame:
    """The first of ``rows`` beyond ``at`` of each start, by one descending pass over rows and marks together, chunk by chunk."""
    values = [c for c in rows.columns if c not in KEY]
    marks = starts.select(*KEY, at.cast("double").alias("_at"), "i0", F.lit(None).cast(rows.select(F.struct(*values)).schema[0].dataType).alias("_row"))
    both = marks.unionByName(rows.select(*KEY, F.col("grid_idx").cast("double").alias("_at"), F.lit(None).cast("bigint").alias("i0"), F.struct(*values).alias("_row")))
    both = both.withColumn("_back", -F.col("_at"))
    found = running(both, KEY, F.col("_row"), F.floor(F.col("_back") / CHUNK), "_back", "last", "_next").where("i0 is not null and _next is not null")
    return starts.join(found.select(*KEY, "i0", "_next.*"), EVENT).withColumn("off", F.col("grid_idx") - F.col("i0"))


def greedy(spans: DataFrame) -> DataFrame:
    """Of ``spans(KEY, i0, close)``: those that a scan in order opens, each once the one before is closed (its closing row included).

    A span that none before it reaches opens surely. Any other opens if the one opened before it has it as its successor, the
    first span at or past its close. Successors are found chunk by chunk, then doubled: after k rounds a link spans 2^k
    openings, so chains of any length are followed in as many rounds as their length has bits, over all tasks.
    """
    chunk = F.floor(F.col("i0") / CHUNK)
    reach = running(spans, KEY, F.col("close"), chunk, "i0", "max", "_reach")
    known = staged(reach.select(*KEY, "i0", "close", F.coalesce(F.col("i0") >= F.col("_reach"), F.lit(True)).alias("sure")))
    after = first_after(known.where(F.col("close") < FAR).select(*KEY, "i0", "close"), known.select(*KEY, F.col("i0").alias("grid_idx"), "sure"), F.col("close") - 0.5)
    links = [staged(after.where("not sure").select(*KEY, "i0", F.col("grid_idx").alias("to")))]
    kept = known.where("sure").select(*EVENT)
    while not links[-1].isEmpty():
        links.append(staged(followed(links[-1], "to", links[-1])))
    for link in reversed(links[:-1]):
        kept = staged(kept.unionByName(followed(kept, "i0", link).select(*KEY, F.col("to").alias("i0"))))
    return kept


def followed(rows: DataFrame, at: str, links: DataFrame) -> DataFrame:
    """``(KEY, i0, to)``: where the link that starts at column ``at`` of ``rows`` leads."""
    link = links.select(*KEY, F.col("i0").alias("_from"), F.col("to").alias("_to"))
    return rows.withColumn("_from", F.col(at)).join(link, [*KEY, "_from"]).select(*KEY, "i0", F.col("_to").alias("to"))


FAR = 1 << 40


def decay_events(samples: DataFrame) -> DataFrame:
    """Set-back events of every zone: the set point falls by a degree or more and the temperature decays freely."""
    r = RULES
    rows = samples.where(~F.col("is_empty") & ~F.col("is_bad")).select(*KEY, "grid_idx", "ts", "actual", "setpoint", "gain")
    seen = running_all(rows, KEY, {"_sp": (F.col("setpoint"), "last"), "_t": (F.col("actual"), "last")}, F.floor(F.col("grid_idx") / CHUNK), "grid_idx")
    # starts and what they are joined to are used several times: each is worked out once
    starts = seen.where(F.col("_sp") - F.col("setpoint") >= r["min_sp_drop"]).select(*KEY, F.col("grid_idx").alias("i0"), F.col("ts").alias("ts0"), F.col("_sp").alias("sp_from"), F.col("setpoint").alias("sp_to"), F.coalesce("actual", "_t").alias("t0"))
    starts, data = staged(starts), rows.select(*KEY, "grid_idx", "actual", "setpoint", "gain")
    width = r["max_window"]
    near = window_rows(starts, data, width).withColumn("over", F.lit(False))
    far = first_after(starts, data, F.col("i0") + width + 0.5).withColumn("over", F.lit(True))
    both = staged(near.unionByName(far.select(*near.columns)))
    on = both.where("gain is not null").withColumn("_g", F.lag("gain").over(Window.partitionBy(*EVENT).orderBy("off")))
    on = on.where((F.col("gain") >= r["gain_on"]) & (F.col("_g") >= r["gain_on"])).groupBy(*EVENT).agg(F.min("off").alias("two"))
    ends = both.groupBy(*EVENT).agg(F.min(F.when(F.col("over") | (F.col("setpoint") > F.col("sp_to") + 0.1), F.col("off"))).alias("end"))
    ends = ends.join(on, EVENT, "left").withColumn("close", F.least(F.coalesce("end", F.lit(FAR)), F.coalesce("two", F.lit(FAR)))).withColumn("reheat", F.coalesce(F.col("two") == F.col("close"), F.lit(False)))
    ends = staged(ends)
    # a start without any row after it closes never and qualifies never, but it still bars others
    spans = starts.select(*EVENT).join(ends.select(*EVENT, "close"), EVENT, "left").select(*KEY, "i0", (F.col("i0") + F.coalesce("close", F.lit(FAR))).alias("close"))
    kept = both.join(greedy(staged(spans)), EVENT, "left_semi").join(ends.select(*EVENT, "close", "reheat"), EVENT)
    sample = (F.col("off") < F.col("close")) & ~F.col("over") & F.col("actual").isNotNull()
    kept = kept.withColumn("s", F.when(sample, F.col("off"))).withColumn("e", F.when((F.col("off") <= 15) & (F.col("off") <= F.col("close")), F.col("gain")))
    event = Window.partitionBy(*EVENT)
    kept = kept.withColumn("last", F.max("s").over(event))
    kept = kept.withColumn("plateau", F.avg(F.when(F.col("s") >= F.col("last") - 30, F.col("actual"))).over(event))
    t, s, t0 = F.col("actual"), F.col("s"), F.col("t0")
    total = t0 - F.col("plateau")
    settled = (F.col("last") >= r["min_window_t63"]) & (total >= r["plateau_min_drop"])
    out = kept.groupBy(*EVENT, "ts0", "sp_from", "sp_to", "t0", "reheat").agg(
        F.count("s").alias("n"),
        F.avg("e").alias("early"),
        F.min(F.when(t <= t0 - 1, s)).alias("minutes_to_1k"),
        F.when(F.count(F.when(s <= 60, 1)) >= 5, F.regr_slope(F.when(s <= 60, t), s) * 60).alias("slope_first_hour"),
        F.max_by(F.when(s.between(105, 135), t0 - t), F.when(s.between(105, 135), s)).alias("drop_at_2h"),
        F.min(F.when(settled & (t <= t0 - 0.632 * total), s)).alias("t63_minutes"),
        F.max("s").alias("window_min"),
    )
    return out.where((F.col("t0").isNotNull()) & (F.col("n") >= 5) & (F.coalesce("early", F.lit(0.0)) <= r["gain_off"])).withColumn("season", season("ts0")).drop("n", "early")


def season(ts: str):
    """Heating season of a timestamp, August to July: ``2022-23``."""
    y = F.year(F.add_months(F.to_date(ts), -7))
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def outdoor_bin(t, edges=RULES["outdoor_bins"]):
    """The first edge above the temperature, as ``<edge``, or ``>=last``; null for an unknown temperature."""
    out = F.when(t.isNull(), None)
    for e in edges:
        out = out.when(t < e, f"<{e}")
    return out.otherwise(f">={edges[-1]}")


def step_summary(events: DataFrame, weather: DataFrame) -> DataFrame:
    """Per zone, pooled and by season and by outdoor bin: events, time to one degree, and the share that never dropped one."""
    binned = events.join(weather, F.to_date("ts0") == F.col("day"), "left").withColumn("outdoor_bin", outdoor_bin(F.col("temp")))
    m = F.col("minutes_to_1k")
    stuck = m.isNull() & (F.col("window_min") >= 120) & ~F.col("reheat")
    sets = binned.select(*KEY, "season", "outdoor_bin", m.cast("double").alias("m"), F.col("slope_first_hour"), F.col("t63_minutes").cast("double").alias("t63"), stuck.alias("stuck"))
    pooled = F.array(F.struct(F.lit("all").alias("grouping"), F.lit("all").alias("key")), F.struct(F.lit("season").alias("grouping"), F.col("season").alias("key")), F.struct(F.lit("outdoor").alias("grouping"), F.col("outdoor_bin").alias("key")))
    rows = sets.withColumn("_g", F.explode(pooled)).select(*KEY, "_g.*", "m", "slope_first_hour", "t63", "stuck").where("key is not null and (grouping = 'all' or m is not null)")
    rows = staged(rows)
    group = [*KEY, "grouping", "key"]
    measure = lambda name: F.struct(F.lit(name).alias("measure"), F.col(name).alias("value"))
    values = rows.select(*group, F.explode(F.array(measure("m"), measure("slope_first_hour"), measure("t63"))).alias("v")).select(*group, "v.*")
    cuts = order.quartiles(values, [*group, "measure"], "value")
    of = lambda name, column: F.max(F.when(F.col("measure") == name, F.col(column)))
    cuts = cuts.groupBy(*group).agg(of("m", "n").alias("n_1k"), of("m", "median").alias("median_1k"), of("m", "iqr").alias("iqr_1k"), of("slope_first_hour", "median").alias("median_slope"), of("t63", "median").alias("median_t63"))
    counts = rows.groupBy(*group).agg(F.count("*").alias("n_events"), F.count_if("stuck").alias("no_drop"), F.count("m").alias("dropped")).join(cuts, group, "left")
    share = F.when((F.col("grouping") == "all") & (F.col("no_drop") + F.col("dropped") > 0), F.col("no_drop") / (F.col("no_drop") + F.col("dropped")))
    return counts.select(*group, "n_events", "n_1k", "median_1k", "iqr_1k", share.alias("no_drop_share"), "median_slope", "median_t63")


def rise_events(samples: DataFrame, on: float = 50, off: float = 5, width: int = 360) -> DataFrame:
    """Heater starts: the gain jumps from ``off`` or less to ``on`` or more between neighbouring rows; the rise until it falls or ``width`` rows pass."""
    rows = samples.select(*KEY, F.col("grid_idx").alias("grid_idx"), "actual", "gain")
    near = Window.partitionBy(*KEY, "_chunk").orderBy("grid_idx")
    seen = order.haloed(rows, "grid_idx", CHUNK, 14, 1)
    seen = seen.withColumn("_next", F.lead("gain").over(near)).withColumn("_near", F.last(F.when(F.col("actual").isNotNull(), F.struct("grid_idx", "actual")), ignorenulls=True).over(near.rowsBetween(-14, 0)))
    starts = seen.where(~F.col("_guest") & (F.col("gain") <= off) & (F.col("_next") >= on)).join(rows.groupBy(*KEY).agg(F.min("grid_idx").alias("_first")), KEY)
    # the very first row of a series is not looked at for a starting temperature near the beginning
    t_start = F.when(~((F.col("grid_idx") - F.col("_first") < 15) & (F.col("_near.grid_idx") == F.col("_first"))), F.col("_near.actual"))
    starts = starts.select(*KEY, F.col("grid_idx").alias("i0"), t_start.alias("t_start"))
    starts = staged(starts)
    inside = staged(window_rows(starts, rows, width))
    low = inside.where("gain is not null").withColumn("_g", F.lag("gain").over(Window.partitionBy(*EVENT).orderBy("off")))
    low = low.where("gain < 20 and _g < 20").groupBy(*EVENT).agg(F.min("off").alias("stop"))
    ends = starts.join(low, EVENT, "left").select(*EVENT, F.coalesce("stop", F.lit(width + 1)).alias("stop"))
    ends = staged(ends)
    kept = greedy(ends.select(*KEY, "i0", (F.col("i0") + F.col("stop")).alias("close")))
    inside = inside.join(kept, EVENT, "left_semi").join(ends, EVENT).where("off <= stop").withColumn("s", F.when((F.col("off") < F.col("stop")) & F.col("actual").isNotNull(), F.col("off")))
    event = Window.partitionBy(*EVENT)
    inside = inside.withColumn("last", F.max("s").over(event)).withColumn("plateau", F.avg(F.when(F.col("s") >= F.col("last") - 30, F.col("actual"))).over(event))
    s, y, rise = F.col("s"), F.col("actual"), F.col("plateau") - F.col("t_start")
    early = F.when(s <= 30, s)
    out = inside.groupBy(*EVENT, "t_start", "last", "plateau").agg(
        F.count("s").alias("n"),
        F.min(F.when(y >= F.col("t_start") + 0.632 * rise, s)).alias("tau63_min"),
        F.avg("gain").alias("mean_u"),
        F.when(F.count(early) >= 5, (F.max_by(y, early) - F.min_by(y, early)) / F.greatest(F.max(early) - F.min(early), F.lit(1)) * 60).alias("slope_first_30"),
    )
    out = out.withColumn("rise_k", rise).where("t_start is not null and n >= 30 and last >= 60 and rise_k >= 0.5")
    return out.select(*EVENT, "rise_k", "tau63_min", F.when(F.col("mean_u") != 0, F.col("rise_k") / (F.col("mean_u") / 100)).alias("gain_k_per_duty"), "slope_first_30")


def rise_summary(rises: DataFrame) -> DataFrame:
    """Rises of each zone and the medians of their measures."""
    names = ("rise_k", "tau63_min", "gain_k_per_duty", "slope_first_30")
    rises = staged(rises.select(*KEY, *[F.col(c).cast("double").alias(c) for c in names]))
    values = rises.select(*KEY, F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in names])).alias("v")).select(*KEY, "v.*")
    cuts = order.medians(values, [*KEY, "measure"], "value").groupBy(*KEY).agg(*[F.max(F.when(F.col("measure") == c, F.col("median"))).alias(c) for c in names])
    return rises.groupBy(*KEY).agg(F.count("*").alias("n")).join(cuts, KEY, "left")


def heating_type(zones: DataFrame) -> DataFrame:
    """``zones(KEY, regime, n_events, median_1k, no_drop_share, prior)``: verdict and confidence."""
    r = RULES
    m, n = F.col("median_1k"), F.coalesce("n_events", F.lit(0))
    none = F.struct(F.lit("ambiguous").alias("verdict"), F.lit(0.3).alias("confidence"))
    say = lambda v, c: F.struct(F.lit(v).alias("verdict"), (c if not isinstance(c, float) else F.lit(c)).alias("confidence"))
    prior = F.coalesce("prior", F.lit(""))
    v = (
        F.when(F.col("regime").isin("dead", "no_data"), say("excluded", 1.0))
        .when((n < r["min_events"]) | (m.isNull() & (F.coalesce("no_drop_share", F.lit(0.0)) == 0)), none)
        .when((m <= r["fast_max"]) & (F.col("regime") == "binary"), say("electric-fast", F.when(prior == "electric", 0.9).when(prior == "hydronic", 0.55).otherwise(0.8)))
        .when((F.col("no_drop_share") >= r["floor_share"]) | (m >= r["floor_median"]), say("floor-slow", F.when(prior.isin("hydronic", "mixed"), 0.6).otherwise(0.5)))
        .when(m >= r["slow_min"], say("hydronic-slow", F.when(prior == "hydronic", 0.75).otherwise(0.55)))
        .otherwise(say("ambiguous", 0.4))
    )
    return zones.withColumn("_v", v).select(*KEY, "regime", "n_events", "median_1k", "no_drop_share", "_v.*")


#: Verdicts from most to least flexible.
FLEXIBLE = ("electric-fast", "hydronic-slow", "floor-slow", "ambiguous", "excluded")


def flexibility(types: DataFrame, facing: DataFrame) -> DataFrame:
    """Zones ranked by verdict, time constant, zone and building, with the duty left in winter."""
    place = F.create_map(*[x for i, v in enumerate(FLEXIBLE) for x in (F.lit(v), F.lit(i))])
    out = types.join(facing, KEY, "left").withColumn("headroom", F.round(100 - F.col("winter_duty"), 1)).withColumn("orientation", F.coalesce("orientation", F.lit("unknown")))
    out = out.withColumns({"_place": F.coalesce(place[F.col("verdict")], F.lit(9)), "_time": F.coalesce("median_1k", F.lit(9999.0))})
    ranked = order.numbered(out, [F.col(c) for c in ("_place", "_time", "zone", "building")], "rank")
    return ranked.select(F.col("rank").cast("int").alias("rank"), *KEY, "verdict", "median_1k", "orientation", "headroom")


def facts_of_zones(tables: dict[str, DataFrame]) -> DataFrame:
    """Facts of zones from several tables, each ``(building, zone, ...)`` with a row per zone: all their columns, and ``known``, the
    names of the tables that know the zone. One grouping, whatever the number of tables."""
    rows = None
    for name, t in sorted(tables.items()):
        t = t.withColumn("_table", F.lit(name))
        rows = t if rows is None else rows.unionByName(t, allowMissingColumns=True)
    facts = [c for c in rows.columns if c not in (*KEY, "_table")]
    return rows.groupBy(*KEY).agg(*[F.any_value(c, ignoreNulls=True).alias(c) for c in facts], F.array_join(F.array_sort(F.collect_set("_table")), ",").alias("known"))
