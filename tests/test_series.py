"""Hand-computed cases of series statistics, zone analyses and events."""

import math
from datetime import datetime, timedelta

from sensorloom.functions import labels as lb
from sensorloom.functions.numbers import exclusive_quantile, parse_number, pearson
from sensorloom.operators import events, series, zones
from pyspark.sql import functions as F


def points(spark, rows):
    return spark.createDataFrame([(a, t, v, i, "f AV punkter.csv", "AV") for i, (a, t, v) in enumerate(rows)], "raw_label string, ts_text string, value double, arrival long, file string, file_kind string")


def test_messy_series(spark):
    p = points(spark, [("a", "2025-01-01", 1.0), ("a", "2025-01-03", 2.0), ("a", "2025-01-02", 0.5), ("a", "2025-01-04", None)])
    r = series.series_stats(p).first()
    assert (r.n_rows, r.n_bad, r.out_of_order, r.n_decreases, r.monotonic) == (4, 1, 1, 0, True)


def test_chunks_do_not_change_order_defects(spark):
    rows = [("a", f"2025-01-{1 + (i * 7) % 28:02d}", float((i * 5) % 11)) for i in range(60)]
    p = points(spark, rows)
    key = lambda df: sorted((r.arrival, r.stray, r.decrease) for r in df.collect())
    assert key(series.ordered_rows(p, 7)) == key(series.ordered_rows(p, 1000))


def test_many_values_are_capped_and_few_listed(spark):
    p = points(spark, [("many", f"t{i:02d}", float(i)) for i in range(37)] + [("few", f"t{i:02d}", float(i % 2)) for i in range(6)] + [("bad", "t", None)])
    r = {x.raw_label: x for x in series.series_stats(p).collect()}
    assert r["many"].distinct is None and r["many"]["values"] is None and not r["many"].is_binary
    assert r["few"].distinct == 2 and r["few"]["values"] == [0.0, 1.0] and r["few"].is_binary
    assert r["bad"].distinct == 0 and r["bad"]["values"] == [] and r["bad"].monotonic is None


def test_numbers(spark):
    texts = ["1", " -2.5e3 ", "nan", "1d", "", "abc", "inf", "-Infinity", ".5", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", parse_number(F.col("t")).alias("v")).orderBy("i").collect()]
    assert got == [1.0, -2500.0, None, None, None, None, math.inf, -math.inf, 0.5, None]


def test_pearson_is_null_for_a_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "x double, y double")
    assert df.agg(pearson("x", "y")).first()[0] is None


def test_exclusive_quartiles(spark):
    df = spark.createDataFrame([([20.0, 22.0, 24.0, 30.0],)], "v array<double>")
    r = df.select(*[exclusive_quantile(F.col("v"), k).alias(f"q{k}") for k in (1, 2, 3)]).first()
    assert tuple(r) == (20.5, 23.0, 28.5)


def grid(spark, night_gain):
    start, rows, t = datetime(2023, 1, 1), [], 21.0
    for i in range(3 * 1440):
        m = i % 1440
        night = m >= 21 * 60 or m < 5 * 60
        since = (m - 21 * 60) % 1440 if night else None
        temp = 15 + 6 * math.exp(-since / 120) if night else 21.0
        rows.append(("B", "Z", start + timedelta(minutes=i), temp, 17.0 if night else 21.0, float(night_gain) if night else 100.0, i + 1, False, False))
    return spark.createDataFrame(rows, "building string, zone string, ts timestamp, actual double, setpoint double, gain double, grid_idx long, is_empty boolean, is_bad boolean")


def test_decay_events_follow_the_closed_form(spark):
    found = events.decay_events(grid(spark, 0)).orderBy("i0").collect()
    assert len(found) == 3
    assert all(20 <= r.minutes_to_1k <= 24 for r in found)
    assert all(95 <= r.t63_minutes <= 135 for r in found if r.t63_minutes)
    assert found[0].season == "2022-23"
    assert events.decay_events(grid(spark, 100)).count() == 0


def test_rise_event(spark):
    start = datetime(2023, 1, 1)
    rows = [("B", "Z", start + timedelta(minutes=i), 20.0 + (2 * (1 - math.exp(-(i - 100) / 40)) if 100 <= i else 0.0), 21.0, 100.0 if 100 <= i < 250 else 0.0, i, False, False) for i in range(300)]
    df = spark.createDataFrame(rows, "building string, zone string, ts timestamp, actual double, setpoint double, gain double, grid_idx long, is_empty boolean, is_bad boolean")
    found = events.rise_events(df).collect()
    assert len(found) == 1 and 25 <= found[0].tau63_min <= 60


def test_greedy_starts_on_the_closing_row(spark):
    df = spark.createDataFrame([("B", "Z", 1, 10), ("B", "Z", 5, 20), ("B", "Z", 10, 12), ("B", "Z", 11, 30)], "building string, zone string, i0 long, close long")
    assert sorted(r.i0 for r in events.greedy(df).collect()) == [1, 10]


def test_empty_grid_has_no_rows(spark):
    empty = grid(spark, 0).limit(0)
    assert zones.zone_stats(empty).count() == 0 and events.decay_events(empty).count() == 0


def test_labels(spark):
    x = "A20:20053401-OU001/FCB.320001_bygg5.-RT404_WSP.#85"
    r = lb.with_tokens(spark.createDataFrame([(x,)], "raw_label string")).first()
    assert r.segs == ["FCB", "320001_bygg5", "-RT404_WSP"]
    assert (r.control_number, r.controller_rest, r.system_digits, r.bygg, r.point_token, r.point_suffix) == ("20053401", "OU001", "320001", "bygg5", "-RT404", "_WSP")
