"""Pairs of large groups, stores with repeats, merges and text folding, on rows written here."""

import statistics

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import labels as lb
from sensorloom.operators import checks, decode, events, scoring, zones
from sensorloom.sources import files


def test_pairs_of_a_large_group(spark):
    members = spark.range(1001).select(F.format_string("L%d", "id").alias("raw_label"), F.lit("same_system").alias("kind"), F.lit("k").alias("key"))
    assert checks.group_pairs(members).count() == 1001 * 1000
    assert checks.group_pairs(members.limit(1)).count() == 0


def test_last_record_of_a_store_counts(spark):
    labels = spark.createDataFrame([("A:70010001-OU1/320001.RT401", "bacnet"), ("B", "bacnet")], "raw_label string, source_type string")
    decoded = decode.decode_rules(labels, {"RT": "sensor"}, {"320": "heat"})
    store = decoded.drop("tier").withColumn("arrival", F.lit(1)).unionByName(decoded.drop("tier").withColumns({"arrival": F.lit(2), "confidence": F.lit(0.7)}))
    got = decode.retrieve(decoded, store).collect()
    assert len(got) == 2 and {r.confidence for r in got} == {0.7}


def test_merge_keeps_the_contract(spark):
    labels = spark.createDataFrame([("plain", "bacnet")], "raw_label string, source_type string")
    decoded = decode.decode_rules(labels, {}, {})
    second = spark.createDataFrame([("plain", "steam", 0.9)], "raw_label string, carrier string, confidence double")
    r = decode.merge_second(decoded, second).first()
    assert r.carrier is None and r.decode_method == "rules" and [c.field for c in r.conflicts] == ["_schema"]


def test_text_folding(spark):
    df = spark.createDataFrame([("  STRASSE  å", "Straße Å"), ("x", "X "), ("é", "e"), (None, None)], "a string, b string")
    got = df.select(lb.normal_text(F.col("a")) == lb.normal_text(F.col("b"))).collect()
    assert [r[0] for r in got] == [True, True, False, None]


def test_rules_from_a_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"_note": "a comment", "pump": {"function": "drive", "unit": null, "_why": "x"}}')
    rules = files.rules(spark, str(path))
    assert rules == {"pump": {"function": "drive"}}
    labels = spark.createDataFrame([("A/Main pump", "bacnet")], "raw_label string, source_type string")
    assert decode.decode_rules(labels, {}, {}, keywords=rules).first().function == "drive"


def test_zone_moments_by_brute_force(spark, monkeypatch):
    rows = [(zone, i, None if i % 3 else 20.1 + i % 4 * 0.37, 21.3 if i // 7 % 2 else 17.7) for zone in ("Z", None) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "zone string, grid_idx long, actual double, setpoint double").selectExpr("'B' AS building", "*", "0d AS gain", "false AS is_empty", "false AS is_bad", "timestamp_seconds(grid_idx * 60) AS ts")
    whole = {r.zone: r for r in zones.zone_stats(df).collect()}
    monkeypatch.setattr(zones, "CHUNK", 7)
    assert {r.zone: r for r in zones.zone_stats(df).collect()} == whole
    for zone, r in whole.items():  # the zone without a name has all its facts too
        kept = [x for x in rows if x[0] == zone]
        for name, values in (("t", [x[2] for x in kept]), ("sp", [x[3] for x in kept]), ("comfort", [x[2] and x[2] - x[3] for x in kept])):
            known = [v for v in values if v is not None]
            assert (r[f"{name}_n"], r[f"{name}_mean"], r[f"{name}_std"]) == (len(known), pytest.approx(statistics.fmean(known)), pytest.approx(statistics.stdev(known)))
        assert (r.sp_distinct, len(r.sp_top), r.gain_std, r.flags) == (2, 2, 0.0, ["dead_gain"])


def test_chunks_do_not_change_zone_results(spark, monkeypatch):
    rows = [("B", "Z", i, None if i % 3 else 20.0 + i % 4, 21.0 if i // 7 % 2 else 17.0, 0.0, False, False) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "building string, zone string, grid_idx long, actual double, setpoint double, gain double, is_empty boolean, is_bad boolean").withColumn("ts", F.timestamp_seconds(F.col("grid_idx") * 60))
    whole = zones.zone_stats(df).first()
    spans = spark.createDataFrame([("B", "Z", i, i + 5 + i % 4) for i in range(0, 300, 2)], "building string, zone string, i0 long, close long")
    kept = sorted(r.i0 for r in events.greedy(spans).collect())
    monkeypatch.setattr(zones, "CHUNK", 10)
    monkeypatch.setattr(events, "CHUNK", 10)
    assert zones.zone_stats(df).first() == whole and whole.sp_steps > 20
    assert sorted(r.i0 for r in events.greedy(spans).collect()) == kept
    end, want = -1, []
    for i in range(0, 300, 2):
        if i >= end:
            want.append(i)
            end = i + 5 + i % 4
    assert kept == want


def test_last_valid_record_of_a_label_counts(spark):
    rows = spark.createDataFrame([("a", "bacnet", "steam"), ("a", "bacnet", "el"), ("b", "bacnet", "el"), ("c", "nobody", "el")], "raw_label string, source_type string, carrier string")
    rows = rows.withColumns({"measurement_type": F.lit(None).cast("string"), "object_type": F.lit(None).cast("string"), "confidence": F.lit(0.5)}).coalesce(1)
    r = scoring.validity_rate(scoring.contract(rows)).first()
    assert (r.n_outputs, r.valid, r.validity_rate) == (4, 2, 0.5)
