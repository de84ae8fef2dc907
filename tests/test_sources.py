"""Readers on files written here, and the stream against the batch."""

from datetime import datetime, timedelta

from sensorloom.operators import graph, series, zones
from sensorloom.sources import files
from sensorloom.streaming import proxy


def test_point_lines(spark, tmp_path):
    f = tmp_path / "20053401-X AV punkter 2025.csv"
    f.write_text("﻿a,b,2025-01-01 00:00:00,1.5\n\na,b,2025-01-02 00:00:00,x\nno commas\nc,2025-01-01 00:00:00, 2 \n", encoding="utf-8")
    rows = {(r.raw_label.lstrip("﻿"), r.ts_text): r for r in files.point_lines(spark, str(tmp_path)).collect()}
    assert rows[("a,b", "2025-01-01 00:00:00")].value == 1.5 and rows[("a,b", "2025-01-02 00:00:00")].value is None
    assert rows[("no commas", None)].malformed and rows[("c", "2025-01-01 00:00:00")].value == 2.0
    assert {r.file_kind for r in rows.values()} == {"AV"}
    good = files.point_lines(spark, str(tmp_path)).where("not malformed")
    assert series.series_stats(good).count() == 2
    allowed = spark.createDataFrame([("c",)], "raw_label string")
    assert files.point_lines(spark, str(tmp_path), labels=allowed).count() == 1


def test_zone_files(spark, tmp_path):
    d = tmp_path / "Buildings" / "B90" / "Thermal zone"
    d.mkdir(parents=True)
    (d / "Z-1.csv").write_text("Timestamp,T_Actualvalue,T_Setvalue,T_Gain\n2023-01-01 00:00:00+00:00,20.5,21,100\n2023-01-01 00:10:00+00:00,,,\n2023-01-01 00:20:00+00:00,x,21,0\n2023-01-01 00:30:00+00:00,20.6,,0\n")
    (d / "Z-2.csv").write_text("Timestamp,COOL_Actualvalue\n2023-01-01 00:00:00+00:00,1\n2023-01-01 00:30:00+00:00,\n")
    lines = files.zone_files(spark, str(tmp_path), ["b90"])
    s = zones.zone_stats(files.zone_samples(lines)).first()
    assert (s.n_grid, s.n_data, s.n_bad, s.t_n, s.sp_n, s.gain_100) == (4, 2, 1, 2, 1, 1)
    o = files.other_zones(lines).first()
    assert (o.kind, o.n_grid, o.n_data, o.first_ts) == ("cool_actual", 2, 1, "2023-01-01 00:00:00+00:00")


def test_weather_meters_and_tables(spark, tmp_path):
    w = tmp_path / "weather.csv"
    w.write_text("Time,Air temperature\n2023-01-10 00:00:00,3\n2023-01-10 01:00:00,3.5\n2023-01-11 00:00:00,-999\nbad,4\n")
    assert [(str(r.day), r.temp) for r in files.weather_daily(spark, str(w)).collect()] == [("2023-01-10", 3.25)]
    m = tmp_path / "m.csv"
    m.write_text(",main\n10/01/2023 00:00,\n10/01/2023 01:00,4\n10/01/2023 02:00,6\n")
    assert [(str(r.day), r.energy) for r in files.meter_daily(spark, str(m)).collect()] == [("2023-01-10", 10.0)]
    c = tmp_path / "c.md"
    c.write_text("|x|\n|**RT**|**Temperatur**<br>giver|y|\n|**RT**|other|\n|**P**|Ikke i bruk|\n")
    assert [(r.code, r.meaning, r.line) for r in files.component_codes(spark, str(c)).collect()] == [("RT", "Temperatur  giver", 2)]
    h = tmp_path / "h.md"
    h.write_text("<table><tr><td>320 Varme</td><td>x</td></tr><tr><td>320 Again</td></tr></table>")
    assert [(r.code, r["name"]) for r in files.system_codes(spark, str(h)).collect()] == [("320", "Varme")]
    a = tmp_path / "a.md"
    a.write_text("| 20053401 | one | f |\n| 20053401 | two | f |\n")
    assert [(r.control_number, r.area) for r in files.area_map(spark, str(a)).collect()] == [("20053401", "two")]


def test_triples_round_trip(spark, tmp_path):
    t = spark.createDataFrame([("g", "point/1", "label", 'say "hi" \\ x'), ("g", "point/1", "a", "Point")], "graph string, s string, p string, o string")
    files.write_graphs(graph.triple_lines(t), str(tmp_path / "out"))
    back = files.triple_rows(spark, str(tmp_path / "out" / "graph=g"))
    assert back.count() == 2


def test_new_zones_only(spark, tmp_path):
    rows = spark.createDataFrame([("B", "Z1", 1.0), ("B", "Z2", 2.0)], "building string, zone string, x double")
    files.write_new_zones(rows.where("zone = 'Z1'"), str(tmp_path / "p"))
    files.write_new_zones(rows, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_stream_equals_batch(spark, tmp_path):
    start = datetime(2023, 1, 1)
    rows = [("B", "Z", start + timedelta(minutes=10 * i), float(i % 7) if i % 5 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "building string, zone string, ts timestamp, gain double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = proxy.hourly_proxy(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    proxy.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r.hour: (r.mean_gain, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.hour: (r.mean_gain, r.n) for r in zones.hourly_proxy(df).collect()}
    assert got and all(want[h] == v for h, v in got.items()) and len(want) - len(got) <= 3
