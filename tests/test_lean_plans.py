"""Plans that stay small on the driver, and jobs that keep no row of a building's size."""

import json

from compare import DATA
from pyspark.sql import functions as F

from sensorloom.operators import buildings as bg
from sensorloom.operators import contract as ct
from sensorloom.operators import decode as dc
from sensorloom.plans import buildings as pb
from sensorloom.plans import labels as pl


def test_decoding_is_a_few_projections(spark):
    rows = spark.createDataFrame([("n:70010001-OU001/320001.-RT401", "bacnet")], "raw_label string, source_type string")
    plan = pl.rules(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project [") <= 16


def test_mutations_plan_one_decoding_at_a_time(spark):
    label = "n:70010001-OU001/320001.Area_1.-RT401"
    rows = spark.createDataFrame([(label, "bacnet"), (label, "bacnet"), ("plain", "bacnet")], "raw_label string, source_type string")
    out = dc.mutation_losses(rows, pl.rules)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "drenspumpe" not in plan
    # a label that stands twice is tried twice
    assert {r.mutation: r.tried for r in out.collect()} == {"swap": 2, "lowercase": 2, "spaces": 2}


ROWS = """raw_label string, source_type string, carrier string, primary_system struct<code:string,description:string>, location struct<building:string,room:int>,
is_derived boolean, confidence double, data_checks struct<temp_correlation:double,distinct_values:int>, decode_method string, unit void, reasoning int, tier string"""


def test_contract_of_typed_rows_is_that_of_their_json(spark):
    values = [
        ("a", "bacnet", "el", ("3200", None), ("B", 1), True, 0.5, (0.1, 3), "rules", None, None, "FULL"),
        (None, None, None, None, None, None, None, None, None, None, None, None),
        ("a", "radio", "steam", (None, "x"), (None, None), None, 1.5, (None, None), "guess", None, 4, "NONE"),
        ("", "", "", ("", ""), None, False, float("nan"), (float("nan"), None), "", None, None, "NONE"),
        ("b", "other", "annet", None, None, False, float("inf"), (float("-inf"), 0), "human", None, None, None),
        ("c", "kiona", "gass", None, None, False, -0.25, None, "llm", None, None, "NONE"),
        ("d", "kiona", "gass", None, None, False, 1.0, None, "llm", None, None, "FULL"),
    ]
    rows = spark.createDataFrame(values, ROWS)
    for some in (rows, rows.drop("location", "reasoning"), rows.drop("source_type", "confidence"), rows.withColumn("confidence", F.col("confidence").cast("float")), rows.withColumn("validated", F.lit(True))):
        got = ct.record_violations(some).select("raw_label", "violations").collect()
        assert got == ct.violations(some.withColumn("record", ct.record(some)), ct.RECORD).select("raw_label", "violations").collect()
    settled = lambda df: ct.settled(ct.RECORD, df.select(ct.members(df).alias("r")).schema["r"].dataType, ct.members(df)) is not None
    assert settled(rows) and not settled(rows.withColumn("data_checks", F.struct(F.lit(2.0).alias("distinct_values"))))


def test_index_comes_in_bounded_pieces(spark, monkeypatch):
    monkeypatch.setattr(pb, "PIECE", 2)
    most = pb.index(spark, DATA).select(*[F.max(F.size(c)).alias(c) for c in ("sub_buildings", "systems", "rooms", "meters", "zones", "provenance")]).first()
    # keys are not dealt evenly to nations; facts are of four tables
    assert max(most[c] for c in ("sub_buildings", "systems", "rooms")) <= 2 * 25 // 4 and most["meters"] == 2 and most["zones"] == 2 and most["provenance"] <= 2 * 25


def whole(name, **parts):
    system = {"id": f"S-{name}", "kind": "ahu", "serves": '["P1","P2"]', "points": [{"code": "RT401", "label": "l", "file": "f"}]}
    room = lambda k: {"id": f"R{k}-{name}", "number": str(k), "floor": k % 2, "sub_building_id": "P1", "points": [{"signal": "heating", "label": "l", "file": "f"}] * 2}
    zone = lambda k: {"level_id": f"L{k % 2}", "level_label": f"level {k} {name}", "sub_building_id": f"P{3 + k % 2}", "sub_building_label": f"part {k} {name}", "building_node": f"B-{name}"}
    fact = {"source": name, "confidence": "high"}
    return {
        "building": name, "building_node": f"B-{name}", "building_name": f"house {name}",
        "sub_buildings": [{"id": f"P{k}", "name": f"{k} of {name}", "heating": name} for k in (2, 1, 2)],
        "systems": [system, {"id": "S", "kind": "heating", "parent": f"S-{name}"}, {"id": "S", "kind": name}], "rooms": [room(k) for k in (3, 1, 2)],
        "meters": [{"id": f"M-{name}", "utility": "el"}, {"id": f"M2-{name}", "utility": "el", "parent": f"M-{name}"}],
        "zones": {f"Z{k}": zone(k) for k in (5, 4, 7, 6)}, "provenance": {"S": {"location": fact}, "P1": {"heating": fact}, "Z4": {"location": fact}, f"R1-{name}": {"number": fact}},
    } | parts


def test_index_in_pieces_says_what_whole_files_say(spark, tmp_path):
    lists, (files, lines) = ("sub_buildings", "systems", "rooms", "meters", "zones", "provenance"), (tmp_path / "files", tmp_path / "lines")
    files.mkdir(), lines.mkdir()
    for name in ("A", "B"):
        one = whole(name)
        (files / f"{name}.json").write_text(json.dumps(one, indent=1))
        names = {k: v for k, v in one.items() if k not in lists}
        cut = [(c, {k: v}) if isinstance(one[c], dict) else (c, [v]) for c in lists for k, v in (one[c].items() if isinstance(one[c], dict) else enumerate(one[c]))]
        (lines / f"{'BA'['AB'.index(name)]}.json").write_text("\n".join(json.dumps(names | {"piece": i, c: v}) for i, (c, v) in reversed(list(enumerate(cut)))))
    facts = spark.createDataFrame([("A", z, "t_triple", "binary", "heating", 1.0, 2.0, "v", 0.5, "r", 3.0, ["f"]) for z in ("Z4", "Z5", "Z6", "R1-A")], "building string, zone string, kind string, regime string, orientation string, winter_duty double, summer_duty double, verdict string, confidence double, reasoning string, tau double, flags array<string>")
    a, b = bg.building_index(spark, str(files)), bg.building_index(spark, str(lines), pieces=True)
    assert a.count() == 2 and b.count() > 30
    rows = lambda df: sorted(map(str, df.collect()))
    for made in (lambda i: bg.edges(i, facts), lambda i: bg.nodes(i, facts), bg.spatial_triples, lambda i: bg.zone_triples(i, facts), bg.dangling_references, bg.room_points):
        assert rows(made(a)) == rows(made(b))
