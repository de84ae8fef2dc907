"""Queries over a building index and its property graph, with their SQL.

The index is made from the star-schema tables by plain arithmetic, written as nested JSON, in lines that are pieces of a nation, and read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import buildings as bg
from ..operators import order
from ..sources.shared import staged
from .reports import written
from .views import table

E = F.expr
#: Entries of a list or map of the index in a piece, as many as keys are dealt to nations.
PIECE, NATIONS = 32, 25
SYSTEM = {
    "id": "concat('SY', cast(k as string))",
    "kind": "case k % 4 when 0 then 'ahu' when 1 then 'heating' when 2 then 'device' else 'other' end",
    "name": "case when k % 5 <> 0 then s_name end",
    "parent": "case when k % 5 = 1 then concat('SY', cast(k + 1 as string)) end",
    "sub_building_id": "case k % 3 when 1 then concat('SB', cast(k as string)) when 2 then case when k % 2 = 0 then concat('SX', cast(k as string)) end end",
    "controller": "case when k % 2 = 1 then concat('OU', cast(k as string)) end",
    "subsystem": "case when k % 3 = 0 then concat('36', cast(k as string)) end",
}
HEATING = "case k % 3 when 0 then 'radiator' when 1 then 'gulv' end"
ROOM = {"id": "concat('R', cast(k as string))", "number": "cast(k as string)", "floor": "case when k % 4 < 3 then cast(k % 4 as int) end", "plan": "case when k % 8 = 3 then 2 end", "bus": "concat('bus', cast(k % 3 as string))", "sub_building_id": "case when k % 9 <> 0 then concat('SB', cast(1 + k % 12 as string)) end"}
ZONE = {
    "zone": "concat(case when k % 6 = 0 then 'R' else 'Z' end, cast(k as string))",
    "level_id": "case when k % 4 = 0 then concat('L', cast(k % 30 as string)) end",
    "level_label": "case when k % 4 = 0 then concat('Level ', cast(k % 30 as string)) end",
    "sub_building_id": "case when k % 4 < 2 then concat('SB', cast(7 + k % 8 as string)) end",
    "sub_building_label": "case when k % 4 = 0 then concat('Part ', cast(7 + k % 8 as string)) end",
    "building_node": "case when k % 4 < 3 then concat('B-N', cast(k % 25 as string)) end",
    "meter_id": "case when k % 5 = 0 then concat('M', cast(k % 25 as string)) end",
}
FACT = {
    "building": "concat('N', cast(k % 25 as string))",
    "zone": f"case when k % 17 = 0 then concat('Q ', cast(k as string)) else {ZONE['zone']} end",
    "kind": "case when k % 8 = 7 then 'co2_triple' else 't_triple' end",
    "regime": "case when k % 11 <> 0 then case k % 3 when 0 then 'binary' when 1 then 'modulating' else 'dead' end end",
    "orientation": "case when k % 7 <> 0 then 'heating' end",
    "winter_duty": "case when k % 7 <> 0 then cast(k % 100 as double) end",
    "summer_duty": "case when k % 7 <> 0 then cast(k % 10 as double) end",
    "verdict": "case when k % 13 <> 0 then case when k % 2 = 0 then 'electric-fast' else 'hydronic-slow' end end",
    "confidence": "case when k % 13 <> 0 then 0.75D end",
    "reasoning": "case when k % 13 <> 0 then concat('median of ', cast(k as string)) end",
    "tau": "case when k % 5 <> 0 then cast(k % 400 as double) + 0.5D end",
}


def keyed(spark, d, name, key, *more):
    return table(spark, d, name).select(F.col(key).cast("long").alias("k"), *more)


def zone_facts(spark, d):
    rows = keyed(spark, d, "part", "p_partkey").select("k", *[E(v).alias(n) for n, v in FACT.items()])
    return rows.withColumn("flags", F.when(F.col("k") % 9 == 0, F.array(F.lit("dead_gain"), F.lit("empty"))).otherwise(F.array().cast("array<string>"))).drop("k")


def index(spark, d):
    s = keyed(spark, d, "supplier", "s_suppkey", "s_name", F.col("s_nationkey").cast("long").alias("n"))
    c = keyed(spark, d, "customer", "c_custkey", F.col("c_nationkey").cast("long").alias("n"))
    p = keyed(spark, d, "part", "p_partkey").withColumn("n", F.col("k") % 25)
    nation = keyed(spark, d, "nation", "n_nationkey", "n_name").withColumnRenamed("k", "n")
    piece = (F.col("k") / (PIECE * NATIONS)).cast("long").alias("piece")
    sub = s.select("n", piece, F.struct(E("concat('SB', cast(k as string))").alias("id"), F.col("s_name").alias("name"), E(HEATING).alias("heating")).alias("e"))
    code = lambda x: F.struct(E(x).alias("code"), E(f"concat('label ', {x})").alias("label"), F.lit("f.csv").alias("file"))
    serves = E("case when k % 2 = 0 then concat('[\"SB', cast(k as string), '\",\"SB', cast(k + 1 as string), '\"]') when k % 7 = 1 then concat('SB', cast(k as string)) end").alias("serves")
    points = F.array(code("concat('RT4', lpad(cast(k % 100 as string), 2, '0'))"), code("concat('LR', cast(10 + k % 80 as string))"), code("concat('X', cast(k as string))")).alias("points")
    system = s.select("n", piece, F.struct(*[E(v).alias(x) for x, v in SYSTEM.items()], serves, points).alias("e"))
    sig = lambda name, on, i: E(f"case when {on} then named_struct('signal', '{name}', 'label', concat('label {i} ', cast(k as string)), 'file', 'r.csv') end")
    room = c.select("n", piece, F.struct(*[E(v).alias(x) for x, v in ROOM.items()], F.array_compact(F.array(sig("temperature", "true", 0), sig("temperature_setpoint", "k % 2 = 0", 1), sig("heating", "k % 3 = 0", 2), sig("airflow", "k % 5 = 0", 3), sig("airflow", "k % 5 = 0", 4))).alias("points")).alias("e"))
    meter = nation.select("n", F.lit(0).cast("long").alias("piece"), F.explode(F.array(E("named_struct('id', concat('M', cast(n as string)), 'name', n_name, 'utility', 'el', 'parent', cast(null as string))"), E("named_struct('id', concat('M', cast(n as string), 's'), 'name', n_name, 'utility', 'el', 'parent', concat('M', case when n % 7 = 0 then 'X' else cast(n as string) end))"))).alias("e"))
    zone = p.select("n", F.struct(E(ZONE["zone"]).alias("key"), F.struct(*[E(v).alias(x) for x, v in ZONE.items() if x != "zone"]).alias("value")).alias("e"))
    fact = lambda on, name, source, confidence, value="null", conflict="null": E(f"case when {on} then named_struct('key', '{name}', 'value', named_struct('source', {source}, 'confidence', {confidence}, 'value', cast({value} as string), 'conflict', cast({conflict} as boolean))) end")
    known = lambda df, id_, *facts: df.select("n", piece, F.struct(E(id_).alias("key"), F.map_from_entries(F.array_compact(F.array(*facts))).alias("value")).alias("e"))
    prov = known(s, "concat('SB', cast(k as string))", fact("k % 2 = 0", "heating", "concat('survey ', cast(k as string))", "'verified'", conflict="k % 4 = 0"))
    prov = prov.unionByName(known(s, SYSTEM["id"], fact("k % 3 = 1", "location", "'plan'", "'high'"), fact("k % 4 = 0", "serves", "'panel'", "cast(null as string)")))
    prov = prov.unionByName(known(c, ROOM["id"], fact("k % 10 = 0", "heating", "'visit'", "'verified'", "'panel'"), fact("k % 8 = 0", "number", "'door'", "cast(null as string)")))
    prov = prov.unionByName(known(p.where("k % 6 <> 0"), ZONE["zone"], fact("k % 3 = 0 or k % 3 = 1", "location", "'drawing'", "'high'")))
    out = nation.select("n", E("concat('N', cast(n as string))").alias("building"), E("concat('B-N', cast(n as string))").alias("building_node"), E("case when n % 2 = 0 then n_name end").alias("building_name"), F.col("n_name").alias("display_name"))
    # pieces of zones follow each other in the order of their names, as they would in one map
    zone = order.numbered(zone, [F.col("n"), F.col("e.key")]).select("n", ((F.col("number") - 1) / PIECE).cast("long").alias("piece"), "e")
    lists = [rows.groupBy("n", "piece").agg(F.collect_list("e").alias(name)) for rows, name in ((sub, "sub_buildings"), (system, "systems"), (room, "rooms"), (meter, "meters"))]
    maps = [zone.groupBy("n", "piece").agg(F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("zones")), prov.groupBy("n", "piece").agg(F.map_from_entries(F.collect_list("e")).alias("provenance"))]
    # a row per nation goes to every piece; no row, line or task holds a nation
    pieces = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lists + maps).join(F.broadcast(out), "n").drop("n")
    return staged(bg.building_index(spark, written(spark, pieces, "json"), pieces=True))


def flat_nodes(df):
    return df.withColumn("props", F.array_join(F.transform(F.map_entries("props"), lambda x: F.concat_ws("=", x["key"], x["value"])), "|"))


def grf08(spark, d):
    return flat_nodes(bg.nodes(index(spark, d), zone_facts(spark, d)))


def grf09(spark, d):
    return bg.edges(index(spark, d), zone_facts(spark, d))


def kept(query, where):
    return lambda spark, d: query(spark, d).where(where)


def grf06(spark, d):
    return bg.spatial_triples(index(spark, d))


def grf07(spark, d):
    return bg.zone_triples(index(spark, d), zone_facts(spark, d))


def jon18(spark, d):
    return bg.dangling_references(index(spark, d))


def win11(spark, d):
    return bg.room_points(index(spark, d))


def grf13_rooms(spark, d):
    """Rooms by part of the building and storey, two steps up, with how many have known heating."""
    i, f = index(spark, d), zone_facts(spark, d)
    e = bg.edges(i, f)
    rooms = bg.nodes(i, f).where("label = 'Room'").select(F.col("id").alias("src"), F.col("props")["heatingType"].isNotNull().alias("heated"))
    up = e.where("src_label = 'Room' and type = 'LOCATED_IN' and dst_label = 'Level'").select("src", F.col("dst").alias("level"))
    part = e.where("src_label = 'Level' and type = 'PART_OF'").select(F.col("src").alias("level"), F.col("dst").alias("part"))
    return rooms.join(up, "src").join(part, "level").groupBy("part", "level").agg(F.count("*").alias("rooms"), F.count_if("heated").alias("heated"))


def grf13_served(spark, d):
    """Which systems serve each part of a building, from what source."""
    e = bg.edges(index(spark, d), zone_facts(spark, d)).where("type = 'SERVES'")
    return e.groupBy(F.col("dst").alias("part")).agg(F.count("*").alias("systems"), F.count("source").alias("sourced"))


def grf13_submeters(spark, d):
    e = bg.edges(index(spark, d), zone_facts(spark, d)).where("type = 'SUBMETER_OF'")
    return e.groupBy(F.col("dst").alias("meter")).agg(F.count("*").alias("submeters"))


ROOM_HEAT = "label = 'Room' and props like '%heatingType=%'"
MADE = "(label = 'System' and kind = 'category') or (label = 'Level' and id like '%-PLAN%')"
BACKED = "label = 'Room' and (props like '%dataVerdict=%' or props like '%regime=%')"
CONFLICT = "props like '%heatingConflict=%'"
ASSUMED = "label = 'Room' and props like '%heatingConfidence=assumed%'"
UNHEATED = "label = 'Room' and props not like '%heatingType=%'"
FLAGGED = "label = 'Room' and props like '%qualityFlags=%'"
PLACED = "(src_label = 'System' and type in ('PART_OF', 'LOCATED_IN')) or type = 'MEASURED_BY'"
QUERIES = {
    "grf06_spatial_triples": grf06,
    "grf07_zone_triples": grf07,
    "grf08_nodes": grf08,
    "grf09_edges": grf09,
    "grf10_room_heating": kept(grf08, ROOM_HEAT),
    "grf11_synthetic_nodes": kept(grf08, MADE),
    "grf12_backed_rooms": kept(grf08, BACKED),
    "grf13_rooms_by_level": grf13_rooms,
    "grf13_served_parts": grf13_served,
    "grf13_submeters": grf13_submeters,
    "grf13_heating_conflicts": kept(grf08, CONFLICT),
    "grf13_assumed_rooms": kept(grf08, ASSUMED),
    "grf13_rooms_without_heating": kept(grf08, UNHEATED),
    "grf13_flagged_rooms": kept(grf08, FLAGGED),
    "jon18_index_references": jon18,
    "jon23_placement": kept(grf09, PLACED),
    "win11_room_points": win11,
    "scl18_descriptions": kept(grf08, "props like '%description=%'"),
}


def q(text: str) -> str:
    return text.replace("as string", "AS VARCHAR").replace("as int)", "AS INT)").replace("0.75D", "0.75::DOUBLE").replace("0.5D", "0.5::DOUBLE").replace("as double", "AS DOUBLE")


def cols(view: dict) -> str:
    return ", ".join(f"{q(v)} AS {n}" for n, v in view.items())


def props(**named: str) -> str:
    return "concat_ws('|', " + ", ".join(f"'{k}=' || ({v})::VARCHAR" for k, v in sorted(named.items())) + ")"


TAU = "floor(tau)::INT"
IRI = "CASE WHEN regexp_replace({x}, '[^A-Za-z0-9_.-]', '_', 'g') = {x} THEN {x} ELSE regexp_replace({x}, '[^A-Za-z0-9_.-]', '_', 'g') || '_' || substr(sha1({x}), 1, 6) END"
VIEWS = f"""WITH sb0 AS (SELECT 'SB' || k AS id, s_name AS name, {q(HEATING)} AS heating, n, k FROM (SELECT s_suppkey AS k, s_name, s_nationkey AS n FROM supplier)),
sy AS (SELECT *, 'B-N' || n AS under FROM (SELECT {cols(SYSTEM)}, k, n FROM (SELECT s_suppkey AS k, s_name, s_nationkey AS n FROM supplier))),
rm AS (SELECT *, 'B-N' || n AS under, k % 2 = 0 AS sp, k % 3 = 0 AS ht FROM (SELECT {cols(ROOM)}, k, n FROM (SELECT c_custkey AS k, c_nationkey AS n FROM customer))),
zn AS (SELECT {cols(ZONE)}, k, k % 25 AS n FROM (SELECT p_partkey AS k FROM part)),
zf AS (SELECT {cols(FACT)}, CASE WHEN k % 9 = 0 THEN 'dead_gain,empty' END AS flags FROM (SELECT p_partkey AS k FROM part)),
mt AS (SELECT 'M' || n_nationkey AS id, n_name AS name, NULL AS parent, 'B-N' || n_nationkey AS under FROM nation UNION ALL SELECT 'M' || n_nationkey || 's', n_name, 'M' || CASE WHEN n_nationkey % 7 = 0 THEN 'X' ELSE n_nationkey::VARCHAR END, 'B-N' || n_nationkey FROM nation),
sb1 AS (SELECT id, name, heating, n, 0 AS late FROM sb0 UNION ALL SELECT sub_building_id, coalesce(sub_building_label, sub_building_id), NULL, n, 1 FROM zn WHERE sub_building_id IS NOT NULL),
sb AS (SELECT id, name, heating, 'B-N' || n AS under, CASE WHEN heating IS NOT NULL AND substr(id, 3)::INT % 2 = 0 AND listed THEN 'survey ' || substr(id, 3) END AS hs, CASE WHEN heating IS NOT NULL AND substr(id, 3)::INT % 2 = 0 AND listed THEN substr(id, 3)::INT % 4 = 0 END AS hc
  FROM (SELECT *, id IN (SELECT id FROM sb0) AS listed, row_number() OVER (PARTITION BY id ORDER BY 'N' || n, late, name) AS rn FROM sb1) WHERE rn = 1),
r1 AS (SELECT rm.*, coalesce(floor, plan) AS fl, sb.id IS NOT NULL AS part, sb.heating AS part_heating FROM rm LEFT JOIN sb ON sb.id = rm.sub_building_id),
lv0 AS (SELECT level_id AS id, level_label AS name, sub_building_id AS part, 0 AS late, n, zone AS o FROM zn WHERE level_id IS NOT NULL UNION ALL SELECT sub_building_id || '-PLAN' || fl, CASE WHEN fl = 0 THEN 'U1' ELSE 'Plan ' || fl END, sub_building_id, 1, n, id FROM r1 WHERE part AND fl IS NOT NULL),
lv AS (SELECT id, name, part FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY late, 'N' || n, o) AS rn FROM lv0) WHERE rn = 1),
sv AS (SELECT id, k, unnest(CASE WHEN k % 2 = 0 THEN ['SB' || k, 'SB' || (k + 1)] WHEN k % 7 = 1 THEN ['SB' || k] ELSE [] END) AS part FROM sy),
vt AS (SELECT DISTINCT under || '-VENTILASJON' AS id, under FROM sy WHERE kind = 'ahu' AND parent IS NULL AND sub_building_id IS NULL),
sp AS (SELECT id AS system, unnest(['RT4' || lpad((k % 100)::VARCHAR, 2, '0'), 'LR' || (10 + k % 80), 'X' || k]) AS code FROM sy),
rp0 AS (SELECT id AS room, k, unnest(['temperature', CASE WHEN sp THEN 'temperature_setpoint' END, CASE WHEN ht THEN 'heating' END, CASE WHEN k % 5 = 0 THEN 'airflow' END, CASE WHEN k % 5 = 0 THEN 'airflow' END]) AS signal, unnest([0, 1, 2, 3, 4]) AS i FROM rm),
rp AS (SELECT room || '_' || signal || CASE WHEN i = 4 THEN '_2' ELSE '' END AS id, room, signal, 'label ' || i || ' ' || k AS label, 'r.csv' AS file, 'Rom ' || k || ' ' || signal AS name FROM rp0 WHERE signal IS NOT NULL),
hz AS (SELECT * FROM zf WHERE kind = 't_triple'), bk AS (SELECT * FROM hz WHERE zone IN (SELECT id FROM rm)), oz AS (SELECT * FROM hz WHERE zone NOT IN (SELECT id FROM rm)),
zp AS (SELECT unnest(['setpoint', 'sensor', 'actuator']) AS role, unnest(['T_Setvalue', 'T_Actualvalue', 'T_Gain']) AS col, unnest(['r', 'y', 'u']) AS sign, unnest(['degC', 'degC', 'percent']) AS unit),
rh AS (SELECT r1.*, coalesce(CASE WHEN k % 10 = 0 THEN 'panel' END, part_heating) AS heating, bk.regime, bk.verdict, bk.confidence, bk.reasoning, bk.tau, bk.flags FROM r1 LEFT JOIN bk ON bk.zone = r1.id),
nodes AS (SELECT 'Site' AS label, 'N' || n_nationkey AS id, n_name AS name, NULL AS kind, {props(label="'N' || n_nationkey")} AS props FROM nation
  UNION ALL SELECT 'Building', 'B-N' || n_nationkey, n_name, NULL, {props(site="'N' || n_nationkey")} FROM nation
  UNION ALL SELECT 'SubBuilding', id, name, NULL, {props(heatingType="heating", heatingSource="hs", heatingConfidence="CASE WHEN hs IS NOT NULL THEN 'verified' END", heatingConflict="CASE WHEN hc THEN 'true' END")} FROM sb
  UNION ALL SELECT 'Level', id, name, NULL, '' FROM lv
  UNION ALL SELECT 'System', id, coalesce(name, id), kind, {props(controller="controller", subsystem="subsystem", description="CASE kind WHEN 'ahu' THEN 'Ventilasjonsaggregat.' || coalesce(' NS-systemnummer ' || subsystem || '.', '') || coalesce(' Styres av undersentral ' || controller || '.', '') WHEN 'heating' THEN CASE WHEN parent IS NOT NULL THEN 'Varmekrets.' ELSE 'Varmeanlegg (NS-system ' || coalesce(subsystem, '') || ').' END WHEN 'device' THEN 'Teknisk enhet lest fra BMS-en.' ELSE 'Teknisk system fra BMS-en.' END")} FROM sy
  UNION ALL SELECT 'System', id, 'Ventilasjon', 'category', '' FROM vt
  UNION ALL SELECT 'Meter', id, name, CASE WHEN parent IS NULL THEN 'main' ELSE 'sub' END, 'description=' || CASE WHEN parent IS NULL THEN 'Hovedmåler for el – toppen av målerhierarkiet.' ELSE 'Undermåler for el – måler en del av forbruket.' END || '|utility=el' FROM mt
  UNION ALL SELECT 'Room', id, 'Rom ' || number, NULL, {props(number="number", bus="bus", floor="floor", plan="plan", hasTemperature="true", hasSetpoint="sp", hasHeating="ht", description="'Rom ' || number || ' med romstyring fra BMS-en. Signaler: Temperatur' || CASE WHEN sp THEN ', Settpunkt temperatur' ELSE '' END || CASE WHEN ht THEN ', Varmepådrag' ELSE '' END || CASE WHEN k % 5 = 0 THEN ', Luftmengde' ELSE '' END || '.'", numberSource="CASE WHEN k % 8 = 0 THEN 'door' END", heatingType="heating", heatingSource="CASE WHEN heating IS NOT NULL THEN CASE WHEN k % 10 = 0 THEN 'visit' ELSE 'Arvet fra bygget (' || sub_building_id || ').' END END", heatingConfidence="CASE WHEN heating IS NOT NULL THEN CASE WHEN k % 10 = 0 THEN 'verified' ELSE 'assumed' END END", dataVerdict="verdict", dataConfidence="confidence", dataReasoning="reasoning", regime="regime", tauMedianMin=TAU, qualityFlags="flags")} FROM rh
  UNION ALL SELECT 'Zone', zone, zone, NULL, {props(building="building", regime="regime", orientation="orientation", winterDutyPct="winter_duty", summerDutyPct="summer_duty", heatingType="verdict", confidence="confidence", reasoning="reasoning", tauMedianMin=TAU, qualityFlags="flags")} FROM oz
  UNION ALL SELECT 'Point', system || '_' || code, code, NULL, {props(label="'label ' || code", file="'f.csv'", description="CASE WHEN code LIKE 'RT4%' THEN 'Temperaturgiver, tilluft/tur (' || code || ').' WHEN code LIKE 'LR%' THEN 'Frekvensomformer (' || code || ').' ELSE 'Signal fra BMS-en (' || code || ').' END")} FROM sp
  UNION ALL SELECT 'Point', id, name, NULL, {props(signal="signal", label="label", file="file")} FROM rp
  UNION ALL SELECT 'Point', zone || '_' || role, role, NULL, {props(column="col", signal="sign", unit="unit", file="'Buildings/' || building || '/Thermal zone/' || zone || '.csv'")} FROM oz, zp),
pl AS (SELECT sy.*, CASE WHEN parent IN (SELECT id FROM sy) THEN {{'t': 'PART_OF', 'l': 'System', 'd': parent}} WHEN sub_building_id IN (SELECT id FROM sb) THEN {{'t': 'LOCATED_IN', 'l': 'SubBuilding', 'd': sub_building_id}} WHEN kind = 'ahu' AND under IN (SELECT under FROM vt) THEN {{'t': 'PART_OF', 'l': 'System', 'd': under || '-VENTILASJON'}} ELSE {{'t': 'PART_OF', 'l': 'Building', 'd': under}} END AS p FROM sy),
zl AS (SELECT zn.* FROM zn JOIN oz USING (zone)),
edges AS (SELECT 'Building' AS src_label, 'B-N' || n_nationkey AS src, 'PART_OF' AS type, 'Site' AS dst_label, 'N' || n_nationkey AS dst, NULL AS source, NULL AS confidence FROM nation
  UNION SELECT 'SubBuilding', id, 'PART_OF', 'Building', under, NULL, NULL FROM sb UNION SELECT 'Level', id, 'PART_OF', 'SubBuilding', part, NULL, NULL FROM lv WHERE part IS NOT NULL UNION SELECT 'System', id, 'PART_OF', 'Building', under, NULL, NULL FROM vt
  UNION SELECT 'System', id, p.t, p.l, p.d, CASE WHEN k % 3 = 1 THEN 'plan' END, CASE WHEN k % 3 = 1 THEN 'high' END FROM pl
  UNION SELECT 'System', id, 'SERVES', 'SubBuilding', part, CASE WHEN k % 4 = 0 THEN 'panel' END, NULL FROM sv WHERE part IN (SELECT id FROM sb)
  UNION SELECT 'System', system, 'HAS_POINT', 'Point', system || '_' || code, NULL, NULL FROM sp UNION SELECT 'Room', room, 'HAS_POINT', 'Point', id, NULL, NULL FROM rp UNION SELECT 'Zone', zone, 'HAS_POINT', 'Point', zone || '_' || role, NULL, NULL FROM oz, zp
  UNION SELECT 'Meter', id, 'SUBMETER_OF', 'Meter', parent, NULL, NULL FROM mt WHERE parent IS NOT NULL UNION SELECT 'Meter', id, 'METERS', 'Building', under, NULL, NULL FROM mt WHERE parent IS NULL
  UNION SELECT 'Room', id, 'LOCATED_IN', CASE WHEN part AND fl IS NOT NULL THEN 'Level' WHEN part THEN 'SubBuilding' ELSE 'Building' END, CASE WHEN part AND fl IS NOT NULL THEN sub_building_id || '-PLAN' || fl WHEN part THEN sub_building_id ELSE under END, NULL, NULL FROM r1
  UNION SELECT 'Zone', zone, 'LOCATED_IN', CASE WHEN level_id IS NOT NULL THEN 'Level' WHEN sub_building_id IS NOT NULL THEN 'SubBuilding' ELSE 'Building' END, coalesce(level_id, sub_building_id, building_node), CASE WHEN k % 6 <> 0 AND k % 3 < 2 THEN 'drawing' END, CASE WHEN k % 6 <> 0 AND k % 3 < 2 THEN 'high' END FROM zl WHERE coalesce(level_id, sub_building_id, building_node) IS NOT NULL
  UNION SELECT 'Zone', zone, 'MEASURED_BY', 'Meter', meter_id, NULL, NULL FROM zl WHERE meter_id IS NOT NULL)"""
Z = IRI.format(x="zone")
SQL = {
    "grf06_spatial_triples": VIEWS + f""", z AS (SELECT 'N' || n AS g, 'B-N' || n AS b, zone, level_id, level_label, sub_building_id AS part, sub_building_label AS part_label FROM zn),
ids AS (SELECT 'N' || n_nationkey AS g, 'N' || n_nationkey AS id, 'Site' AS kind, 'N' || n_nationkey AS label, NULL AS up FROM nation
  UNION ALL SELECT 'N' || n_nationkey, 'B-N' || n_nationkey, 'Building', CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'B-N' || n_nationkey END, 'N' || n_nationkey FROM nation
  UNION ALL SELECT g, part, 'SubBuilding', coalesce(arg_min({{'x': part_label}}, zone).x, part), any_value(b) FROM z WHERE part IS NOT NULL GROUP BY g, part
  UNION ALL SELECT g, level_id, 'Level', coalesce(arg_min({{'x': level_label}}, zone).x, level_id), arg_min({{'x': part}}, zone).x FROM z WHERE level_id IS NOT NULL GROUP BY g, level_id
  UNION ALL SELECT g, zone, 'Zone', zone, level_id FROM z),
n AS (SELECT g AS graph, {IRI.format(x="id")} AS s, kind, label, {IRI.format(x="up")} AS up FROM ids)
SELECT graph, s, 'a' AS p, kind AS o FROM n UNION SELECT graph, s, 'label', label FROM n UNION SELECT graph, s, 'isPartOf', up FROM n WHERE up IS NOT NULL""",
    "grf07_zone_triples": VIEWS + f""", t AS (SELECT *, {Z} AS s, zone IN (SELECT zone FROM zn WHERE 'N' || n = hz.building) AS placed FROM hz),
pt AS (SELECT building AS graph, zone, s, s || '_' || role AS pt, w.kind AS kind, w.col AS col FROM t, (VALUES ('sensor', 'Temperature_Sensor', 'T_Actualvalue'), ('setpoint', 'Temperature_Setpoint', 'T_Setvalue'), ('actuator', 'Valve_Position_Command', 'T_Gain')) w(role, kind, col))
SELECT graph, pt AS s, 'a' AS p, kind AS o FROM pt UNION SELECT graph, pt, 'isPointOf', s FROM pt UNION SELECT graph, pt, 'timeseries', 'urn:ts:' || pt FROM pt UNION SELECT graph, 'urn:ts:' || pt, 'hasTimeseriesId', col FROM pt UNION SELECT graph, 'urn:ts:' || pt, 'storedAt', 'Thermal zone/' || zone || '.csv' FROM pt
UNION SELECT building, s, 'a', 'Zone' FROM t WHERE NOT placed UNION SELECT building, s, 'label', zone FROM t WHERE NOT placed UNION SELECT building, s, 'locationMissing', 'true' FROM t WHERE NOT placed UNION SELECT building, s, 'qualityFlag', unnest(string_split(flags, ',')) FROM t WHERE flags IS NOT NULL
""" + " ".join(f"UNION SELECT building, s, '{p}', ({v})::VARCHAR FROM t WHERE ({v}) IS NOT NULL" for p, v in (("gainRegime", "regime"), ("orientation", "orientation"), ("winterDutyPct", "winter_duty"), ("summerDutyPct", "summer_duty"), ("heatingType", "verdict"), ("heatingTypeConfidence", "confidence"), ("heatingTypeReasoning", "reasoning"), ("tauMedianMin", TAU))),
    "grf08_nodes": VIEWS + " SELECT * FROM nodes",
    "grf09_edges": VIEWS + " SELECT * FROM edges",
    "grf10_room_heating": VIEWS + f" SELECT * FROM nodes WHERE {ROOM_HEAT}",
    "grf11_synthetic_nodes": VIEWS + f" SELECT * FROM nodes WHERE {MADE}",
    "grf12_backed_rooms": VIEWS + f" SELECT * FROM nodes WHERE {BACKED}",
    "grf13_rooms_by_level": VIEWS + " SELECT lv.part, lv.id AS level, count(*) AS rooms, count(rh.heating) AS heated FROM rh JOIN lv ON lv.id = rh.sub_building_id || '-PLAN' || rh.fl WHERE rh.part GROUP BY 1, 2",
    "grf13_served_parts": VIEWS + " SELECT dst AS part, count(*) AS systems, count(source) AS sourced FROM edges WHERE type = 'SERVES' GROUP BY 1",
    "grf13_submeters": VIEWS + " SELECT dst AS meter, count(*) AS submeters FROM edges WHERE type = 'SUBMETER_OF' GROUP BY 1",
    "grf13_heating_conflicts": VIEWS + f" SELECT * FROM nodes WHERE {CONFLICT}",
    "grf13_assumed_rooms": VIEWS + f" SELECT * FROM nodes WHERE {ASSUMED}",
    "grf13_rooms_without_heating": VIEWS + f" SELECT * FROM nodes WHERE {UNHEATED}",
    "grf13_flagged_rooms": VIEWS + f" SELECT * FROM nodes WHERE {FLAGGED}",
    "jon18_index_references": VIEWS + " SELECT 'system.sub_building' AS kind, id AS src, sub_building_id AS dst FROM sy WHERE sub_building_id NOT IN (SELECT id FROM sb0) UNION ALL SELECT 'system.serves', id, part FROM sv WHERE part NOT IN (SELECT id FROM sb0) UNION ALL SELECT 'room.sub_building', id, sub_building_id FROM rm WHERE sub_building_id NOT IN (SELECT id FROM sb0) UNION ALL SELECT 'system.parent', id, parent FROM sy WHERE parent NOT IN (SELECT id FROM sy) UNION ALL SELECT 'meter.parent', id, parent FROM mt WHERE parent NOT IN (SELECT id FROM mt)",
    "jon23_placement": VIEWS + f" SELECT * FROM edges WHERE {PLACED}",
    "win11_room_points": VIEWS + " SELECT * FROM rp",
    "scl18_descriptions": VIEWS + " SELECT * FROM nodes WHERE props LIKE '%description=%'",
}
