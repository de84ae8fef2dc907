"""Decoded points and building hierarchies as triples and property-graph tables, and queries over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as lb

# Classes of points in the order tried, of equipment letters and of systems, and unit names.
POINT_RULES = (
    ("settpunkt", "temperatur", None, "Temperature_Setpoint"),
    ("settpunkt", None, None, "Setpoint"),
    ("grenseverdi", None, None, "Limit"),
    ("alarm", None, None, "Alarm"),
    (None, "kommando", None, "Command"),
    (None, "status", None, "Status"),
    (None, "trykk", "RD", "Differential_Pressure_Sensor"),
    (None, "temperatur", None, "Temperature_Sensor"),
    (None, "trykk", None, "Pressure_Sensor"),
    (None, "co2", None, "CO2_Sensor"),
    (None, "volum", None, "Flow_Sensor"),
    (None, "energi", None, "Energy_Sensor"),
    (None, "effekt", None, "Power_Sensor"),
)
EQUIPMENT_CLASS = {"LR": "Variable_Frequency_Drive", "JP": "Pump", "JV": "Fan", "SB": "Valve", "IK": "Equipment"}
SYSTEM_CLASS = {"31": "Water_System", "32": "Hot_Water_System", "36": "Ventilation_Air_System", "37": "Chilled_Water_System", "43": "Electrical_System"}
UNIT = {"°C": "DEG_C", "ppm": "PPM", "kWh": "KiloW-HR", "Pa": "PA"}


def choose(table: dict[str, str], key: Column, default: str | None = None) -> Column:
    out = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]
    return F.coalesce(out, F.lit(default)) if default else out


def point_class() -> Column:
    out = None
    for says, quantity, letters, name in POINT_RULES:
        on = F.lit(True)
        if says:
            on = on & (F.instr(F.lower(F.coalesce("function", F.lit(""))), says) > 0)
        if quantity:
            on = on & F.coalesce(F.col("measurement_type") == quantity, F.lit(False))
        if letters:
            on = on & F.coalesce(F.col("component").startswith(letters), F.lit(False))
        out = F.when(on, name) if out is None else out.when(on, name)
    return out.otherwise("Point")


def point_facts(decoded: DataFrame) -> DataFrame:
    """A row per decoded point with its class, unit, graph and the node it hangs on (equipment, else system, else building, else site)."""
    x = F.col("raw_label")
    d = decoded.withColumns({"point": lb.point_id(x), "class": point_class(), "unit_name": choose(UNIT, F.col("unit")), "keys": lb.group_keys(x, lb.segments(x)), "graph": F.coalesce("building", F.lit("site"))})
    # a bare code names the point itself, not a device that it belongs to
    d = d.withColumn("_own", F.coalesce(F.ltrim(lb.point_token(lb.segments(x))["token"], F.lit("-")), F.lit("")))
    gear = F.get(F.filter("keys", lambda k: (k["kind"] == "same_equipment") & (k["key"] != F.col("_own"))), F.lit(0))["key"]
    d = d.withColumn("equipment", gear).drop("_own")
    anchor = F.coalesce(
        F.when(F.col("equipment").isNotNull(), F.struct(F.lit("isPointOf").alias("p"), F.concat(F.lit("equipment/"), lb.iri_name(F.col("equipment"))).alias("o"))),
        F.when(F.col("system_code").isNotNull(), F.struct(F.lit("hasPoint").alias("p"), F.concat(F.lit("system/"), F.col("system_code")).alias("o"))),
        F.when(F.col("building").isNotNull(), F.struct(F.lit("hasPoint").alias("p"), F.concat(F.lit("building/"), lb.iri_name(F.col("building"))).alias("o"))),
        F.struct(F.lit("hasPoint").alias("p"), F.lit("site").alias("o")),
    )
    return d.withColumn("anchor", anchor)


def point_triples(facts: DataFrame) -> DataFrame:
    """``(graph, s, p, o)``, a set."""
    t = lambda s, p, o: F.struct(s.alias("s"), F.lit(p).alias("p") if isinstance(p, str) else p.alias("p"), o.alias("o"))
    point, a = F.concat(F.lit("point/"), F.col("point")), F.col("anchor")
    forward = a["p"] == "isPointOf"
    link = F.struct(F.when(forward, point).otherwise(a["o"]).alias("s"), a["p"].alias("p"), F.when(forward, a["o"]).otherwise(point).alias("o"))
    rows = F.array_compact(F.array(t(point, "a", F.col("class")), t(point, "label", F.col("raw_label")), F.when(F.col("unit_name").isNotNull(), t(point, "hasUnit", F.col("unit_name"))), link))
    return facts.select("graph", F.explode(rows).alias("t")).select("graph", "t.*").distinct()


def triple_lines(triples: DataFrame, base: str = "urn:points:") -> DataFrame:
    """N-Triples lines by graph, ready for a partitioned text sink."""
    iri = lambda c: F.concat(F.lit(f"<{base}"), F.col(c), F.lit(">"))
    text = F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace("o", r"\\", r"\\\\"), '"', '\\\\\\"'), F.lit('"'))
    return triples.select("graph", F.concat_ws(" ", iri("s"), iri("p"), F.when(F.col("p") == "label", text).otherwise(iri("o")), F.lit(".")).alias("value"))


def equipment_evidence(facts: DataFrame) -> DataFrame:
    """Per equipment: its class, and its building and system where all its points agree on one (unknown is a value)."""
    rows = facts.where("equipment is not null").select("equipment", F.coalesce("building", F.lit("∅")).alias("b"), F.coalesce("system_code", F.lit("∅")).alias("s"))
    out = rows.groupBy("equipment").agg(F.count("*").alias("points"), F.min("b").alias("b0"), F.max("b").alias("b1"), F.min("s").alias("s0"), F.max("s").alias("s1"))
    one = lambda lo, hi: F.when((F.col(lo) == F.col(hi)) & (F.col(lo) != "∅"), F.col(lo))
    kind = F.coalesce(choose(EQUIPMENT_CLASS, F.regexp_extract("equipment", r"^([A-Z]{2})\d", 1)), F.when(F.lower("equipment").contains("pumpe"), "Pump"), F.lit("Equipment"))
    return out.select("equipment", "points", one("b0", "b1").alias("building"), one("s0", "s1").alias("system_code"), kind.alias("class"))


def node_triples(facts: DataFrame) -> DataFrame:
    """``(graph, s, p, o)`` of the systems and equipment that points name, by graph of the point.

    A system (the digits of a label's system token) has a class by the first two digits of its code, which is the decoded
    one or else the token's first three digits and a zero, and a label. Equipment has its class and name; it has a location,
    and is part of a system, only where all its points, over all graphs, say the same one.
    """
    rows = facts.withColumn("digits", lb.group(lb.first_of(lb.segments(F.col("raw_label")), lb.SYSTEM_TOKEN), lb.SYSTEM_TOKEN, 1))
    t = lambda s, p, o: F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"))
    code = F.coalesce("system_code", F.concat(F.substring("digits", 1, 3), F.lit("0")))
    system = F.concat(F.lit("system/"), F.col("digits"))
    name = F.concat_ws(" ", F.lit("NS"), code, *([F.col("system_name")] if "system_name" in facts.columns else []), F.concat(F.lit("(token "), F.col("digits"), F.lit(")")))
    systems = rows.where("digits is not null").select("graph", F.explode(F.array(t(system, "a", choose(SYSTEM_CLASS, F.substring(code, 1, 2), "System")), t(system, "label", name))).alias("t"))
    gear = rows.where("equipment is not null")
    say = lambda c: F.coalesce(F.col(c), F.lit(""))
    one = lambda c: F.when(F.min(say(c)) == F.max(say(c)), F.nullif(F.max(say(c)), F.lit("")))
    said = gear.groupBy("equipment").agg(one("building").alias("b"), one("digits").alias("d"))
    kind = F.coalesce(choose(EQUIPMENT_CLASS, F.regexp_extract("equipment", r"^([A-Z]{2})\d", 1)), F.when(F.lower("equipment").contains("pumpe"), "Pump"), F.lit("Equipment"))
    node = F.concat(F.lit("equipment/"), lb.iri_name(F.col("equipment")))
    cells = F.array(t(node, "a", kind), t(node, "label", F.col("equipment")), t(node, "hasLocation", F.concat(F.lit("building/"), lb.iri_name(F.col("b")))), t(F.concat(F.lit("system/"), F.col("d")), "hasPart", node))
    parts = gear.select("graph", "equipment").distinct().join(said, "equipment").select("graph", F.explode(cells).alias("t"))
    return systems.unionByName(parts).select("graph", "t.*").where("s is not null and o is not null").distinct()


def graph_counts(facts: DataFrame, triples: DataFrame) -> DataFrame:
    counts = facts.groupBy("graph").agg(F.count_distinct("point").alias("points"), F.count_distinct("equipment").alias("equipment"), F.count_distinct("system_code").alias("systems"))
    return counts.join(triples.groupBy("graph").agg(F.count("*").alias("triples")), "graph", "left")


def readiness(facts: DataFrame) -> DataFrame:
    """Shares of points that are typed, anchored to equipment, placed, in a system and with a unit, in percent."""
    pct = lambda on: F.round(100 * F.avg(on.cast("int")), 1)
    return facts.groupBy("graph").agg(F.count("*").alias("points"), pct(F.col("class") != "Point").alias("typed"), pct(F.col("equipment").isNotNull()).alias("anchored"), pct(F.col("building").isNotNull()).alias("placed"), pct(F.col("system_code").isNotNull()).alias("in_system"), pct(F.col("unit_name").isNotNull()).alias("with_unit"))


def class_counts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("class").agg(F.count("*").alias("n"))


def family_gaps(facts: DataFrame, gaps: Column) -> DataFrame:
    """Label families with their untyped points and readiness gaps, the worst first."""
    rows = facts.select(lb.signature(F.col("raw_label")).alias("family"), (F.col("class") == "Point").alias("untyped"), gaps.alias("gaps"))
    has = lambda g: F.count_if(F.array_contains("gaps", g)).alias(f"no_{g}")
    names = ("primary_system", "point_semantics", "building", "low_confidence")
    out = rows.groupBy("family").agg(F.count("*").alias("n"), F.count_if("untyped").alias("untyped"), *[has(g) for g in names])
    return out.withColumn("gaps", F.col("untyped") + sum(F.col(f"no_{g}") for g in names)).orderBy(F.desc("gaps"), "family")


def part_of(edges: DataFrame, start: DataFrame, depth: int = 4) -> DataFrame:
    """Ancestors of ``start(id)`` over ``edges(src, dst)`` up to ``depth`` hops: ``(id, ancestor, hops)``; the hierarchy is bounded."""
    e = edges.select(F.col("src").alias("_s"), F.col("dst").alias("_d"))
    step = start.select("id", F.col("id").alias("ancestor"))
    out = None
    for hop in range(1, depth + 1):
        step = step.join(e, step["ancestor"] == e["_s"]).select("id", F.col("_d").alias("ancestor"))
        found = step.withColumn("hops", F.lit(hop))
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def dangling(references: DataFrame, nodes: DataFrame) -> DataFrame:
    """``references(kind, src, dst)`` whose target is no node."""
    return references.where("dst is not null").join(nodes.select(F.col("id").alias("dst")).distinct(), "dst", "left_anti")


def counts_by_label(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = nodes.groupBy(F.col("label").alias("name")).agg(F.count_distinct("id").alias("n")).withColumn("what", F.lit("node"))
    e = edges.groupBy(F.col("type").alias("name")).agg(F.count("*").alias("n")).withColumn("what", F.lit("edge"))
    return n.unionByName(e)
