"""Queries of scoring and graphs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as gr
from ..operators import scoring as sc
from . import labels as pl
from .series import rounded
from .views import table


def outputs(spark, d):
    return pl.flat(pl.decoded(spark, d)).withColumn("source_type", F.lit("bacnet"))


def gold(spark, d):
    """Gold records: the decoded ones with some fields changed, emptied or filled by the label's length; some labels missing."""
    n = F.length("raw_label")
    out = outputs(spark, d).where(n % 11 != 0)
    return out.withColumns({"function": F.when(n % 3 == 0, F.upper("function")).when(n % 3 == 1, F.lit("annet")).otherwise(F.col("function")), "carrier": F.when(n % 2 == 0, F.coalesce("carrier", F.lit("vann"))).otherwise(F.col("carrier")), "system_code": F.when(n % 4 == 0, F.substring("system_code", 1, 3)).otherwise(F.col("system_code")), "zone": F.when(n % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("zone"))})


BASE = pl.BASE + """, ou AS (SELECT * FROM dr), go AS (SELECT * REPLACE (CASE len(raw_label) % 3 WHEN 0 THEN upper(function) WHEN 1 THEN 'annet' ELSE function END AS function, CASE WHEN len(raw_label) % 2 = 0 THEN coalesce(carrier, 'vann') ELSE carrier END AS carrier,
  CASE WHEN len(raw_label) % 4 = 0 THEN substr(system_code, 1, 3) ELSE system_code END AS system_code, CASE WHEN len(raw_label) % 5 = 0 THEN NULL ELSE zone END AS zone) FROM dr WHERE len(raw_label) % 11 <> 0)"""


def _verdict_sql(f: str, kind: str) -> str:
    norm = lambda c: f"trim(regexp_replace(lower({c}), '\\s+', ' ', 'g'))"
    pre = lambda c: f"nullif(substr(regexp_extract(trim({c}), '^\\d+'), 1, 3), '')"
    eq = {"enum": f"trim(g.{f}) = trim(o.{f})", "text": f"{norm(f'g.{f}')} = {norm(f'o.{f}')}", "code": f"coalesce({pre(f'g.{f}')} = {pre(f'o.{f}')}, trim(g.{f}) = trim(o.{f}))", "bool": f"g.{f} = o.{f}"}[kind]
    return f"SELECT raw_label, '{f}' AS field, CASE WHEN g.{f} IS NULL AND o.{f} IS NULL THEN 'CORRECT' WHEN o.{f} IS NULL THEN 'UNDER_FILL' WHEN g.{f} IS NULL THEN 'OVER_FILL' WHEN {eq} THEN 'CORRECT' ELSE 'WRONG_VALUE' END AS verdict, g.{f} IS NOT NULL AS gold_set FROM go g JOIN ou o USING (raw_label)"


VERDICTS = ", fv AS (" + " UNION ALL ".join(_verdict_sql(f, k) for f, k in sc.FIELDS.items()) + ")"
CORE = ", ".join(f"'{c}'" for c in sc.CORE)
ROWS = VERDICTS + f", ex AS (SELECT raw_label, bool_and(verdict = 'CORRECT') AS exact, bool_and(verdict = 'CORRECT' OR field NOT IN ({CORE})) AS core_exact FROM fv GROUP BY 1), cx AS (SELECT ex.*, confidence, least(floor(confidence * 5), 4)::INT AS bin, exact::INT AS y FROM ex JOIN ou USING (raw_label))"


def verdicts(spark, d):
    return sc.field_verdicts(gold(spark, d), outputs(spark, d))


def jon10(spark, d):
    return sc.align(gold(spark, d), outputs(spark, d).where(F.length("raw_label") % 13 != 0))


def jon11(spark, d):
    o = outputs(spark, d).withColumn("raw_label", F.when(F.length("raw_label") % 7 == 0, F.upper("raw_label")).otherwise(F.col("raw_label")))
    return sc.near_misses(gold(spark, d), o)


def agg26(spark, d):
    return rounded(sc.field_accuracy(verdicts(spark, d)), "accuracy", "nontrivial")


def agg27(spark, d):
    return rounded(sc.exact_rates(sc.row_exact(verdicts(spark, d))), "exact_rate", "core_rate")


def scored(spark, d):
    return sc.row_exact(verdicts(spark, d)).join(outputs(spark, d).select("raw_label", "confidence"), "raw_label")


def agg28(spark, d):
    return rounded(sc.calibration(scored(spark, d)), "accuracy", "mean_confidence", "low", "high")


def agg28_scores(spark, d):
    return rounded(sc.calibration_scores(scored(spark, d)), "brier", "ece")


def agg30(spark, d):
    return rounded(sc.weakest(sc.field_accuracy(verdicts(spark, d))), "accuracy", "nontrivial")


def agg31(spark, d):
    return rounded(sc.fill_rates(outputs(spark, d)), "fill_rate")


def scl20(spark, d):
    """Contract violations of records of which some break it."""
    n = F.length("raw_label")
    rows = outputs(spark, d).withColumns({"carrier": F.when(n % 6 == 0, "steam").otherwise(F.col("carrier")), "confidence": F.when(n % 5 == 0, 1.5).otherwise(F.col("confidence"))})
    return sc.contract(rows).select("raw_label", F.array_join(F.transform("violations", lambda v: F.concat_ws(":", v["location"], v["message"])), ",").alias("violations"))


def facts(spark, d):
    return gr.point_facts(outputs(spark, d))


def grf01(spark, d):
    return gr.point_triples(facts(spark, d))


IRI = "CASE WHEN regexp_replace({x}, '[^A-Za-z0-9_.-]', '_', 'g') = {x} THEN {x} ELSE regexp_replace({x}, '[^A-Za-z0-9_.-]', '_', 'g') || '_' || substr(sha1({x}), 1, 6) END"
CLASS_SQL = "CASE " + " ".join("WHEN " + " AND ".join(x for x in (says and f"contains(lower(coalesce(function, '')), '{says}')", q and f"measurement_type = '{q}'", let and f"starts_with(component, '{let}')") if x) + f" THEN '{name}'" for says, q, let, name in gr.POINT_RULES) + " ELSE 'Point' END"
FACTS = pl.BASE + f""", pf AS (SELECT *, substr(sha1(raw_label), 1, 12) AS point, {CLASS_SQL} AS class, CASE unit WHEN '°C' THEN 'DEG_C' WHEN 'ppm' THEN 'PPM' WHEN 'kWh' THEN 'KiloW-HR' WHEN 'Pa' THEN 'PA' END AS unit_name, coalesce(building, 'site') AS graph,
  (SELECT substr(list_filter(t.kl, lambda k: starts_with(k, 'same_equipment=') AND k <> 'same_equipment=' || coalesce(ltrim(t.point_token, '-'), ''))[1], 16) FROM tk t WHERE t.raw_label = dr.raw_label) AS equipment FROM dr),
pa AS (SELECT *, CASE WHEN equipment IS NOT NULL THEN 'isPointOf' ELSE 'hasPoint' END AS p, CASE WHEN equipment IS NOT NULL THEN 'equipment/' || {IRI.format(x="equipment")} WHEN system_code IS NOT NULL THEN 'system/' || system_code WHEN building IS NOT NULL THEN 'building/' || {IRI.format(x="building")} ELSE 'site' END AS anchor FROM pf),
tr AS (SELECT graph, 'point/' || point AS s, 'a' AS p, class AS o FROM pa UNION SELECT graph, 'point/' || point, 'label', raw_label FROM pa UNION SELECT graph, 'point/' || point, 'hasUnit', unit_name FROM pa WHERE unit_name IS NOT NULL
  UNION SELECT graph, CASE WHEN p = 'isPointOf' THEN 'point/' || point ELSE anchor END, p, CASE WHEN p = 'isPointOf' THEN anchor ELSE 'point/' || point END FROM pa)"""


def grf05(spark, d):
    f = facts(spark, d)
    return gr.graph_counts(f, gr.point_triples(f))


def agg33(spark, d):
    return gr.equipment_evidence(facts(spark, d))


def agg32(spark, d):
    return gr.readiness(facts(spark, d))


def snk03(spark, d):
    return gr.triple_lines(gr.point_triples(facts(spark, d)))


def hierarchy(spark, d):
    """Orders in customers in nations in regions, as nodes and PART_OF edges."""
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    key = lambda k, col: F.concat(F.lit(k), F.col(col).cast("string"))
    nodes = o.select(F.lit("Order").alias("label"), key("o", "o_orderkey").alias("id")).unionByName(c.select(F.lit("Customer").alias("label"), key("c", "c_custkey").alias("id"))).unionByName(n.select(F.lit("Nation").alias("label"), key("n", "n_nationkey").alias("id"))).unionByName(r.select(F.lit("Region").alias("label"), key("r", "r_regionkey").alias("id")))
    edges = o.select(key("o", "o_orderkey").alias("src"), key("c", "o_custkey").alias("dst")).unionByName(c.select(key("c", "c_custkey").alias("src"), key("n", "c_nationkey").alias("dst"))).unionByName(n.select(key("n", "n_nationkey").alias("src"), key("r", "n_regionkey").alias("dst")))
    return nodes, edges.withColumn("type", F.lit("PART_OF"))


HIER = """nd AS (SELECT 'Order' AS label, 'o' || o_orderkey AS id FROM orders UNION ALL SELECT 'Customer', 'c' || c_custkey FROM customer UNION ALL SELECT 'Nation', 'n' || n_nationkey FROM nation UNION ALL SELECT 'Region', 'r' || r_regionkey FROM region),
ed AS (SELECT 'o' || o_orderkey AS src, 'c' || o_custkey AS dst FROM orders UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation)"""


def grf14(spark, d):
    nodes, edges = hierarchy(spark, d)
    return gr.part_of(edges, nodes.where("label = 'Order'"))


def jon18(spark, d):
    nodes, edges = hierarchy(spark, d)
    return gr.dangling(edges.select(F.lit("parent").alias("kind"), "src", "dst"), nodes.where("label <> 'Customer' or substring(id, -1, 1) <> '7'")).groupBy("kind", "dst").agg(F.count("*").alias("n"))


def grf13(spark, d):
    nodes, edges = hierarchy(spark, d)
    return gr.counts_by_label(nodes, edges)


def grf13_served(spark, d):
    """How many orders each region holds over three hops, largest first."""
    nodes, edges = hierarchy(spark, d)
    return gr.part_of(edges, nodes.where("label = 'Order'"), 3).where("hops = 3").groupBy("ancestor").agg(F.count_distinct("id").alias("orders"))


def jon17(spark, d):
    """Customers with and without orders: the facts of the first go to the node that has both, the others' to their own."""
    nodes, edges = hierarchy(spark, d)
    c = nodes.where("label = 'Customer'")
    held = edges.where("src like 'o%'").select(F.col("dst").alias("id")).distinct()
    return c.join(held, "id", "left_semi").withColumn("kind", F.lit("backed")).unionByName(c.join(held, "id", "left_anti").withColumn("kind", F.lit("alone")))


QUERIES = {
    "jon10_alignment": jon10,
    "jon11_near_misses": jon11,
    "chk11_field_verdicts": verdicts,
    "agg26_field_accuracy": agg26,
    "agg27_exact_rates": agg27,
    "agg28_calibration": agg28,
    "agg28_brier_ece": agg28_scores,
    "agg30_weakest_fields": agg30,
    "agg31_fill_rates": agg31,
    "scl20_contract": scl20,
    "grf01_point_triples": grf01,
    "grf05_graph_counts": grf05,
    "agg32_graph_readiness": agg32,
    "agg33_equipment_evidence": agg33,
    "snk03_triple_lines": snk03,
    "grf14_containment": grf14,
    "grf13_label_counts": grf13,
    "grf13_served_by": grf13_served,
    "jon17_backed_nodes": jon17,
    "jon18_dangling": jon18,
}
ACC = VERDICTS + ", fa AS (SELECT field, round(avg((verdict = 'CORRECT')::INT), 6) AS accuracy, round(avg((verdict = 'CORRECT')::INT) FILTER (gold_set), 6) AS nontrivial, count(*) FILTER (verdict = 'UNDER_FILL') AS under_fill, count(*) FILTER (verdict = 'OVER_FILL') AS over_fill, count(*) FILTER (verdict = 'WRONG_VALUE') AS wrong_value, count(*) AS n FROM fv GROUP BY 1)"
PCT = "round(100 * avg(({x})::INT), 1)"
SQL = {
    "jon10_alignment": BASE + " SELECT raw_label, CASE WHEN o.raw_label IS NULL THEN 'missing' WHEN g.raw_label IS NULL THEN 'extra' ELSE 'matched' END AS alignment, false AS gold_repeats, false AS outputs_repeat FROM go g FULL JOIN (SELECT * FROM ou WHERE len(raw_label) % 13 <> 0) o USING (raw_label)",
    "jon11_near_misses": BASE + ", u AS (SELECT DISTINCT CASE WHEN len(raw_label) % 7 = 0 THEN upper(raw_label) ELSE raw_label END AS raw_label FROM ou) SELECT u.raw_label, g.raw_label AS gold_label FROM u JOIN go g ON lower(u.raw_label) = lower(g.raw_label) WHERE u.raw_label NOT IN (SELECT raw_label FROM go)",
    "chk11_field_verdicts": BASE + VERDICTS + " SELECT * FROM fv",
    "agg26_field_accuracy": BASE + ACC + " SELECT * FROM fa",
    "agg27_exact_rates": BASE + ROWS + " SELECT count(*) AS n, round(avg(exact::INT), 6) AS exact_rate, round(avg(core_exact::INT), 6) AS core_rate FROM ex",
    "agg28_calibration": BASE + ROWS + " SELECT bin, n, round(p, 6) AS accuracy, round(mc, 6) AS mean_confidence, round(greatest(0, (p + 1.9208 / n) / (1 + 3.8416 / n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n)), 6) AS low, round(least(1, (p + 1.9208 / n) / (1 + 3.8416 / n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n)), 6) AS high FROM (SELECT bin, count(*) AS n, avg(y) AS p, avg(confidence) AS mc FROM cx GROUP BY 1)",
    "agg28_brier_ece": BASE + ROWS + " SELECT round(sum(s) / sum(n), 6) AS brier, round(sum(g * n) / sum(n), 6) AS ece, sum(n)::BIGINT AS n FROM (SELECT bin, count(*) AS n, sum((confidence - y) ** 2) AS s, abs(avg(y) - avg(confidence)) AS g FROM cx GROUP BY 1)",
    "agg30_weakest_fields": BASE + ACC + " SELECT * FROM fa WHERE nontrivial < 1 ORDER BY nontrivial, field LIMIT 3",
    "agg31_fill_rates": pl.BASE + " SELECT field, round(avg(s), 6) AS fill_rate, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS field, ({f} IS NOT NULL)::INT AS s FROM dr" for f in sc.FIELDS) + ") GROUP BY 1",
    "scl20_contract": pl.BASE + " SELECT raw_label, concat_ws(',', CASE WHEN len(raw_label) % 6 = 0 THEN 'carrier:not in enum' END, CASE WHEN len(raw_label) % 5 = 0 THEN 'confidence:out of range' END) AS violations FROM dr",
    "grf01_point_triples": FACTS + " SELECT * FROM tr",
    "grf05_graph_counts": FACTS + " SELECT graph, count(DISTINCT point) AS points, count(DISTINCT equipment) AS equipment, count(DISTINCT system_code) AS systems, any_value(n) AS triples FROM pf JOIN (SELECT graph, count(*) AS n FROM tr GROUP BY 1) USING (graph) GROUP BY 1",
    "agg32_graph_readiness": FACTS + f" SELECT graph, count(*) AS points, {PCT.format(x='class <> ' + chr(39) + 'Point' + chr(39))} AS typed, {PCT.format(x='equipment IS NOT NULL')} AS anchored, {PCT.format(x='building IS NOT NULL')} AS placed, {PCT.format(x='system_code IS NOT NULL')} AS in_system, {PCT.format(x='unit_name IS NOT NULL')} AS with_unit FROM pf GROUP BY 1",
    "agg33_equipment_evidence": FACTS + " SELECT equipment, count(*) AS points, CASE WHEN count(DISTINCT coalesce(building, '∅')) = 1 THEN any_value(building) END AS building, CASE WHEN count(DISTINCT coalesce(system_code, '∅')) = 1 THEN any_value(system_code) END AS system_code, coalesce(CASE regexp_extract(equipment, '^([A-Z]{2})\\d', 1) WHEN 'LR' THEN 'Variable_Frequency_Drive' WHEN 'JP' THEN 'Pump' WHEN 'JV' THEN 'Fan' WHEN 'SB' THEN 'Valve' WHEN 'IK' THEN 'Equipment' END, CASE WHEN contains(lower(equipment), 'pumpe') THEN 'Pump' END, 'Equipment') AS class FROM pf WHERE equipment IS NOT NULL GROUP BY 1",
    "snk03_triple_lines": FACTS + " SELECT graph, '<urn:points:' || s || '> <urn:points:' || p || '> ' || CASE WHEN p = 'label' THEN '\"' || o || '\"' ELSE '<urn:points:' || o || '>' END || ' .' AS value FROM tr",
    "grf14_containment": f"WITH {HIER} SELECT a.src AS id, a.dst AS ancestor, 1 AS hops FROM ed a WHERE a.src LIKE 'o%' UNION ALL SELECT a.src, b.dst, 2 FROM ed a JOIN ed b ON a.dst = b.src WHERE a.src LIKE 'o%' UNION ALL SELECT a.src, c.dst, 3 FROM ed a JOIN ed b ON a.dst = b.src JOIN ed c ON b.dst = c.src WHERE a.src LIKE 'o%'",
    "grf13_label_counts": f"WITH {HIER} SELECT label AS name, count(DISTINCT id) AS n, 'node' AS what FROM nd GROUP BY 1 UNION ALL SELECT 'PART_OF', count(*), 'edge' FROM ed",
    "grf13_served_by": f"WITH {HIER} SELECT c.dst AS ancestor, count(DISTINCT a.src) AS orders FROM ed a JOIN ed b ON a.dst = b.src JOIN ed c ON b.dst = c.src WHERE a.src LIKE 'o%' GROUP BY 1",
    "jon17_backed_nodes": f"WITH {HIER} SELECT label, id, CASE WHEN id IN (SELECT dst FROM ed WHERE src LIKE 'o%') THEN 'backed' ELSE 'alone' END AS kind FROM nd WHERE label = 'Customer'",
    "jon18_dangling": f"WITH {HIER} SELECT 'parent' AS kind, dst, count(*) AS n FROM ed WHERE dst NOT IN (SELECT id FROM nd WHERE label <> 'Customer' OR right(id, 1) <> '7') GROUP BY 2",
}
