"""Queries that test decoded labels against their series, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as lb
from ..operators import checks as ck
from ..operators import decode as dc
from ..operators import series as op
from . import labels as pl
from .series import LAST, PEARSON_SQL, REFERENCE, STATS_SQL, reference, rounded
from .views import POINTS, points


def decoded(spark, d):
    """The labels of the point series, decoded; some get a quantity or object type that their data may refute."""
    p = points(spark, d).select("raw_label", F.lit("bacnet").alias("source_type")).distinct()
    n = F.length("raw_label") + F.ascii(F.substring("raw_label", -5, 1))
    out = dc.decode_rules(p, pl.COMPONENTS, pl.SYSTEMS, pl.AREAS).persist()
    quantity = F.when(n % 7 == 0, "energi").when(n % 7 == 1, "status").when(n % 7 == 2, "co2").otherwise(F.col("measurement_type"))
    return out.withColumns({"measurement_type": quantity, "object_type": F.when(n % 5 == 0, "BI").when(n % 5 == 1, "AI").when(n % 5 == 2, "AO").otherwise(F.col("object_type"))})


DEC = f"lbs AS (SELECT DISTINCT raw_label, 'bacnet' AS source_type FROM pts), {pl.TOKENS_SQL}, {pl.DEC_SQL}, kq AS (SELECT *, len(raw_label) + ascii(substr(raw_label, -5, 1)) AS k FROM dr), dd AS (SELECT * REPLACE (CASE k % 7 WHEN 0 THEN 'energi' WHEN 1 THEN 'status' WHEN 2 THEN 'co2' ELSE measurement_type END AS measurement_type, CASE k % 5 WHEN 0 THEN 'BI' WHEN 1 THEN 'AI' WHEN 2 THEN 'AO' ELSE object_type END AS object_type) FROM kq)"
SAYS = "(contains(f, 'settpunkt') OR contains(f, 'setpoint') OR contains(f, 'borverdi'))"
CHECKS_SQL = f"""cj AS (SELECT dd.*, st.* EXCLUDE (raw_label), lower(coalesce(function, '')) AS f, coalesce(object_type IN ('BI', 'BO', 'BV'), false) AS isb, coalesce(object_type IN ('AI', 'AO', 'AV'), false) AS isa, coalesce(measurement_type, '') AS q FROM dd JOIN st USING (raw_label)),
cv AS (SELECT raw_label, CASE WHEN isb OR q = 'status' THEN CASE WHEN n_num = 0 THEN 'INCONCLUSIVE' WHEN "distinct" <= 2 THEN 'PASS' ELSE 'CONFLICT' END END AS c1,
  CASE WHEN isa OR q IN ('temperatur', 'co2', 'trykk') THEN CASE WHEN q = 'status' THEN CASE WHEN n_num > 0 AND "distinct" <= 2 THEN 'PASS' END WHEN n_num = 0 THEN 'INCONCLUSIVE' WHEN "distinct" = 2 THEN CASE WHEN {SAYS} OR contains(f, 'grenseverdi') THEN 'PASS' ELSE 'CONFLICT' END ELSE 'PASS' END END AS c2,
  CASE WHEN q IN ('temperatur', 'co2', 'trykk') OR (object_type = 'AO' AND q = 'kommando') THEN CASE WHEN n_num = 0 OR q = 'trykk' THEN 'INCONCLUSIVE' WHEN min >= CASE q WHEN 'temperatur' THEN -40 ELSE 0 END AND max <= CASE q WHEN 'temperatur' THEN 130 WHEN 'co2' THEN 10000 ELSE 100 END THEN 'PASS' ELSE 'CONFLICT' END END AS c3,
  CASE WHEN n_num = 0 THEN 'INCONCLUSIVE' WHEN "distinct" = 1 THEN CASE WHEN {SAYS} OR (contains(f, 'alarm') AND min = 0) THEN 'PASS' ELSE 'INCONCLUSIVE' END ELSE 'PASS' END AS c4,
  CASE WHEN q = 'energi' THEN CASE WHEN monotonic IS NULL THEN 'INCONCLUSIVE' WHEN monotonic THEN 'PASS' ELSE 'CONFLICT' END END AS c5,
  CASE WHEN object_type IS NOT NULL THEN CASE WHEN file_kinds = 'AV' AND isb THEN 'CONFLICT' WHEN file_kinds = 'BV' AND isa THEN 'CONFLICT' WHEN contains(file_kinds, ',') THEN 'INCONCLUSIVE' WHEN isa OR isb THEN 'PASS' END END AS c6 FROM cj)"""
BASE = f"WITH {POINTS}, {STATS_SQL}, {DEC}, {CHECKS_SQL}"
LONG = ", lg AS (SELECT raw_label, unnest(['binary-expected', 'av-trap', 'range', 'dead-point', 'energy-monotonic', 'file-kind']) AS name, unnest([c1, c2, c3, c4, c5, c6]) AS verdict FROM cv)"


def checked(spark, d):
    return ck.cross_check(decoded(spark, d), op.series_stats(points(spark, d)))


def chk01(spark, d):
    out = checked(spark, d)
    return out.select("raw_label", F.array_join(F.transform("checks", lambda c: F.concat_ws("=", c["name"], c["verdict"])), ",").alias("checks"), F.col("data_checks.conflict").alias("conflict"))


def agg35(spark, d):
    return ck.verdict_counts(checked(spark, d))


def agg35_queue(spark, d):
    return ck.review_queue(checked(spark, d)).select("raw_label", "conflicts", "open")


def jon22(spark, d):
    c = checked(spark, d).withColumn("decode_method", F.when(F.length("raw_label") % 2 == 0, "rules+llm").otherwise("rules"))
    return ck.promotable(c).select("raw_label")


def members(spark, d):
    p = points(spark, d).select("raw_label").distinct()
    return p.select("raw_label", F.explode(lb.group_keys(F.col("raw_label"), lb.segments(F.col("raw_label")))).alias("g")).select("raw_label", "g.*").withColumn("key", F.when(F.col("kind") == "same_system", F.concat_ws("|", "key", F.substring("raw_label", 1, 17))).otherwise(F.col("key")))


MEMBERS = f"lbs AS (SELECT DISTINCT raw_label, 'bacnet' AS source_type FROM pts), {pl.TOKENS_SQL}, mm AS (SELECT DISTINCT raw_label, split_part(g, '=', 1) AS kind, CASE WHEN split_part(g, '=', 1) = 'same_system' THEN split_part(g, '=', 2) || '|' || substr(raw_label, 1, 17) ELSE split_part(g, '=', 2) END AS key FROM (SELECT raw_label, unnest(kl) AS g FROM tk))"


def jon06(spark, d):
    rel = ck.relationships(ck.group_pairs(members(spark, d)))
    return rel.select("raw_label", F.array_join(F.transform("relationships", lambda r: F.concat_ws(">", r["type"], r["target_raw_label"])), ",").alias("relationships"))


def chk08(spark, d):
    p = points(spark, d)
    s = op.last_wins(p)
    return rounded(ck.directional(decoded(spark, d), op.series_stats(p), s, reference(s, p)), "r")


def jon08(spark, d):
    p = points(spark, d)
    role = lb.point_role(F.regexp_replace("raw_label", "_SP$", ""))
    roles = members(spark, d).where("kind = 'same_system'").withColumn("r", role).select("raw_label", "key", "r.letters", "r.side").where("letters is not null")
    return rounded(ck.supply_return(op.last_wins(p), roles), "above")


def jon07(spark, d):
    p = points(spark, d)
    flat = op.series_stats(p).where("distinct <= 1").select("raw_label")
    return rounded(ck.co_behaviour(op.last_wins(p), members(spark, d).where("kind = 'same_system'"), flat), "r")


QUERIES = {
    "chk01_cross_check": chk01,
    "agg35_verdict_counts": agg35,
    "agg35_review_queue": agg35_queue,
    "jon22_promotable": jon22,
    "jon06_relationships": jon06,
    "chk08_directional": chk08,
    "jon08_supply_return": jon08,
    "jon07_co_behaviour": jon07,
}
PROMO = BASE + ", ok AS (SELECT raw_label FROM cv WHERE len(raw_label) % 2 = 0 AND list_contains([c1, c2, c3, c4, c5, c6], 'PASS') AND NOT coalesce(list_contains([c1, c2, c3, c4, c5, c6], 'CONFLICT'), false))"
SQL = {
    "chk01_cross_check": BASE + " SELECT raw_label, concat_ws(',', 'binary-expected=' || c1, 'av-trap=' || c2, 'range=' || c3, 'dead-point=' || c4, 'energy-monotonic=' || c5, 'file-kind=' || c6) AS checks, list_contains(list_filter([c1, c2, c3, c4, c5, c6], lambda x: x IS NOT NULL), 'CONFLICT') AS conflict FROM cv",
    "agg35_verdict_counts": BASE + LONG + " SELECT name, verdict, count(*) AS n FROM lg WHERE verdict IS NOT NULL GROUP BY 1, 2",
    "agg35_review_queue": BASE + LONG + " SELECT raw_label, count(*) FILTER (verdict = 'CONFLICT')::INT AS conflicts, count(*) FILTER (verdict = 'INCONCLUSIVE')::INT AS open FROM lg GROUP BY 1 HAVING count(*) FILTER (verdict IN ('CONFLICT', 'INCONCLUSIVE')) > 0",
    "jon22_promotable": PROMO + " SELECT raw_label FROM ok",
    "jon06_relationships": f"WITH {POINTS}, {MEMBERS} SELECT a AS raw_label, string_agg(kind || '>' || b, ',' ORDER BY kind, b) AS relationships FROM (SELECT DISTINCT x.raw_label AS a, y.raw_label AS b, x.kind FROM mm x JOIN mm y ON x.kind = y.kind AND x.key = y.key AND x.raw_label <> y.raw_label) GROUP BY 1",
    "chk08_directional": BASE + f""", {LAST}, rf AS (SELECT ts_text, value AS ref FROM lw WHERE raw_label = '{REFERENCE}'), rr AS (SELECT raw_label, count(*) AS n, {PEARSON_SQL.format(x="value", y="ref")} AS r FROM lw JOIN rf USING (ts_text) GROUP BY 1),
w AS (SELECT cj.*, CASE WHEN system_code LIKE '32%' THEN -1 WHEN system_code LIKE '37%' THEN 1 END AS want FROM cj)
SELECT raw_label, want, coalesce(rr.n, 0) AS n, round(r, 6) AS r, CASE WHEN {SAYS} THEN 'SKIPPED' WHEN coalesce("distinct" <= 1, false) OR coalesce(is_binary, false) OR r IS NULL OR q = 'kommando' THEN 'SKIPPED' WHEN want * r >= 0.2 THEN 'PASS' WHEN want * r <= -0.2 THEN 'CONFLICT' ELSE 'NO_SIGNAL' END AS verdict FROM w LEFT JOIN rr USING (raw_label) WHERE want IS NOT NULL""",
    "jon08_supply_return": f"WITH {POINTS}, {LAST}, {MEMBERS}, ro AS (SELECT raw_label, key, regexp_extract(raw_label, '\\.-([A-Z]{{2}})\\d{{3}}(_SP)?$', 1) AS l, regexp_extract(raw_label, '\\.-[A-Z]{{2}}(\\d)\\d\\d(_SP)?$', 1) AS s FROM mm WHERE kind = 'same_system'), pr AS (SELECT DISTINCT a.raw_label AS a, b.raw_label AS b FROM ro a JOIN ro b ON a.key = b.key AND a.l = b.l AND a.s = '4' AND b.s = '5') SELECT a, b, n, round(above, 6) AS above, CASE WHEN n < 2 THEN 'SKIPPED' WHEN above >= 0.9 THEN 'PASS' WHEN above < 0.5 THEN 'CONFLICT' ELSE 'NO_SIGNAL' END AS verdict FROM (SELECT a, b, count(*) AS n, avg((x.value > y.value)::INT) AS above FROM pr JOIN lw x ON x.raw_label = a JOIN lw y ON y.raw_label = b AND y.ts_text = x.ts_text GROUP BY 1, 2)",
    "jon07_co_behaviour": f"WITH {POINTS}, {STATS_SQL}, {LAST}, {MEMBERS}, lv AS (SELECT mm.* FROM mm JOIN st USING (raw_label) WHERE kind = 'same_system' AND NOT coalesce(\"distinct\" <= 1, false)), pr AS (SELECT DISTINCT a.raw_label AS a, b.raw_label AS b FROM lv a JOIN lv b ON a.key = b.key AND a.raw_label < b.raw_label) SELECT a, b, n, round(r, 6) AS r, CASE WHEN r IS NULL THEN 'SKIPPED' WHEN abs(r) >= 0.3 THEN 'SUPPORTED' ELSE 'NO_SIGNAL' END AS verdict FROM (SELECT a, b, count(*) AS n, {PEARSON_SQL.format(x='x.value', y='y.value')} AS r FROM pr JOIN lw x ON x.raw_label = a JOIN lw y ON y.raw_label = b AND y.ts_text = x.ts_text GROUP BY 1, 2)",
}
