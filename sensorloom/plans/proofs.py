"""Queries that test heating data against what is known, records against their contract, and batches, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as ck
from ..operators import contract as ct
from ..operators import decode as dc
from ..operators import events as ev
from ..operators import graph as gr
from ..operators import physics as ph
from ..operators import series as op
from ..operators import zones as zo
from ..sources.shared import staged
from . import graph as pg
from . import labels as pl
from . import profile as pf
from .heating import BASE, FLAGS_SQL, HOURLY, ORIENT, REGIME_SQL, ZSTATS_SQL
from .series import PEARSON_SQL, rounded
from .views import WEATHER, ZONES, points, table, weather, zone_samples


def meters(spark, d):
    """Daily energy by building."""
    e = table(spark, d, "events")
    building = F.concat(F.lit("B"), (F.col("user_id") % 10 % 3).cast("string"))
    return e.groupBy(building.alias("building"), F.to_date("ts").alias("day")).agg(F.sum(F.floor("value")).cast("double").alias("energy"))


METER = "mt AS (SELECT 'B' || (user_id % 10 % 3) AS building, ts::DATE AS day, sum(floor(value))::DOUBLE AS energy FROM events GROUP BY 1, 2)"
ELECTRIC = ("B0", "B2")


def jon14(spark, d):
    """Duty of heating zones against weather, and in two buildings against meters."""
    hourly = staged(zo.hourly_proxy(zone_samples(spark, d)))
    heating = zo.orientation(hourly).where("orientation = 'heating'").select("building", "zone")
    duty = zo.daily_duty(hourly.join(heating, ["building", "zone"], "left_semi"))
    electric = spark.createDataFrame([(b,) for b in ELECTRIC], "building string")
    return rounded(ph.duty_checks(duty, weather(spark, d), meters(spark, d), electric), "r")


def agg20_counts(spark, d):
    return ph.orientation_counts(zo.orientation(zo.hourly_proxy(zone_samples(spark, d))))


#: Facts expected of zones and buildings, some of them wrong, one of a building that is not there.
WANT = (
    ("B0", "Z3", "regime", "binary"), ("B1", "Z7", "regime", "dead"), ("B1", "Z1", "regime", "binary"), ("B2", "Z99", "regime", "dead"),
    ("B1", "Z7", "flag", "dead_gain"), ("B0", "Z0", "flag", "empty"), ("B2", "Z2", "file", "co2_triple"), ("B0", "Z6", "file", "t_triple"),
    ("B0", None, "both", None), ("B1", None, "both", None), ("B0", None, "zones", "4"), ("B1", None, "zones", "9"), ("B9", "Z1", "regime", "dead"),
)


def agg19_pins(spark, d):
    stats = staged(zo.zone_stats(zone_samples(spark, d)))
    facts = stats.select("building", "zone", F.lit("t_triple").alias("file_kind"), "flags").join(zo.gain_regime(stats).select("building", "zone", "regime"), ["building", "zone"])
    return ph.pinned(facts, spark.createDataFrame(list(WANT), "building string, zone string, kind string, expected string"))


WINDOWS = (("2024-01-02", "2024-01-14"), ("2024-01-16", "2024-01-29"))


def votes(spark, d):
    """Steps of two windows; in the second, stamps of odd zones are an hour early."""
    rows = zone_samples(spark, d)
    early = (F.col("ts") >= F.lit("2024-01-15").cast("timestamp")) & (F.substring("zone", 2, 1).cast("int") % 2 == 1)
    rows = staged(rows.withColumn("ts", F.when(early, F.expr("ts - interval 1 hour")).otherwise(F.col("ts"))))
    return ph.shift_votes(*[zo.setpoint_steps(rows, *w) for w in WINDOWS])


def agg21_verdict(spark, d):
    return ph.timestamp_verdict(votes(spark, d))


_STEP = "st{k} AS (SELECT building, zone, grid_idx, (hour(ts) * 60 + minute(ts))::INT AS minute FROM (SELECT *, lag(setpoint) OVER (PARTITION BY building, zone ORDER BY grid_idx) AS p FROM zt1 WHERE setpoint IS NOT NULL AND ts::DATE BETWEEN DATE '{a}' AND DATE '{b}') WHERE setpoint > p), md{k} AS (SELECT building, zone, minute FROM (SELECT *, row_number() OVER (PARTITION BY building, zone ORDER BY n DESC, seen) AS rn FROM (SELECT building, zone, minute, count(*) AS n, min(grid_idx) AS seen FROM st{k} GROUP BY 1, 2, 3)) WHERE rn = 1)"
VOTES = f"WITH {ZONES}, zt1 AS (SELECT * REPLACE (CASE WHEN ts >= TIMESTAMP '2024-01-15' AND substr(zone, 2, 1)::INT % 2 = 1 THEN ts - INTERVAL 1 HOUR ELSE ts END AS ts) FROM zs), " + ", ".join(_STEP.format(k=k, a=a, b=b) for k, (a, b) in enumerate(WINDOWS)) + ", vt AS (SELECT building, zone, w.minute - s.minute AS shift FROM md0 w JOIN md1 s USING (building, zone)), vo AS (SELECT *, CASE WHEN shift BETWEEN 45 AND 75 THEN 'utc' WHEN shift BETWEEN -15 AND 15 THEN 'local' ELSE 'other' END AS vote FROM vt)"


def broken(rows):
    """Decoded rows of which some break the contract."""
    n = F.length("raw_label")
    return rows.withColumns({"carrier": F.when(n % 6 == 0, "steam").otherwise(F.col("carrier")), "confidence": F.when(n % 9 == 0, 1.5).otherwise(F.col("confidence")), "decode_method": F.when(n % 4 == 0, "rules+retrieval").otherwise(F.col("decode_method"))})


BROKEN = ", bk AS (SELECT raw_label, source_type, tier, CASE WHEN len(raw_label) % 4 = 0 THEN 'rules+retrieval' ELSE decode_method END AS decode_method, CASE WHEN len(raw_label) % 9 = 0 THEN 1.5 ELSE confidence END AS conf, len(raw_label) % 6 = 0 OR len(raw_label) % 9 = 0 AS bad FROM dr), sp AS (SELECT *, CASE WHEN tier = 'NONE' OR conf < 0.4 THEN 'thin' WHEN bad THEN 'invalid' END AS reason FROM bk)"


def dec19(spark, d):
    """What goes on to a second source, and why."""
    # staged before the filter, which would otherwise copy the rules; no other column is computed
    return staged(dc.split_batch(broken(pl.rules(pl.labels(spark, d)))).select("raw_label", "source_type", "reason")).where("reason is not null")


def dec20(spark, d):
    return dc.batch_counts(dc.split_batch(broken(pl.decoded(spark, d))))


def dec22(spark, d):
    return dc.merge_report(dc.merge_second(pl.decoded(spark, d), pl.second_source(spark, d)))


def scl20(spark, d):
    """JSON records of labels: whole ones, some without a required member, with unknown members, wrong types or values, nested ones too."""
    n, x = F.length("raw_label"), F.col("raw_label")
    lab = pl.labels(spark, d).select("raw_label")
    place = F.when(n % 5 == 0, '{"building": "B1"}').when(n % 5 == 1, '{"building": "B1", "zone": null, "room": 4}').when(n % 5 == 2, "null").otherwise('{"building": null, "zone": "Z"}')
    system = F.when(n % 7 == 0, '{"description": "x"}').when(n % 7 == 1, '{"code": 320}').otherwise('{"code": "3200"}')
    related = F.when(n % 4 == 0, '[{"type": "feeds", "target_raw_label": "a"}, {"type": "feeds"}]').when(n % 4 == 1, "null").otherwise("[]")
    body = F.concat(F.lit('{"source_type": "bacnet", "confidence": '), F.when(n % 6 == 0, "1.25").when(n % 6 == 1, '"high"').otherwise("0.5"), F.lit(', "location": '), place, F.lit(', "primary_system": '), system, F.lit(', "relationships": '), related)
    own = F.when(n % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(', "raw_label": "'), x, F.lit('"')))
    more = F.when(n % 8 == 0, ', "colour": 1, "age": 2').otherwise("")
    text = F.when(n % 13 == 0, F.lit("{not json")).otherwise(F.concat(body, own, more, F.lit(', "validated": false}')))
    out = ct.violations(lab.withColumn("record", text), ct.RECORD)
    return out.select("raw_label", F.array_join(F.transform("violations", lambda v: F.concat_ws(":", v["location"], v["message"])), ";").alias("violations"))


def jon01(spark, d):
    """Decoded labels of which a third has no statistics."""
    rows = pf.decoded(spark, d)
    return ck.missing_statistics(rows, op.series_stats(points(spark, d)).where(F.ascii(F.substring("raw_label", 11, 1)) % 3 != 0))


def jon02(spark, d):
    """Records with the checks found for them; those of a broken record stay as they are."""
    rows = pf.decoded(spark, d).withColumn("schema_invalid", F.ascii(F.substring("raw_label", 11, 1)) % 3 == 0)
    out = ck.augmented(rows, pf.checked(spark, d))
    return out.select("raw_label", "schema_invalid", F.col("data_checks.distinct_values").alias("distinct_values"), F.col("data_checks.monotonic").alias("monotonic"), F.col("data_checks.conflict").alias("conflict"))


def grf04(spark, d):
    return gr.node_triples(pg.facts(spark, d))


def jon21(spark, d):
    """Facts of zones from three tables, some missing in each: regime, time to one degree and winter duty."""
    samples = staged(zone_samples(spark, d))
    regimes = zo.gain_regime(zo.zone_stats(samples)).where("regime <> 'dead'").select("building", "zone", "regime")
    tau = ev.step_summary(ev.decay_events(samples), weather(spark, d)).where("grouping = 'all'").select("building", "zone", F.col("median_1k").alias("tau"))
    duty = zo.orientation(zo.hourly_proxy(samples)).where("orientation <> 'idle'").select("building", "zone", "winter_duty")
    return rounded(ev.facts_of_zones({"regime": regimes, "tau": tau, "duty": duty}), "tau")


QUERIES = {
    "jon14_duty_checks": jon14,
    "agg20_orientation_counts": agg20_counts,
    "agg19_pinned_facts": agg19_pins,
    "agg21_shift_votes": votes,
    "agg21_timestamp_verdict": agg21_verdict,
    "dec19_residue_reasons": dec19,
    "dec20_methods": dec20,
    "dec22_merge_report": dec22,
    "scl20_records": scl20,
    "jon01_missing_statistics": jon01,
    "jon02_augmented": jon02,
    "grf04_node_triples": grf04,
    "jon21_zone_facts": jon21,
}
_LOC = "CASE WHEN {on} THEN '{at}:{what}' END"
_RECORD_RULES = (
    ("n % 13 <> 0 AND n % 8 = 0", "(root)", "has unknown age, colour"),
    ("n % 13 <> 0 AND n % 3 = 0", "(root)", "lacks raw_label"),
    ("n % 13 = 0", "(root)", "is no JSON"),
    ("n % 13 <> 0 AND n % 6 = 0", "confidence", "is above 1"),
    ("n % 13 <> 0 AND n % 6 = 1", "confidence", "is no number"),
    ("n % 13 <> 0 AND n % 5 = 1", "location", "has unknown room"),
    ("n % 13 <> 0 AND n % 5 = 0", "location", "lacks zone"),
    ("n % 13 <> 0 AND n % 7 = 0", "primary_system", "lacks code"),
    ("n % 13 <> 0 AND n % 7 = 1", "primary_system/code", "is no string"),
    ("n % 13 <> 0 AND n % 4 = 1", "relationships", "is no array"),
    ("n % 13 <> 0 AND n % 4 = 0", "relationships/1", "lacks target_raw_label"),
)
_SYS = "CASE substr(coalesce(system_code, substr(digits, 1, 3) || '0'), 1, 2) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in gr.SYSTEM_CLASS.items()) + " ELSE 'System' END"
_GEAR = "CASE regexp_extract(equipment, '^([A-Z]{2})\\d', 1) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in gr.EQUIPMENT_CLASS.items()) + " ELSE CASE WHEN contains(lower(equipment), 'pumpe') THEN 'Pump' ELSE 'Equipment' END END"
_WANT = ", ".join("(" + ", ".join("NULL::VARCHAR" if v is None else f"'{v}'" for v in r) + ")" for r in WANT)
SQL = {
    "jon14_duty_checks": f"""WITH {ZONES}, {WEATHER}, {METER}, {HOURLY}, {ORIENT}, dd AS (SELECT building, hour::DATE AS day, sum(mean_gain * n) / sum(n) AS duty FROM hp JOIN (SELECT building, zone FROM ori WHERE orientation = 'heating') USING (building, zone) GROUP BY 1, 2),
sd AS (SELECT dd.*, temp FROM dd JOIN wx USING (day) WHERE month(day) IN (10, 11, 12, 1, 2, 3, 4) AND temp < 12),
cc AS (SELECT building, 'outdoor' AS measure, count(*) AS n, {PEARSON_SQL.format(x="duty", y="temp")} AS r FROM sd GROUP BY 1 UNION ALL SELECT building, 'meter', count(*), {PEARSON_SQL.format(x="duty", y="energy")} FROM sd JOIN mt USING (building, day) WHERE building IN {ELECTRIC} GROUP BY 1)
SELECT building, measure, n, round(r, 6) AS r, CASE WHEN n < 30 OR r IS NULL THEN 'INCONCLUSIVE' WHEN (measure = 'outdoor' AND r < 0) OR (measure = 'meter' AND r > 0) THEN 'PASS' ELSE 'CONFLICT' END AS verdict FROM cc""",
    "agg20_orientation_counts": f"WITH {ZONES}, {HOURLY}, {ORIENT} SELECT building, count(*) FILTER (orientation = 'heating') AS heating, count(*) FILTER (orientation = 'cooling') AS cooling, count(*) FILTER (orientation = 'dual') AS dual, count(*) FILTER (orientation = 'idle') AS idle, count(*) AS zones, count(*) FILTER (orientation IN ('cooling', 'dual')) > count(*) * 0.2 AS warning, count(*) FILTER (orientation = 'heating') = 0 AS skipped FROM ori GROUP BY 1",
    "agg19_pinned_facts": f"""WITH {ZONES}, {ZSTATS_SQL}, {REGIME_SQL}, fl AS (SELECT building, zone, {FLAGS_SQL} FROM zt), fa AS (SELECT rg.building, rg.zone, regime, flags FROM rg JOIN fl USING (building, zone)), bt AS (SELECT building, string_agg(DISTINCT regime, ',' ORDER BY regime) AS rs, count(*) AS nz FROM fa GROUP BY 1),
w AS (SELECT * FROM (VALUES {_WANT}) v(building, zone, kind, expected) WHERE building IN (SELECT building FROM fa))
SELECT w.building, w.zone, kind, expected, CASE kind WHEN 'regime' THEN regime WHEN 'flag' THEN flags ELSE CASE WHEN regime IS NOT NULL THEN 't_triple' END END AS got, coalesce(CASE kind WHEN 'regime' THEN regime = expected WHEN 'flag' THEN list_contains(string_split(flags, ','), expected) ELSE expected = 't_triple' AND regime IS NOT NULL END, false) AS ok FROM w LEFT JOIN fa USING (building, zone) WHERE kind IN ('regime', 'flag', 'file')
UNION ALL SELECT w.building, w.zone, kind, expected, CASE kind WHEN 'zones' THEN nz::VARCHAR ELSE rs END, CASE kind WHEN 'zones' THEN nz::VARCHAR = expected ELSE contains(rs, 'binary') AND contains(rs, 'modulating') END FROM w JOIN bt USING (building) WHERE kind IN ('both', 'zones')""",
    "agg21_shift_votes": VOTES + " SELECT * FROM vo",
    "agg21_timestamp_verdict": VOTES + " SELECT *, CASE WHEN utc > local THEN 'UTC' WHEN local > utc THEN 'LOCAL' ELSE 'INCONCLUSIVE' END AS verdict FROM (SELECT count(*) FILTER (vote = 'utc') AS utc, count(*) FILTER (vote = 'local') AS local, count(*) FILTER (vote = 'other') AS other FROM vo)",
    "dec19_residue_reasons": pl.BASE + BROKEN + " SELECT raw_label, source_type, reason FROM sp WHERE reason IS NOT NULL",
    "dec20_methods": pl.BASE + BROKEN + " SELECT decode_method, tier, reason, count(*) AS n FROM sp GROUP BY 1, 2, 3",
    "dec22_merge_report": f"""SELECT count(*) AS n, count(*) FILTER (adopted <> '') AS rows_enriched, count(*) FILTER (conflicts <> '') AS conflict_rows, 0::BIGINT AS merge_invalid, sum(CASE WHEN adopted = '' THEN 0 ELSE len(string_split(adopted, ',')) END)::BIGINT AS fields_adopted,
  sum(len(regexp_extract_all(conflicts, '(^|,)(carrier|function|location\\.building|location\\.zone):')))::BIGINT AS field_conflicts FROM ({pl.DEC22_SQL})""",
    "scl20_records": f"WITH {pl.LABELS}, l AS (SELECT raw_label, len(raw_label) AS n FROM lbs) SELECT raw_label, concat_ws(';', " + ", ".join(_LOC.format(on=on, at=at, what=what) for on, at, what in _RECORD_RULES) + ") AS violations FROM l",
    "jon01_missing_statistics": pf.BASE + " SELECT raw_label FROM dd WHERE ascii(substr(raw_label, 11, 1)) % 3 = 0",
    "jon02_augmented": pf.BASE + """ SELECT raw_label, ascii(substr(raw_label, 11, 1)) % 3 = 0 AS schema_invalid, CASE WHEN ascii(substr(raw_label, 11, 1)) % 3 <> 0 THEN "distinct"::INT END AS distinct_values, CASE WHEN ascii(substr(raw_label, 11, 1)) % 3 <> 0 THEN monotonic END AS monotonic, CASE WHEN ascii(substr(raw_label, 11, 1)) % 3 <> 0 THEN list_contains(list_filter([c1, c2, c3, c4, c5, c6], lambda x: x IS NOT NULL), 'CONFLICT') END AS conflict FROM cv JOIN st USING (raw_label)""",
    "grf04_node_triples": pg.FACTS + f""", pd AS (SELECT pa.graph, pa.equipment, pa.building, pa.system_code, tk.system_digits AS digits FROM pa JOIN tk USING (raw_label)),
es AS (SELECT equipment, CASE WHEN count(DISTINCT coalesce(building, '')) = 1 THEN max(building) END AS b, CASE WHEN count(DISTINCT coalesce(digits, '')) = 1 THEN max(digits) END AS d FROM pd WHERE equipment IS NOT NULL GROUP BY 1),
eg AS (SELECT DISTINCT graph, equipment, 'equipment/' || {pg.IRI.format(x="equipment")} AS s, b, d FROM pd JOIN es USING (equipment))
SELECT graph, 'system/' || digits AS s, 'a' AS p, {_SYS} AS o FROM pd WHERE digits IS NOT NULL UNION SELECT graph, 'system/' || digits, 'label', 'NS ' || coalesce(system_code, substr(digits, 1, 3) || '0') || ' (token ' || digits || ')' FROM pd WHERE digits IS NOT NULL
UNION SELECT graph, s, 'a', {_GEAR} FROM eg UNION SELECT graph, s, 'label', equipment FROM eg UNION SELECT graph, s, 'hasLocation', 'building/' || {pg.IRI.format(x="b")} FROM eg WHERE b IS NOT NULL UNION SELECT graph, 'system/' || d, 'hasPart', s FROM eg WHERE d IS NOT NULL""",
    "jon21_zone_facts": BASE + f""", {HOURLY}, {ORIENT}, ks AS (SELECT DISTINCT building, zone FROM zs), tm AS (SELECT building, zone, median_1k FROM ss WHERE grouping = 'all'), dt AS (SELECT building, zone, winter_duty FROM ori WHERE orientation <> 'idle'), rn AS (SELECT building, zone, regime FROM rg WHERE regime <> 'dead')
SELECT building, zone, regime, round(median_1k, 6) AS tau, winter_duty, concat_ws(',', CASE WHEN dt.zone IS NOT NULL THEN 'duty' END, CASE WHEN rn.zone IS NOT NULL THEN 'regime' END, CASE WHEN tm.zone IS NOT NULL THEN 'tau' END) AS known FROM ks LEFT JOIN rn USING (building, zone) LEFT JOIN tm USING (building, zone) LEFT JOIN dt USING (building, zone) WHERE rn.zone IS NOT NULL OR tm.zone IS NOT NULL OR dt.zone IS NOT NULL""",
}
