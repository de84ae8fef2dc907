"""Queries of score, readiness and version reports, of single signals and of readers, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import decode as dc
from ..operators import graph as gr
from ..operators import scoring as sc
from ..operators import zones as zo
from ..sources import files, stores
from ..sources.shared import shared_folder
from . import graph as pg
from . import labels as pl
from .series import rounded
from .views import POINTS, ZONES, points, table, zone_samples


def written(spark, rows, form: str = "text", by: str | None = None) -> str:
    """The path of a table written in the shared folder, for readers to read; ``by``: in a folder for each value."""
    path = f"{shared_folder(spark)}/read-{uuid.uuid4().hex}"
    fs, where = stores.file_system(spark, path)
    fs.deleteOnExit(where)
    writer = rows.write.format(form)
    (writer.partitionBy(by) if by else writer).save(path)
    return path


def contract_rows(spark, d):
    n = F.length("raw_label")
    return sc.contract(pg.outputs(spark, d).withColumns({"carrier": F.when(n % 6 == 0, "steam").otherwise(F.col("carrier")), "confidence": F.when(n % 5 == 0, 1.5).otherwise(F.col("confidence"))}))


def agg29(spark, d):
    return rounded(sc.validity_rate(contract_rows(spark, d)), "validity_rate")


def chk12(spark, d):
    return sc.error_rows(pg.gold(spark, d), pg.outputs(spark, d), contract_rows(spark, d))


def agg26_codes(spark, d):
    return rounded(sc.code_exact(pg.gold(spark, d), pg.outputs(spark, d)), "code_exact")


def agg31_confidence(spark, d):
    return rounded(sc.confidence_histogram(pg.outputs(spark, d)), "mean_confidence")


def agg32_classes(spark, d):
    return gr.class_counts(pg.facts(spark, d))


def srt04_gaps(spark, d):
    places = F.struct(F.col("building"), F.col("zone")).alias("location")
    facts = pg.facts(spark, d).withColumns({"primary_system": F.col("system_code"), "location": places})
    return gr.family_gaps(facts, dc.readiness_gaps())


def scl19(spark, d):
    """The version of a decode that rests on the labels whose length seven divides."""
    return dc.version_stamp(pl.labels(spark, d).where(F.length("raw_label") % 7 == 0).select("raw_label"))


def src20(spark, d):
    out = zo.signal(zone_samples(spark, d), "B0", "Z3", "y", "2024-01-02 06", "2024-01-09")
    return out.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), F.round("value", 6).alias("value"))


def jon21(spark, d):
    """Facts of three tables about one key, some missing in each."""
    x = pl.labels(spark, d).select("raw_label", F.length("raw_label").alias("n"))
    part = lambda k, name: x.where(F.col("n") % k == 0).select("raw_label", (F.col("n") * k).alias(name))
    return part(2, "regime").join(part(3, "tau"), "raw_label", "full_outer").join(part(5, "duty"), "raw_label", "full_outer")


def set05(spark, d):
    """Batches of labels by shape, one after another, with repeats."""
    x = pl.labels(spark, d)
    n = F.length("raw_label")
    return x.where(n % 2 == 0).withColumn("batch", F.lit("even")).unionByName(x.where(n % 3 == 0).withColumn("batch", F.lit("third")))


def src01(spark, d):
    """The point samples as comma-separated text, some lines malformed or blank, read again: rows, unreadable values and sum by label."""
    p = points(spark, d)
    line = F.concat_ws(",", F.concat("raw_label", F.lit(",x")), F.concat(F.lit(" "), "ts_text"), F.coalesce(F.col("value").cast("string"), F.lit("bad")))
    odd = F.when(F.col("arrival") % 31 == 0, F.lit("no commas here")).when(F.col("arrival") % 37 == 0, F.lit("  ")).otherwise(line)
    rows = files.point_lines(spark, written(spark, p.select(odd.alias("value"))))
    return rows.groupBy("raw_label", "malformed").agg(F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("unread"), F.round(F.sum("value"), 4).alias("total"), F.min("ts_text").alias("first_ts"))


def src04(spark, d):
    """The same for a list of labels alone."""
    p = points(spark, d)
    path = written(spark, p.select(F.concat_ws(",", "raw_label", "ts_text", F.coalesce(F.col("value").cast("string"), F.lit("bad"))).alias("value")))
    wanted = p.select("raw_label").distinct().where(F.length("raw_label") % 2 == 0)
    return files.point_lines(spark, path, labels=wanted).groupBy("raw_label").agg(F.count("*").alias("n"))


def src11(spark, d):
    """Hourly readings as text with sentinels and unreadable dates, to daily means."""
    e = table(spark, d, "events")
    t = F.when(F.col("event_id") % 41 == 0, "bad").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    v = F.when(F.col("event_id") % 9 == 0, "-999").when(F.col("event_id") % 10 == 0, "n/a").otherwise(F.floor("value").cast("string"))
    path = written(spark, e.select(t.alias("Time"), v.alias("Air temperature")).coalesce(8), "csv")
    rows = spark.read.csv(path).toDF("Time", "Air temperature")
    return files.daily_weather(rows).select(F.col("day").cast("string").alias("day"), F.round("temp", 6).alias("temp"))


def src12(spark, d):
    """Meter readings as text in two date forms, with empty values, to daily sums by building."""
    e = table(spark, d, "events")
    t = F.when(F.col("user_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm")).otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm"))
    v = F.when(F.col("event_id") % 10 == 0, F.lit("")).otherwise(F.floor("value").cast("string"))
    path = written(spark, e.select(F.concat(F.lit("B"), (F.col("user_id") % 3).cast("string")).alias("building"), t.alias("_c0"), v.alias("main")).coalesce(8), "csv")
    rows = spark.read.csv(path).toDF("building", "_c0", "main")
    return files.daily_meter(rows, "main", by="building").select("building", F.col("day").cast("string").alias("day"), "energy")


def src13(spark, d):
    """Decoded labels as JSON lines (SNK-01), read again under their schema."""
    out = pl.decoded(spark, d)
    path = written(spark, out, "json")
    return pl.flat(files.json_rows(spark, path, out.schema))


def src18(spark, d):
    """Point triples as N-Triples text by graph, read again."""
    lines = gr.triple_lines(gr.point_triples(pg.facts(spark, d)))
    rows = files.triple_rows(spark, written(spark, lines.select("value")))
    strip = lambda c: F.regexp_replace(c, "^urn:points:", "")
    return rows.select(strip("s").alias("s"), strip("p").alias("p"), strip("o").alias("o")).distinct()


def src21(spark, d):
    """Labels as counted lines, repeated and blank ones among them, as a batch to decode."""
    x = pl.labels(spark, d)
    n = F.length("raw_label")
    lines = x.select(F.concat(n.cast("string"), F.lit("\t"), "raw_label").alias("value")).union(x.where(n % 2 == 0).select(F.concat(F.lit("  "), "raw_label"))).union(x.where(n % 5 == 0).select(F.lit("  ")))
    return files.label_batch(spark, written(spark, lines), "bacnet")


QUERIES = {
    "agg29_validity_rate": agg29,
    "chk12_error_rows": chk12,
    "agg26_code_exact": agg26_codes,
    "agg31_confidence": agg31_confidence,
    "agg32_class_counts": agg32_classes,
    "srt04_worst_gaps": srt04_gaps,
    "scl19_version": scl19,
    "src20_signal": src20,
    "jon21_facts_merge": jon21,
    "set05_batches": set05,
    "src01_point_lines": src01,
    "src04_label_list": src04,
    "src11_weather": src11,
    "src12_meters": src12,
    "src13_json_lines": src13,
    "src18_triples": src18,
    "src21_label_batch": src21,
}
VALID = "CASE WHEN len(raw_label) % 6 = 0 THEN 'carrier: not in enum' END, CASE WHEN len(raw_label) % 5 = 0 THEN 'confidence: out of range' END"
SIDES = lambda name, t, more: " UNION ALL ".join(f"SELECT raw_label, '{f}' AS field, {f}::VARCHAR AS {name}{more} FROM {t}" for f in sc.FIELDS)
GAP = {"primary_system": "system_code IS NULL", "point_semantics": "measurement_type IS NULL AND function IS NULL", "building": "building IS NULL", "low_confidence": "confidence <= 0.4"}
L = f"WITH {pl.LABELS}"
SQL = {
    "agg29_validity_rate": pl.BASE + " SELECT count(*) AS n_outputs, count(*) FILTER (len(raw_label) % 6 <> 0 AND len(raw_label) % 5 <> 0) AS valid, round(count(*) FILTER (len(raw_label) % 6 <> 0 AND len(raw_label) % 5 <> 0) / count(*), 6) AS validity_rate FROM dr",
    "chk12_error_rows": pg.BASE + pg.VERDICTS + f", pv AS ({SIDES('predicted', 'ou', ', confidence')}), gv AS ({SIDES('gold', 'go', '')}) SELECT raw_label, field, verdict AS kind, predicted, gold, confidence FROM fv JOIN pv USING (raw_label, field) JOIN gv USING (raw_label, field) WHERE verdict <> 'CORRECT' UNION ALL SELECT raw_label, '(schema)', 'SCHEMA_INVALID', concat_ws('; ', {VALID}), NULL, NULL FROM ou WHERE len(raw_label) % 6 = 0 OR len(raw_label) % 5 = 0",
    "agg26_code_exact": pg.BASE + " SELECT count(*) AS n, round(avg((trim(g.system_code) = trim(o.system_code))::INT), 6) AS code_exact FROM go g JOIN ou o USING (raw_label) WHERE g.system_code IS NOT NULL AND o.system_code IS NOT NULL",
    "agg31_confidence": pl.BASE + " SELECT least(floor(confidence * 5), 4)::INT AS bin, count(*) AS n, round(avg(confidence), 6) AS mean_confidence FROM dr GROUP BY 1",
    "agg32_class_counts": pg.FACTS + " SELECT class, count(*) AS n FROM pf GROUP BY 1",
    "srt04_worst_gaps": pg.FACTS + f", fg AS (SELECT {pl.SIG} AS family, count(*) AS n, count(*) FILTER (class = 'Point') AS untyped, " + ", ".join(f"count(*) FILTER ({v}) AS no_{k}" for k, v in GAP.items()) + " FROM pf GROUP BY 1) SELECT *, untyped + " + " + ".join(f"no_{k}" for k in GAP) + " AS gaps FROM fg",
    "scl19_version": L + ", h AS (SELECT ('0x' || substr(md5('0' || chr(31) || raw_label), 1, 8))::BIGINT AS h FROM lbs WHERE len(raw_label) % 7 = 0) SELECT substr(sha256(count(*)::VARCHAR || ':' || coalesce(sum(h), 0)::BIGINT::VARCHAR), 1, 12) AS version FROM h",
    "src20_signal": f"WITH {ZONES} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, round(actual, 6) AS value FROM zs WHERE building = 'B0' AND zone = 'Z3' AND strftime(ts, '%Y-%m-%d %H:%M:%S') >= '2024-01-02 06' AND strftime(ts, '%Y-%m-%d') <= '2024-01-09'",
    "jon21_facts_merge": L + ", x AS (SELECT raw_label, len(raw_label) AS n FROM lbs) SELECT raw_label, (CASE WHEN n % 2 = 0 THEN n * 2 END)::INT AS regime, (CASE WHEN n % 3 = 0 THEN n * 3 END)::INT AS tau, (CASE WHEN n % 5 = 0 THEN n * 5 END)::INT AS duty FROM x WHERE n % 2 = 0 OR n % 3 = 0 OR n % 5 = 0",
    "set05_batches": L + " SELECT raw_label, source_type, 'even' AS batch FROM lbs WHERE len(raw_label) % 2 = 0 UNION ALL SELECT raw_label, source_type, 'third' FROM lbs WHERE len(raw_label) % 3 = 0",
    "src01_point_lines": f"WITH {POINTS}, x AS (SELECT CASE WHEN arrival % 31 = 0 THEN 'no commas here' ELSE raw_label || ',x' END AS raw_label, arrival % 31 = 0 AS malformed, CASE WHEN arrival % 31 <> 0 THEN value END AS value, CASE WHEN arrival % 31 <> 0 THEN ts_text END AS ts_text FROM pts WHERE arrival % 31 = 0 OR arrival % 37 <> 0) SELECT raw_label, malformed, count(*) AS n, count(*) FILTER (value IS NULL) AS unread, round(sum(value), 4) AS total, min(ts_text) AS first_ts FROM x GROUP BY 1, 2",
    "src04_label_list": f"WITH {POINTS} SELECT raw_label, count(*) AS n FROM pts WHERE len(raw_label) % 2 = 0 GROUP BY 1",
    "src11_weather": "SELECT ts::DATE::VARCHAR AS day, round(avg(floor(value)), 6) AS temp FROM events WHERE event_id % 41 <> 0 AND event_id % 9 <> 0 AND event_id % 10 <> 0 GROUP BY 1",
    "src12_meters": "SELECT 'B' || (user_id % 3) AS building, ts::DATE::VARCHAR AS day, sum(floor(value)) AS energy FROM events WHERE event_id % 10 <> 0 GROUP BY 1, 2",
    "src13_json_lines": pl.SQL["dec_rules"],
    "src18_triples": pg.FACTS + " SELECT DISTINCT s, p, o FROM tr",
    "src21_label_batch": L + " SELECT raw_label, source_type FROM lbs",
}
