"""Set operations, small classifications, hierarchies and the stream, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import labels as lb
from ..operators import events as ev
from ..operators import zones as zo
from ..sources.files import area_of_files
from ..sources.shared import shared_folder
from ..sources.stores import file_system
from ..streaming import proxy
from . import graph as pg
from . import labels as pl
from .heating import REGIME_SQL, ZSTATS_SQL
from .series import rounded
from .views import WEATHER, ZONES, table, weather, zone_samples


def set01(spark, d):
    """Decoded labels followed by a second source's rows for labels that are not decoded."""
    base = pl.decoded(spark, d).where("tier <> 'NONE'").select("raw_label", F.lit("rules").alias("source"))
    second = pl.labels(spark, d).where(F.length("raw_label") % 2 == 0).select("raw_label", F.lit("second").alias("source"))
    return base.unionByName(second.join(base, "raw_label", "left_anti"))


def set02(spark, d):
    """Labels that any of three uses needs, each once."""
    x = pl.labels(spark, d).select("raw_label")
    n = F.length("raw_label")
    return x.where(n % 2 == 0).union(x.where(n % 3 == 0)).union(x.where(F.col("raw_label").contains("-RT45"))).distinct()


def jon12(spark, d):
    """Labels that a store knows exactly, knows a sibling of, or has not seen, by count."""
    x = pl.labels(spark, d).select("raw_label").withColumn("sig", lb.signature(F.col("raw_label")))
    store = x.where(F.length("raw_label") % 7 == 0)
    exact = store.select("raw_label", F.lit(True).alias("exact"))
    family = store.select("sig").distinct().withColumn("family", F.lit(True))
    kind = F.when(F.col("exact"), "exact").when(F.col("family"), "sibling").otherwise("unseen")
    return x.join(exact, "raw_label", "left").join(family, "sig", "left").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def srt04(spark, d):
    """Families by size."""
    fam = pl.labels(spark, d).groupBy(lb.signature(F.col("raw_label")).alias("family")).agg(F.count("*").alias("n"), F.min("raw_label").alias("example"))
    return fam.orderBy(F.desc("n"), "family")


def scl08(spark, d):
    """Season and outdoor bin of each day."""
    w = weather(spark, d)
    return w.select(F.col("day").cast("string").alias("day"), ev.season("day").alias("season"), F.coalesce(ev.outdoor_bin(F.col("temp")), F.lit("unknown")).alias("bin"), (F.month("day").isin(*zo.RULES["season_months"]) & (F.col("temp") < zo.RULES["season_max_outdoor"])).alias("heating_season"))


def agg22(spark, d):
    """Mean of a sentinel-ridden sensor by hour of the day in one month, and whether the hour is the peak (first of ties)."""
    e = table(spark, d, "events").where(F.month("ts") == 1).select(F.hour("ts").alias("hour"), F.when(F.col("event_id") % 9 == 0, -999.0).otherwise(F.floor("value") * 1.0).alias("v")).where("v > -900")
    hours = e.groupBy("hour").agg(F.round(F.avg("v"), 6).alias("mean"), F.count("*").alias("n"))
    return hours.withColumn("peak", F.row_number().over(Window.orderBy(F.desc("mean"), "hour")) == 1)  # 24 rows


def agg19(spark, d):
    """Expected zones per building against the table; only buildings that are there are tested."""
    want = spark.createDataFrame([("B0", 4), ("B1", 3), ("B2", 4), ("B9", 1)], "building string, expected long")
    have = zone_samples(spark, d).groupBy("building").agg(F.count_distinct("zone").alias("zones"))
    return have.join(want, "building").withColumn("ok", F.col("zones") == F.col("expected"))


def agg02(spark, d):
    """Areas of control numbers in file names, from folders; numbers seen in more than one folder conflict."""
    k = F.col("p_partkey")
    files = table(spark, d, "part").select(F.concat(F.lit("/data/area"), (k % 40 % 7).cast("string"), F.lit("/"), F.format_string("200534%02d-X%d AV punkter.csv", k % 40, k % 3)).alias("path")).distinct()
    out = area_of_files(files.withColumn("name", F.element_at(F.split("path", "/"), -1)))
    return out.withColumn("files", F.array_join("files", ","))


def jon16(spark, d):
    """Customer, nation and region of each order over typed part-of facts; the region may be missing."""
    nodes, edges = pg.hierarchy(spark, d)
    typed = edges.join(nodes.select(F.col("id").alias("dst"), "label"), "dst")
    level = typed.where("label = 'Customer'").select(F.col("src").alias("zone"), F.col("dst").alias("level"))
    building = typed.where("label = 'Nation'").select(F.col("src").alias("level"), F.col("dst").alias("building"))
    site = typed.where("label = 'Region' and substring(dst, -1, 1) <> '3'").select(F.col("src").alias("building"), F.col("dst").alias("site"))
    return level.join(building, "level").join(site, "building", "left").select("zone", "level", "building", "site")


def grf08(spark, d):
    """Nodes and edges of zones, their buildings and regimes as property-graph rows."""
    r = zo.gain_regime(zo.zone_stats(zone_samples(spark, d)))
    nodes = r.select(F.lit("Zone").alias("label"), F.col("zone").alias("id"), "regime").unionByName(r.select(F.lit("Building").alias("label"), F.col("building").alias("id")).distinct(), allowMissingColumns=True)
    edges = r.select(F.lit("Edge").alias("label"), F.concat_ws(">", "zone", F.lit("PART_OF"), "building").alias("id"))
    return nodes.unionByName(edges, allowMissingColumns=True)


def str02(spark, d):
    """The hourly proxy as a stream over the events: hours that the watermark has passed."""
    out = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    fs, where = file_system(spark, out)
    fs.deleteOnExit(where)
    schema = table(spark, d, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet")
    samples = events.select(F.concat(F.lit("B"), (F.col("user_id") % 3).cast("string")).alias("building"), F.concat(F.lit("Z"), (F.col("user_id") % 10).cast("string")).alias("zone"), F.col("ts").cast("timestamp").alias("ts"), F.floor("value").cast("double").alias("gain"))
    proxy.run_available(proxy.hourly_proxy(samples), f"{out}/rows", f"{out}/state")
    got = spark.read.parquet(f"{out}/rows")
    return rounded(got, "mean_gain").withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


def dec23_gap(spark, d):
    """Labels with a code-like token but no component, and how many there are of each family."""
    x = pl.decoded(spark, d).where(F.col("component").isNull() & F.col("raw_label").rlike(r"[A-Z]{2}\d{2,3}"))
    return x.groupBy(lb.signature(F.col("raw_label")).alias("family")).agg(F.count("*").alias("n"), F.min("raw_label").alias("example"))


QUERIES = {
    "set01_union_new": set01,
    "set02_label_needs": set02,
    "jon12_store_overlap": jon12,
    "srt04_families": srt04,
    "scl08_seasons": scl08,
    "agg22_peak_hour": agg22,
    "agg19_pinned_counts": agg19,
    "agg02_control_areas": agg02,
    "jon16_hierarchy": jon16,
    "grf08_zone_graph": grf08,
    "str02_stream_proxy": str02,
    "dec23_no_component": dec23_gap,
}
L = f"WITH {pl.LABELS}"
SEASON = "(year(day) - CASE WHEN month(day) < 8 THEN 1 ELSE 0 END)"
SQL = {
    "set01_union_new": pl.BASE + " SELECT raw_label, 'rules' AS source FROM dr WHERE tier <> 'NONE' UNION ALL SELECT raw_label, 'second' FROM lbs WHERE len(raw_label) % 2 = 0 AND raw_label NOT IN (SELECT raw_label FROM dr WHERE tier <> 'NONE')",
    "set02_label_needs": L + " SELECT raw_label FROM lbs WHERE len(raw_label) % 2 = 0 OR len(raw_label) % 3 = 0 OR contains(raw_label, '-RT45')",
    "jon12_store_overlap": L + f", x AS (SELECT raw_label, {pl.SIG} AS sig FROM lbs) SELECT CASE WHEN len(raw_label) % 7 = 0 THEN 'exact' WHEN sig IN (SELECT sig FROM x WHERE len(raw_label) % 7 = 0) THEN 'sibling' ELSE 'unseen' END AS kind, count(*) AS n FROM x GROUP BY 1",
    "srt04_families": L + f" SELECT {pl.SIG} AS family, count(*) AS n, min(raw_label) AS example FROM lbs GROUP BY 1",
    "scl08_seasons": f"WITH {WEATHER} SELECT day::VARCHAR AS day, {SEASON} || '-' || lpad((({SEASON} + 1) % 100)::VARCHAR, 2, '0') AS season, CASE WHEN temp IS NULL THEN 'unknown' WHEN temp < -5 THEN '<-5' WHEN temp < 0 THEN '<0' WHEN temp < 5 THEN '<5' WHEN temp < 10 THEN '<10' ELSE '>=10' END AS bin, month(day) IN (10, 11, 12, 1, 2, 3, 4) AND temp < 12 AS heating_season FROM wx",
    "agg22_peak_hour": "WITH h AS (SELECT hour(ts)::INT AS hour, round(avg(floor(value)), 6) AS mean, count(*) AS n FROM events WHERE month(ts) = 1 AND event_id % 9 <> 0 GROUP BY 1) SELECT *, hour = (SELECT hour FROM h ORDER BY mean DESC, hour LIMIT 1) AS peak FROM h",
    "agg19_pinned_counts": f"WITH {ZONES} SELECT building, count(DISTINCT zone) AS zones, w.e::BIGINT AS expected, count(DISTINCT zone) = w.e AS ok FROM zs JOIN (VALUES ('B0', 4), ('B1', 3), ('B2', 4), ('B9', 1)) w(b, e) ON w.b = building GROUP BY 1, 3, w.e",
    "agg02_control_areas": "WITH f AS (SELECT DISTINCT 'area' || (p_partkey % 40 % 7) AS area, printf('200534%02d', p_partkey % 40) AS control_number, printf('200534%02d-X%d AV punkter.csv', p_partkey % 40, p_partkey % 3) AS name FROM part) SELECT control_number, min_by(area, '/data/' || area || '/' || name) AS area, string_agg(DISTINCT name, ',' ORDER BY name) AS files, count(DISTINCT area) > 1 AS conflict FROM f GROUP BY 1",
    "jon16_hierarchy": "SELECT 'o' || o_orderkey AS zone, 'c' || c_custkey AS level, 'n' || n_nationkey AS building, CASE WHEN right('r' || n_regionkey, 1) <> '3' AND r_regionkey IS NOT NULL THEN 'r' || n_regionkey END AS site FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey",
    "grf08_zone_graph": f"WITH {ZONES}, {ZSTATS_SQL}, {REGIME_SQL} SELECT 'Zone' AS label, zone AS id, regime FROM rg UNION ALL SELECT DISTINCT 'Building', building, NULL FROM rg UNION ALL SELECT 'Edge', zone || '>PART_OF>' || building, NULL FROM rg",
    "str02_stream_proxy": "SELECT 'B' || (user_id % 3) AS building, 'Z' || (user_id % 10) AS zone, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, round(avg(floor(value)), 6) AS mean_gain, count(*) AS n FROM events GROUP BY 1, 2, date_trunc('hour', ts) HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)",
    "dec23_no_component": pl.BASE + f" SELECT {pl.SIG} AS family, count(*) AS n, min(raw_label) AS example FROM dr WHERE component IS NULL AND regexp_matches(raw_label, '[A-Z]{{2}}\\d{{2,3}}') GROUP BY 1",
}
