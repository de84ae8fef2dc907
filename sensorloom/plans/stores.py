"""Queries of tables that jobs add to, of rescans, and of zone files under chosen names, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import checks as ck
from ..operators import groups as gp
from ..operators import order
from ..operators import series as op
from ..operators import zones as zo
from ..sources import files, stores
from ..sources.shared import shared_folder, staged
from . import profile as pf
from .heating import REGIME_SQL, ZSTATS_SQL
from .series import LAST, PEARSON_SQL, STATS_SQL, rounded
from .views import POINTS, ZONES, points, table, zone_samples


def folder(spark, name: str) -> str:
    """A new folder in the shared one; it goes when the session ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    fs, where = stores.file_system(spark, path)
    fs.deleteOnExit(where)
    return path


def snk05(spark, d):
    """A store of promotable labels after an approval that ran twice: what each batch has brought."""
    c = pf.checked(spark, d).withColumn("decode_method", F.when(F.length("raw_label") % 2 == 0, "rules+llm").otherwise("rules"))
    ready = staged(ck.promotable(c).select("raw_label", "component"))
    path = folder(spark, "store")
    stores.append_once(ready.where(F.ascii(F.substring("raw_label", 11, 1)) % 2 == 0), path, ["raw_label"], "first")
    for _ in range(2):
        store = spark.read.parquet(path)
        approved = ready.where(F.col("raw_label").contains("/Loop.3"))
        fresh = ck.approve(store.where("_batch <> 'approval'"), ready, approved)
        store = stores.append_once(fresh, path, ["raw_label"], "approval")
    return store.select("raw_label", "component", F.col("_batch").alias("batch"))


def snk02(spark, d):
    """Hourly proxies added zone by zone: even zones first, then all; rows by the batch that brought them."""
    hourly = staged(zo.hourly_proxy(zone_samples(spark, d)))
    path = folder(spark, "proxy")
    key = ["building", "zone", "hour"]
    even = F.substring("zone", 2, 1).cast("int") % 2 == 0
    stores.append_once(hourly.where(even), path, key, "even")
    for _ in range(2):
        table = stores.append_once(hourly, path, key, "all")
    out = table.groupBy("building", "zone", F.col("_batch").alias("batch")).agg(F.count("*").alias("n"), F.sum("mean_gain").alias("total"))
    return rounded(out, "total")


def snk04(spark, d):
    """Nodes of zones merged twice by id, the second time with later facts of some."""
    regimes = staged(zo.gain_regime(zo.zone_stats(zone_samples(spark, d))))
    nodes = regimes.select(F.concat_ws("/", "building", "zone").alias("id"), F.lit("Zone").alias("label"), "regime", F.lit(1).alias("version"))
    later = nodes.where("regime <> 'binary'").withColumns({"regime": F.concat(F.lit("checked "), "regime"), "version": F.lit(2)})
    path = folder(spark, "nodes")
    for rows in (nodes, later, nodes, later):
        table = stores.merge(rows, path, ["id"], "version")
    return table.select("id", "label", "regime", "version")


def _lines(spark, d, mark: str, where=None):
    rows = points(spark, d) if where is None else points(spark, d).where(where)
    name = F.concat(F.lit("c"), F.substring("raw_label", 11, 1), F.lit(".csv"))
    line = F.concat_ws(",", F.lit(mark), "raw_label", F.coalesce(F.col("value").cast("string"), F.lit("bad")))
    return rows.select(name.alias("name"), F.col("arrival").alias("n"), line.alias("line"))


def str01(spark, d):
    """Rows of files by label and state after three scans: of four files, then with one changed and one new, then with nothing new."""
    source, store = folder(spark, "files"), folder(spark, "scans")
    parse = lambda lines: lines.select("path", *[F.get(F.split("value", ","), F.lit(k)).alias(c) for k, c in enumerate(("mark", "raw_label", "text"))])
    first = _lines(spark, d, "first").where("name <> 'c4.csv'")
    stores.write_named(first, source)
    read = [stores.rescan(spark, source, store, parse)]
    second = _lines(spark, d, "second", F.col("arrival") % 2 == 0).where("name in ('c1.csv', 'c4.csv')")
    stores.write_named(second, source)
    read += [stores.rescan(spark, source, store, parse) for _ in range(2)]
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    rows = stores.scanned(spark, store).groupBy(name.alias("name"), "mark", "scan").agg(F.count("*").alias("n"), F.count_distinct("raw_label").alias("labels"))
    return rows.withColumn("files_read", F.lit(",".join(map(str, read))))


def str01_stream(spark, d):
    """Lines of new files alone, by a stream that is started again after more files came."""
    source, store = folder(spark, "files"), folder(spark, "stream")
    parse = lambda lines: lines.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.substring_index("value", ",", 1).alias("mark"))
    for mark, names in (("first", ("c0.csv", "c1.csv")), ("second", ("c2.csv", "c3.csv")), ("third", ())):
        stores.write_named(_lines(spark, d, mark).where(F.col("name").isin(*names)), source)
        stores.stream_new_lines(spark, source, store, parse)
    return spark.read.parquet(f"{store}/rows").groupBy("name", "mark").agg(F.count("*").alias("n"))


#: Header and fields of the six kinds of zone files, and of one that is none of them.
KINDS = (
    ("Timestamp,T_Actualvalue,T_Setvalue,T_Gain", ("actual", "setpoint", "gain")),
    ("Timestamp,CO2_Actualvalue,CO2_Setvalue,CO2_Gain", ("actual", "setpoint", "gain")),
    ("Timestamp,COOL_Gain", ("gain",)),
    ("Timestamp,VAV_Gain", ("gain",)),
    ("Timestamp,COOL_Setvalue,COOL_Gain", ("setpoint", "gain")),
    ("Timestamp,COOL_Actualvalue", ("actual",)),
    ("Timestamp,Sun", ("gain",)),
)


def zone_text(spark, d, triples: bool = False) -> str:
    """Zone grids written as files under ``Buildings/<b>/Thermal zone(s)/<zone>.csv``, a kind for each zone, or all as triples."""
    rows = zone_samples(spark, d)
    kind = F.lit(0) if triples else F.substring("zone", 2, 1).cast("int") % len(KINDS)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    line = None
    for k, (_, fields) in enumerate(KINDS):
        cells = F.concat_ws(",", time, *[text(c) for c in fields])
        line = F.when(kind == k, cells) if line is None else line.when(kind == k, cells)
    line = F.when(F.col("is_bad") & (kind < 2), F.concat_ws(",", time, F.lit("n/a"), F.lit("x"))).otherwise(line)
    name = F.format_string("Buildings/%s/Thermal zone(s)/%s.csv", "building", "zone")
    heads = F.array(*[F.lit(h) for h, _ in KINDS])
    body = rows.select(name.alias("name"), F.col("grid_idx").alias("n"), line.alias("line"))
    tops = rows.select(name.alias("name"), F.lit(0).cast("long").alias("n"), F.get(heads, kind).alias("line")).distinct()
    path = folder(spark, "zones")
    stores.write_named(body.unionByName(tops), path)
    return path


def src07(spark, d):
    """Zone files of three buildings found by place, told by header, of two buildings: kinds and rows."""
    lines = files.zone_files(spark, zone_text(spark, d), ["b0", "B1"])
    return lines.groupBy("building", "zone", "kind").agg(F.count("*").alias("n"))


def src10(spark, d):
    """Rows and rows with data of zone files that are no triples, and the first and last time with data."""
    return files.other_zones(files.zone_files(spark, zone_text(spark, d)))


def src09(spark, d):
    """Triple files as zone grids: rows, empty and unreadable ones, and sums of what could be read."""
    got = files.zone_samples(files.zone_files(spark, zone_text(spark, d, triples=True)))
    out = got.groupBy("building", "zone").agg(F.count("*").alias("n_grid"), F.count_if("is_empty").alias("n_empty"), F.count_if("is_bad").alias("n_bad"), F.sum("actual").alias("actual"), F.sum("setpoint").alias("setpoint"), F.sum("gain").alias("gain"))
    return rounded(out, "actual", "setpoint", "gain")


def win03(spark, d):
    """The number of each row of a zone file, from text whose splits are numbered by themselves."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = zone_text(spark, d, triples=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = staged(files.zone_samples(files.zone_files(spark, path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return got.where("not is_empty").select("building", "zone", "grid_idx", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


def srt01(spark, d):
    """Rows of the events numbered by value over the whole table."""
    e = table(spark, d, "events").select("event_id", "value")
    return order.numbered(e, [F.col("value"), F.col("event_id")], "rank").select("event_id", "rank")


def jon06_members(spark, d):
    return gp.memberships(pf.members(spark, d))


def jon06_table(spark, d):
    return gp.group_table(pf.members(spark, d))


def jon07_counts(spark, d):
    """Of each label of each group: how many others go with it, and the one that does most."""
    p = points(spark, d)
    flat = op.series_stats(p).where("distinct <= 1").select("raw_label")
    out = gp.correlation_counts(op.last_wins(p), pf.members(spark, d).where("kind <> 'same_equipment'"), flat)
    return rounded(out, "best_r")


QUERIES = {
    "snk02_proxy_batches": snk02,
    "snk04_node_merge": snk04,
    "snk05_approve": snk05,
    "str01_rescan": str01,
    "str01_stream_files": str01_stream,
    "src07_zone_files": src07,
    "src09_triple_files": src09,
    "src10_other_files": src10,
    "win03_grid_index": win03,
    "srt01_numbered": srt01,
    "jon06_memberships": jon06_members,
    "jon06_groups": jon06_table,
    "jon07_group_counts": jon07_counts,
}
TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
GRID = f"""gz AS (SELECT *, substr(zone, 2, 1)::INT % 7 AS k, {TIME} AS t FROM zs),
gk AS (SELECT *, CASE WHEN k = 0 THEN 't_triple' WHEN k = 1 THEN 'co2_triple' WHEN k = 2 THEN 'cool_gain' WHEN k = 3 THEN 'vav_gain' WHEN k = 4 THEN 'cool_set_gain' WHEN k = 5 THEN 'cool_actual' ELSE 'other' END AS kind,
  CASE WHEN is_bad AND k < 2 THEN true WHEN k < 2 THEN actual IS NOT NULL OR setpoint IS NOT NULL OR gain IS NOT NULL WHEN k = 4 THEN setpoint IS NOT NULL OR gain IS NOT NULL WHEN k = 5 THEN actual IS NOT NULL ELSE gain IS NOT NULL END AS data FROM gz)"""
SQL = {
    "snk02_proxy_batches": f"WITH {ZONES}, hp AS (SELECT building, zone, date_trunc('hour', ts) AS hour, avg(gain) AS mean_gain FROM zs WHERE gain IS NOT NULL GROUP BY 1, 2, 3) SELECT building, zone, CASE WHEN substr(zone, 2, 1)::INT % 2 = 0 THEN 'even' ELSE 'all' END AS batch, count(*) AS n, round(sum(mean_gain), 6) AS total FROM hp GROUP BY 1, 2, 3",
    "snk05_approve": pf.PROMO + " SELECT raw_label, component, CASE WHEN ascii(substr(raw_label, 11, 1)) % 2 = 0 THEN 'first' ELSE 'approval' END AS batch FROM ok JOIN dd USING (raw_label) WHERE ascii(substr(raw_label, 11, 1)) % 2 = 0 OR contains(raw_label, '/Loop.3')",
    "str01_rescan": f"WITH {POINTS}, f AS (SELECT *, 'c' || substr(raw_label, 11, 1) || '.csv' AS name FROM pts), r AS (SELECT name, 'first' AS mark, 0 AS scan, raw_label FROM f WHERE name NOT IN ('c1.csv', 'c4.csv') UNION ALL SELECT name, 'second', 1, raw_label FROM f WHERE name IN ('c1.csv', 'c4.csv') AND arrival % 2 = 0) SELECT name, mark, scan, count(*) AS n, count(DISTINCT raw_label) AS labels, '4,2,0' AS files_read FROM r GROUP BY 1, 2, 3",
    "str01_stream_files": f"WITH {POINTS}, f AS (SELECT 'c' || substr(raw_label, 11, 1) || '.csv' AS name FROM pts) SELECT name, CASE WHEN name < 'c2' THEN 'first' ELSE 'second' END AS mark, count(*) AS n FROM f WHERE name < 'c4' GROUP BY 1",
    "src07_zone_files": f"WITH {ZONES}, {GRID} SELECT building, zone, kind, count(*) AS n FROM gk WHERE building IN ('B0', 'B1') GROUP BY 1, 2, 3",
    "src09_triple_files": f"WITH {ZONES} SELECT building, zone, count(*) AS n_grid, count(*) FILTER (NOT is_bad AND actual IS NULL AND setpoint IS NULL AND gain IS NULL) AS n_empty, count(*) FILTER (is_bad) AS n_bad, round(sum(actual), 6) AS actual, round(sum(setpoint), 6) AS setpoint, round(sum(gain), 6) AS gain FROM zs GROUP BY 1, 2",
    "src10_other_files": f"WITH {ZONES}, {GRID} SELECT building, zone, kind, count(*) AS n_grid, count(*) FILTER (data) AS n_data, min_by(t, grid_idx) FILTER (data) AS first_ts, max_by(t, grid_idx) FILTER (data) AS last_ts FROM gk WHERE kind <> 't_triple' GROUP BY 1, 2, 3",
    "win03_grid_index": f"WITH {ZONES} SELECT building, zone, grid_idx, {TIME} AS ts FROM zs WHERE is_bad OR actual IS NOT NULL OR setpoint IS NOT NULL OR gain IS NOT NULL",
    "srt01_numbered": "SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS rank FROM events",
    "jon06_memberships": f"WITH {POINTS}, {pf.MEMBERS} SELECT raw_label, kind, key, count(*) OVER (PARTITION BY kind, key) - 1 AS others FROM mm QUALIFY others > 0",
    "jon06_groups": f"WITH {POINTS}, {pf.MEMBERS} SELECT kind, key, count(*) AS n FROM mm GROUP BY 1, 2 HAVING count(*) > 1",
    "jon07_group_counts": f"""WITH {POINTS}, {STATS_SQL}, {LAST}, {pf.MEMBERS}, lv AS (SELECT mm.* FROM mm JOIN st USING (raw_label) WHERE kind <> 'same_equipment' AND NOT coalesce("distinct" <= 1, false)),
pr AS (SELECT a.kind, a.key, a.raw_label AS a, b.raw_label AS b FROM lv a JOIN lv b ON a.kind = b.kind AND a.key = b.key AND a.raw_label <> b.raw_label),
un AS (SELECT DISTINCT a, b FROM pr),
co AS (SELECT a, b, {PEARSON_SQL.format(x="x.value", y="y.value")} AS r FROM un JOIN lw x ON x.raw_label = a JOIN lw y ON y.raw_label = b AND y.ts_text = x.ts_text GROUP BY 1, 2)
SELECT kind, key, a AS raw_label, count(*) FILTER (abs(r) >= 0.3) AS supported, count(*) FILTER (abs(r) < 0.3) AS no_signal, count(*) FILTER (r IS NULL) AS skipped,
  arg_min(b, {{'size': -abs(round(r, 6)), 'b': b}}) FILTER (r IS NOT NULL) AS best, round(arg_min(r, {{'size': -abs(round(r, 6)), 'b': b}}) FILTER (r IS NOT NULL), 6) AS best_r FROM pr JOIN co USING (a, b) GROUP BY 1, 2, 3""",
    "snk04_node_merge": f"WITH {ZONES}, {ZSTATS_SQL}, {REGIME_SQL} SELECT building || '/' || zone AS id, 'Zone' AS label, CASE WHEN regime <> 'binary' THEN 'checked ' ELSE '' END || regime AS regime, CASE WHEN regime <> 'binary' THEN 2 ELSE 1 END AS version FROM rg",
}
