"""Readers of point series, zone grids, weather, meters, reference tables and indexes; sinks of results."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import control_numbers, iso_date
from ..functions.numbers import parse_number
from ..operators.order import split_numbers

LINE = r"^(.*),([^,]*),([^,]*)$"
#: Readings at or below this stand for none.
SENTINEL = -900.0
# The columns that tell a zone file's kind.
HEADERS = {
    "t_triple": ("Timestamp", "T_Actualvalue", "T_Setvalue", "T_Gain"),
    "co2_triple": ("Timestamp", "CO2_Actualvalue", "CO2_Setvalue", "CO2_Gain"),
    "cool_gain": ("Timestamp", "COOL_Gain"),
    "vav_gain": ("Timestamp", "VAV_Gain"),
    "cool_set_gain": ("Timestamp", "COOL_Setvalue", "COOL_Gain"),
    "cool_actual": ("Timestamp", "COOL_Actualvalue"),
}


def decoded_path(path: Column) -> Column:
    """A path without escapes; a plus stands for itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_name() -> Column:
    """The name of a row's file, decoded."""
    return decoded_path(F.col("_metadata.file_name"))


def arrival() -> Column:
    """Sorts rows as they arrive: by file, split of the file, and line."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))


def text_lines(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.text(list(paths)).withColumns({"file": file_name(), "path": F.col("_metadata.file_path"), "arrival": arrival()})


def point_lines(spark: SparkSession, *paths: str, labels: DataFrame | None = None) -> DataFrame:
    """``(raw_label, ts_text, value, arrival, file, file_kind, malformed)`` of headerless ``label,timestamp,value`` lines.

    The label may hold commas, so the last two part the fields; a line with fewer is malformed, its label the whole line.
    ``labels``: only series in this table.
    """
    rows = text_lines(spark, *paths).where(F.trim("value") != "")
    text = F.col("value")
    bad = ~text.rlike(",.*,")
    kind = F.nullif(F.upper(F.regexp_extract("file", r"(?i)\b(AV|BV)\s+punkter\b", 1)), F.lit(""))
    out = rows.select(
        F.when(bad, text).otherwise(F.regexp_extract(text, LINE, 1)).alias("raw_label"),
        F.when(~bad, F.trim(F.regexp_extract(text, LINE, 2))).alias("ts_text"),
        F.when(~bad, parse_number(F.regexp_extract(text, LINE, 3))).alias("value"),
        "arrival",
        "file",
        kind.alias("file_kind"),
        bad.alias("malformed"),
    )
    return out.join(labels.select("raw_label").distinct(), "raw_label", "left_semi") if labels is not None else out


def suspicious(labels: DataFrame) -> DataFrame:
    """Shares of distinct labels that look like unsplit lines, and whether they are too many."""
    d = labels.select("raw_label").distinct()
    semi, glued = F.col("raw_label").contains(";"), F.col("raw_label").contains(",") & F.col("raw_label").rlike(r"\d{4}-\d{2}-\d{2}")
    out = d.agg(F.avg(semi.cast("int")).alias("semicolon"), F.avg(glued.cast("int")).alias("glued_date"))
    return out.withColumn("warning", (F.col("semicolon") > 0.5) | (F.col("glued_date") > 0.2))


def zone_files(spark: SparkSession, root: str, buildings: list[str] | None = None) -> DataFrame:
    """Lines of ``Buildings/<b>/Thermal zone(s)/<zone>.csv`` with building, zone and the kind its header tells."""
    rows = text_lines(spark, f"{root}/Buildings/*/[Tt]hermal*/*.csv")
    path = decoded_path(F.col("path"))
    rows = rows.withColumns({"building": F.regexp_extract(path, r"Buildings/([^/]+)/", 1), "zone": F.regexp_extract(path, r"([^/]+)\.csv$", 1)})
    if buildings:
        rows = rows.where(F.lower("building").isin(*[b.lower() for b in buildings]))
    rows = rows.withColumns({"block": F.col("arrival.block"), "id": F.col("arrival.line")})
    rows = split_numbers(rows, "path")
    heads = rows.where("line = 1").select("path", F.col("value").alias("header"))
    columns = F.transform(F.split(F.regexp_replace("header", "^﻿", ""), ","), lambda c: F.trim(c))
    kind = F.lit("other")
    for name, want in HEADERS.items():
        kind = F.when(columns == F.array(*[F.lit(w) for w in want]), name).otherwise(kind)
    return rows.join(heads.select("path", kind.alias("kind")), "path").where("line > 1").drop("block", "id")


def zone_samples(lines: DataFrame) -> DataFrame:
    """Zone grids from the lines of triple files; a row without readings is empty, one that cannot be read is bad.

    The grid index is the line's number after the header, counted per split of a file: no task holds a whole zone.
    """
    parts = F.split(F.rtrim("value"), ",")
    rows = lines.where("kind = 't_triple'").withColumn("_p", parts)
    raw = [F.trim(F.get("_p", F.lit(k))) for k in (1, 2, 3)]
    num = [parse_number(r) for r in raw]
    empty = F.col("value").rlike(",,,\\s*$")
    bad = ~empty & ((F.size("_p") < 4) | F.greatest(*[(r != "") & n.isNull() for r, n in zip(raw, num)]))
    rows = rows.withColumns({"is_empty": empty, "is_bad": F.coalesce(bad, F.lit(True))})
    good = ~F.col("is_empty") & ~F.col("is_bad")
    values = {c: F.when(good, n) for c, n in zip(("actual", "setpoint", "gain"), num)}
    ts = F.get("_p", F.lit(0)).try_cast("timestamp")
    return rows.withColumns({"ts": ts, **values, "grid_idx": F.col("line") - 1}).select("building", "zone", "kind", "ts", "actual", "setpoint", "gain", "grid_idx", "is_empty", "is_bad")


def other_zones(lines: DataFrame) -> DataFrame:
    """Grid rows, rows with data and their first and last time, of zone files of other kinds."""
    data = F.regexp_replace("value", "^[^,]*", "").rlike("[^,\\s]")
    rows = lines.where("kind <> 't_triple'").withColumn("_t", F.when(data, F.substring_index("value", ",", 1)))
    return rows.groupBy("building", "zone", "kind").agg(F.count("*").alias("n_grid"), F.count("_t").alias("n_data"), F.min_by("_t", F.when(F.col("_t").isNotNull(), F.col("arrival"))).alias("first_ts"), F.max_by("_t", F.when(F.col("_t").isNotNull(), F.col("arrival"))).alias("last_ts"))


def daily_weather(rows: DataFrame, column: str = "Air temperature") -> DataFrame:
    """Daily means of ``rows`` whose first column is the time; sentinels and what cannot be read are left out."""
    value = parse_number(F.col(f"`{column}`"))
    return rows.select(iso_date(F.col(f"`{rows.columns[0]}`")).cast("date").alias("day"), value.alias("v")).where((F.col("v") > SENTINEL) & F.col("day").isNotNull()).groupBy("day").agg(F.avg("v").alias("temp"))


def weather_daily(spark: SparkSession, path: str, column: str = "Air temperature") -> DataFrame:
    return daily_weather(spark.read.option("header", True).csv(path), column)


def daily_meter(rows: DataFrame, column: str = "main", by: str | None = None) -> DataFrame:
    """Daily sums of ``rows`` whose first column but ``by`` is the time, in either date form, under any name; empty values are left out."""
    time = next(c for c in rows.columns if c != by)
    keys = [by] if by else []
    return rows.select(*keys, iso_date(F.col(f"`{time}`")).cast("date").alias("day"), parse_number(F.col(f"`{column}`")).alias("v")).where("v is not null and day is not null").groupBy(*keys, "day").agg(F.sum("v").alias("energy"))


def meter_daily(spark: SparkSession, path: str, column: str = "main", by_building: bool = False) -> DataFrame:
    """Daily sums of meter files; ``by_building``: of all files of ``Buildings/<b>/Meters/`` under ``path``, by building."""
    if not by_building:
        return daily_meter(spark.read.option("header", True).csv(path), column)
    rows = spark.read.option("header", True).csv(f"{path}/Buildings/*/Meters/*.csv")
    return daily_meter(rows.withColumn("building", F.regexp_extract(decoded_path(F.col("_metadata.file_path")), r"Buildings/([^/]+)/", 1)), column, "building")


def table_lines(spark: SparkSession, path: str) -> DataFrame:
    """Numbered lines of one small reference file."""
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line", "text"))


def component_codes(spark: SparkSession, path: str) -> DataFrame:
    """Letters and meaning of bold pipe-table rows; the first row of a code counts, unused ones are left out."""
    rows = table_lines(spark, path)
    code = F.regexp_extract("text", r"^\|\*\*([A-ZÆØÅ]{1,2})\*\*\|", 1)
    meaning = F.trim(F.regexp_replace(F.regexp_extract("text", r"^\|\*\*[A-ZÆØÅ]{1,2}\*\*\|([^|]*)\|", 1), r"<br>|\*\*", " "))
    rows = rows.select("line", code.alias("code"), meaning.alias("meaning")).where("code <> '' and meaning <> ''").where(~F.lower("meaning").rlike("ikke i bruk|bør ikke brukes"))
    return rows.groupBy("code").agg(F.min_by("meaning", "line").alias("meaning"), (F.min("line") + 1).alias("line"))


def system_codes(spark: SparkSession, path: str) -> DataFrame:
    """Numbers and names of HTML table cells that start with two or three digits; the first cell of a number counts."""
    html = spark.read.text(path, wholetext=True)
    rows = html.select(F.posexplode(F.regexp_extract_all("value", F.lit(r"(?s)<t[dh]>(.*?)</t[dh]>"), F.lit(1))).alias("pos", "cell"))
    cell = F.trim(F.regexp_replace("cell", "<[^>]*>", " "))
    rows = rows.select("pos", F.regexp_extract(cell, r"^(\d{2,3})\s+\S", 1).alias("code"), F.trim(F.regexp_extract(cell, r"^\d{2,3}\s+(.*)$", 1)).alias("name")).where("code <> ''")
    return rows.groupBy("code").agg(F.min_by("name", "pos").alias("name"))


def area_map(spark: SparkSession, path: str) -> DataFrame:
    rows = table_lines(spark, path).select("line", F.regexp_extract("text", r"^\|\s*(\d{8})\s*\|\s*([^|]+?)\s*\|", 1).alias("control_number"), F.regexp_extract("text", r"^\|\s*(\d{8})\s*\|\s*([^|]+?)\s*\|", 2).alias("area")).where("control_number <> ''")
    return rows.groupBy("control_number").agg(F.max_by("area", "line").alias("area"))


def area_of_files(files: DataFrame) -> DataFrame:
    """``files(path, name)``: control numbers in file names, their area (the folder), and conflicts between folders."""
    rows = files.select("path", "name", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("area"), F.explode(control_numbers(F.col("name"))).alias("control_number"))
    return rows.groupBy("control_number").agg(F.min_by("area", "path").alias("area"), F.sort_array(F.collect_set("name")).alias("files"), (F.count_distinct("area") > 1).alias("conflict"))


def label_batch(spark: SparkSession, path: str, source_type: str) -> DataFrame:
    """Labels to decode: a line each, maybe after a count and a tab; blank and repeated lines dropped."""
    rows = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"^\s*\d+\t", "")).alias("raw_label")).where("raw_label <> ''")
    return rows.dropDuplicates(["raw_label"]).withColumn("source_type", F.lit(source_type))


def json_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines under a schema; blank lines are skipped, and a line that does not parse is an error that names its file."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def triple_rows(spark: SparkSession, *paths: str) -> DataFrame:
    """``(s, p, o)`` of N-Triples lines."""
    pattern = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"\S*)\s*\.\s*$'
    part = lambda k: F.nullif(F.regexp_extract("value", pattern, k), F.lit(""))
    return spark.read.text(list(paths)).where(F.col("value").rlike(pattern)).select(part(1).alias("s"), part(2).alias("p"), F.coalesce(part(3), part(4)).alias("o"))


def rules(spark: SparkSession, path: str) -> dict:
    """A small JSON file of rules or thresholds as a dictionary; keys that start with ``_`` are comments, nulls say nothing."""

    def plain(x):
        return {k: plain(v) for k, v in x.items() if not k.startswith("_") and v is not None} if isinstance(x, dict) else x

    return plain(json.loads(spark.read.text(path, wholetext=True).first()[0]))


def write_rows(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """A result table in place of what was there: Parquet or JSON lines."""
    rows.write.mode("overwrite").format(form).save(path)


def changed_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``files(path, size, modified)`` that ``manifest`` lacks as they are now."""
    return files.join(manifest, ["path", "size", "modified"], "left_anti")


def write_new_zones(rows: DataFrame, path: str) -> None:
    """Appends zones that the table at ``path`` lacks, by building."""
    spark = rows.sparkSession
    try:
        have = spark.read.parquet(path).select("building", "zone").distinct()
        rows = rows.join(have, ["building", "zone"], "left_anti")
    except Exception as e:  # a first write finds no table
        if "PATH_NOT_FOUND" not in str(e):
            raise
    rows.write.mode("append").partitionBy("building").parquet(path)


def write_graphs(lines: DataFrame, path: str) -> None:
    """N-Triples text, one folder per graph."""
    lines.write.mode("overwrite").partitionBy("graph").text(path)
