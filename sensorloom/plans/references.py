"""Queries of reference files (codes, systems, areas, rules) and result files, written from the tables and read again, with their SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..sources import files, stores
from .stores import folder
from .views import table


def _file(spark, rows, name: str) -> str:
    """A text file of ``rows(n, line)``."""
    path = folder(spark, "reference")
    stores.write_named(rows.select(F.lit(name).alias("name"), "n", "line"), path)
    return f"{path}/{name}"


def _keys(spark, d, name: str, key: str):
    return table(spark, d, name).select(F.col(key).cast("long").alias("n"))


def src14(spark, d):
    """Component letters from a pipe table: repeated, unused and empty ones occur."""
    letters = F.concat(F.char((F.col("n") % 26 + 65).cast("int")), F.when(F.col("n") % 3 == 0, F.lit("")).otherwise(F.char((F.floor(F.col("n") / 26) % 26 + 65).cast("int"))))
    meaning = F.when(F.col("n") % 5 == 0, "Ikke i bruk").when(F.col("n") % 7 == 0, " ").otherwise(F.concat(F.lit("Del"), F.lit("<br>"), F.col("n").cast("string")))
    line = F.when(F.col("n") % 11 == 0, F.lit("| --- | --- |")).otherwise(F.concat(F.lit("|**"), letters, F.lit("**|"), meaning, F.lit("|")))
    return files.component_codes(spark, _file(spark, _keys(spark, d, "part", "p_partkey").withColumn("line", line), "codes.md"))


def src15(spark, d):
    """System numbers from cells of an HTML table; the first cell of a number counts."""
    number = F.when(F.col("n") % 4 == 0, 10 + F.col("n") % 80).otherwise(100 + F.col("n") % 300)
    cell = F.when(F.col("n") % 9 == 0, F.lit("no number")).otherwise(F.concat(F.lit("<b>"), number.cast("string"), F.lit("</b> System "), F.col("n").cast("string")))
    line = F.concat(F.lit("<tr><td>"), cell, F.lit("</td><td>x</td></tr>"))
    return files.system_codes(spark, _file(spark, _keys(spark, d, "part", "p_partkey").withColumn("line", line), "systems.html"))


def src16(spark, d):
    """Areas of control numbers from a pipe table; the last row of a number counts."""
    number = F.lpad((70010000 + F.col("n") % 50).cast("string"), F.when(F.col("n") % 6 == 0, 7).otherwise(8), "0")
    line = F.concat(F.lit("| "), number, F.lit(" | area "), F.col("n").cast("string"), F.lit(" |"))
    return files.area_map(spark, _file(spark, _keys(spark, d, "part", "p_partkey").withColumn("line", line), "areas.md"))


def src17(spark, d):
    """A rule file with comments and nulls, a rule for each nation: what is left of it."""
    nation = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n"), "n_name")
    member = F.to_json(F.struct(F.col("n_name").alias("function"), F.when(F.col("n") % 2 == 0, F.col("n")).alias("limit"), F.lit("why").alias("_source")), {"ignoreNullFields": "false"})
    line = F.concat(F.when(F.col("n") == 0, F.lit("{")).otherwise(F.lit(",")), F.lit('"'), F.when(F.col("n") % 7 == 1, "_").otherwise(""), F.lit("rule"), F.col("n").cast("string"), F.lit('": '), member)
    tail = nation.agg((F.max("n") + 1).alias("n")).withColumn("line", F.lit("}"))
    found = files.rules(spark, _file(spark, nation.withColumn("line", line).select("n", "line").unionByName(tail), "rules.json"))
    return spark.createDataFrame([(k, json.dumps(v, sort_keys=True)) for k, v in found.items()], "rule string, says string")


def scl11(spark, d):
    """Shares of labels that look like unsplit lines."""
    k = F.col("n")
    label = F.when(k % 3 == 0, F.concat(F.lit("a;b"), k.cast("string"))).when(k % 4 == 0, F.concat(F.lit("x,2024-01-02,"), k.cast("string"))).otherwise(F.concat(F.lit("L"), (k % 100).cast("string")))
    out = files.suspicious(_keys(spark, d, "part", "p_partkey").select(label.alias("raw_label")))
    return out.select(F.round("semicolon", 6).alias("semicolon"), F.round("glued_date", 6).alias("glued_date"), "warning")


def snk01(spark, d):
    """A result table as JSON lines that replaces an older one, read again under its schema."""
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("id"), "s_name", F.struct(F.col("s_nationkey").cast("long").alias("nation"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")).alias("balance")).alias("place"))
    path = f"{folder(spark, 'result')}/rows"
    files.write_rows(rows.limit(3), path, "json")
    files.write_rows(rows, path, "json")
    return files.json_rows(spark, path, "id long, s_name string, place struct<nation:long,balance:double>").select("id", "s_name", "place.nation", "place.balance")


QUERIES = {"src14_component_codes": src14, "src15_system_codes": src15, "src16_area_map": src16, "src17_rules": src17, "scl11_suspicious": scl11, "snk01_result_rows": snk01}
PARTS = "SELECT p_partkey AS n, row_number() OVER (ORDER BY p_partkey) AS line FROM part"
SQL = {
    "src14_component_codes": f"SELECT code, 'Del ' || min(n) AS meaning, min(line)::INT AS line FROM (SELECT chr((n % 26 + 65)::INT) || CASE WHEN n % 3 = 0 THEN '' ELSE chr((n // 26 % 26 + 65)::INT) END AS code, n, line FROM ({PARTS}) WHERE n % 5 <> 0 AND n % 7 <> 0 AND n % 11 <> 0) GROUP BY 1",
    "src15_system_codes": f"SELECT code, 'System ' || min(n) AS name FROM (SELECT CASE WHEN n % 4 = 0 THEN 10 + n % 80 ELSE 100 + n % 300 END::VARCHAR AS code, n FROM ({PARTS}) WHERE n % 9 <> 0) GROUP BY 1",
    "src16_area_map": f"SELECT (70010000 + n % 50)::VARCHAR AS control_number, 'area ' || max(n) AS area FROM ({PARTS}) WHERE n % 6 <> 0 GROUP BY 1",
    "src17_rules": "SELECT 'rule' || n_nationkey AS rule, '{\"function\": \"' || n_name || '\"' || CASE WHEN n_nationkey % 2 = 0 THEN ', \"limit\": ' || n_nationkey ELSE '' END || '}' AS says FROM nation WHERE n_nationkey % 7 <> 1",
    "scl11_suspicious": "WITH l AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN 'a;b' || p_partkey WHEN p_partkey % 4 = 0 THEN 'x,2024-01-02,' || p_partkey ELSE 'L' || (p_partkey % 100) END AS x FROM part), s AS (SELECT avg(contains(x, ';')::INT) AS a, avg((contains(x, ',') AND regexp_matches(x, '\\d{4}-\\d{2}-\\d{2}'))::INT) AS b FROM l) SELECT round(a, 6) AS semicolon, round(b, 6) AS glued_date, a > 0.5 OR b > 0.2 AS warning FROM s",
    "snk01_result_rows": "SELECT s_suppkey AS id, s_name, s_nationkey::BIGINT AS nation, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS balance FROM supplier",
}
