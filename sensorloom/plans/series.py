"""Queries over point series, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import pearson
from ..operators import series as op
from .views import POINTS, points


def rounded(df, *names, places: int = 6):
    return df.withColumns({n: F.round(n, places) for n in names})


def agg01(spark, d):
    return op.label_counts(points(spark, d))


def agg03(spark, d):
    out = rounded(op.series_stats(points(spark, d)), "mean", "std", "zero_fraction")
    return out.withColumns({"values": F.array_join(F.transform("values", lambda v: F.floor(v).cast("string")), ","), "files": F.array_join("files", ","), "file_kinds": F.array_join("file_kinds", ",")})


STRAY_SQL = """
num AS (SELECT *, max(ts_text) OVER (PARTITION BY raw_label ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM pts WHERE value IS NOT NULL),
acc AS (SELECT *, coalesce(ts_text < top, false) AS stray FROM num),
dec AS (SELECT *, NOT stray AND coalesce(value < lag(value) OVER (PARTITION BY raw_label, stray ORDER BY arrival), false) AS decrease FROM acc)"""
STATS_SQL = f"""{STRAY_SQL},
ord AS (SELECT raw_label, count(*) FILTER (stray) AS out_of_order, count(*) FILTER (decrease) AS n_decreases FROM dec GROUP BY 1),
base AS (SELECT raw_label, count(*) AS n_rows, count(*) - count(value) AS n_bad, min(ts_text) AS first_ts, max(ts_text) AS last_ts, count(value) AS n_num, min(value) AS min, max(value) AS max,
  avg(value) AS mean, CASE WHEN count(value) > 0 THEN coalesce(stddev_samp(value), 0) END AS std, avg((value = 0)::INT) AS zero_fraction,
  CASE WHEN count(value) > 0 THEN count(*) FILTER (value < 0) END AS n_negative, string_agg(DISTINCT file, ',' ORDER BY file) AS files, string_agg(DISTINCT file_kind, ',' ORDER BY file_kind) AS file_kinds,
  count(DISTINCT value) AS dv FROM pts GROUP BY 1),
vals AS (SELECT raw_label, string_agg(floor(v)::BIGINT::VARCHAR, ',' ORDER BY v) AS values FROM (SELECT DISTINCT raw_label, value AS v FROM pts WHERE value IS NOT NULL) GROUP BY 1),
st AS (SELECT b.raw_label, n_rows, n_bad, first_ts, last_ts, n_num, min, max, mean, std, zero_fraction, n_negative, files, file_kinds,
  coalesce(out_of_order, 0) AS out_of_order, CASE WHEN n_num > 0 THEN coalesce(n_decreases, 0) END AS n_decreases,
  CASE WHEN dv <= 32 THEN dv END AS "distinct", CASE WHEN n_num = 0 THEN '' WHEN dv <= 8 THEN v.values END AS values,
  CASE WHEN n_num > 0 THEN dv IN (1, 2) END AS is_binary, CASE WHEN n_num > 1 THEN n_decreases = 0 END AS monotonic
  FROM base b LEFT JOIN ord o USING (raw_label) LEFT JOIN vals v USING (raw_label))"""

AGG03_SQL = f"""WITH {POINTS}, {STATS_SQL}
SELECT raw_label, n_rows, n_bad, first_ts, last_ts, n_num, min, max, round(mean, 6) AS mean, round(std, 6) AS std, round(zero_fraction, 6) AS zero_fraction, n_negative, files, file_kinds,
  out_of_order, n_decreases, "distinct", values, is_binary, monotonic FROM st"""


def win01(spark, d):
    return op.ordered_rows(points(spark, d)).where("stray or decrease").select("raw_label", "arrival", "ts_text", "value", "stray", "decrease")


def agg04(spark, d):
    return rounded(op.monthly_profile(points(spark, d)), "mean", "amplitude")


LAST = "lw AS (SELECT raw_label, ts_text, max_by(value, arrival) AS value FROM pts WHERE value IS NOT NULL GROUP BY 1, 2)"


def agg05(spark, d):
    return op.last_wins(points(spark, d))


#: The reference series of the correlation queries: part of exactly one label.
REFERENCE = "N1:70010001-OU001/Loop.360002.-RT501_SP"


def reference(series, labels):
    name = op.resolve_reference(labels, REFERENCE)
    return series.where(F.col("raw_label") == name).select("ts_text", F.col("value").alias("ref"))


def agg06(spark, d):
    p = points(spark, d)
    s = op.last_wins(p)
    return rounded(op.correlate_with(s, reference(s, p)), "r")


PEARSON_SQL = "CASE WHEN count(*) >= 2 AND min({x}) < max({x}) AND min({y}) < max({y}) THEN covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END"
AGG06_SQL = f"""WITH {POINTS}, {LAST}, ref AS (SELECT ts_text, value AS ref FROM lw WHERE raw_label = '{REFERENCE}')
SELECT raw_label, count(*) AS n, round({PEARSON_SQL.format(x="value", y="ref")}, 6) AS r FROM lw JOIN ref USING (ts_text) GROUP BY 1"""


def jon03(spark, d):
    """Correlation of the pairs of a controller's and system's series at equal timestamps."""
    s = op.last_wins(points(spark, d))
    group = F.regexp_extract("raw_label", r"^[^.]*\.[^.]*", 0)
    labels = s.select("raw_label").distinct().withColumn("g", group)
    pairs = labels.alias("l").join(labels.alias("r"), (F.col("l.g") == F.col("r.g")) & (F.col("l.raw_label") < F.col("r.raw_label"))).select(F.col("l.raw_label").alias("a"), F.col("r.raw_label").alias("b"))
    out = op.aligned_pairs(s, pairs).groupBy("a", "b").agg(F.count("*").alias("n"), pearson("x", "y").alias("r"), F.when(F.count("*") >= 2, F.avg((F.col("x") > F.col("y")).cast("int"))).alias("above"))
    return rounded(out, "r", "above")


JON03_SQL = f"""WITH {POINTS}, {LAST}, lb AS (SELECT DISTINCT raw_label, regexp_extract(raw_label, '^[^.]*\\.[^.]*', 0) AS g FROM lw)
SELECT l.raw_label AS a, r.raw_label AS b, count(*) AS n, round({PEARSON_SQL.format(x="x.value", y="y.value")}, 6) AS r, round(CASE WHEN count(*) >= 2 THEN avg((x.value > y.value)::INT) END, 6) AS above
FROM lb l JOIN lb r ON l.g = r.g AND l.raw_label < r.raw_label JOIN lw x ON x.raw_label = l.raw_label JOIN lw y ON y.raw_label = r.raw_label AND y.ts_text = x.ts_text GROUP BY 1, 2"""

QUERIES = {
    "agg01_label_counts": agg01,
    "agg03_series_stats": agg03,
    "win01_stray_rows": win01,
    "agg04_monthly_profile": agg04,
    "agg05_last_wins": agg05,
    "agg06_pearson_reference": agg06,
    "jon03_pair_correlation": jon03,
}
SQL = {
    "agg01_label_counts": f"WITH {POINTS} SELECT raw_label, count(*) AS n FROM pts GROUP BY 1",
    "agg03_series_stats": AGG03_SQL,
    "win01_stray_rows": f"WITH {POINTS}, {STRAY_SQL} SELECT raw_label, arrival, ts_text, value, stray, decrease FROM dec WHERE stray OR decrease",
    "agg04_monthly_profile": f"WITH {POINTS}, {LAST}, m AS (SELECT raw_label, substr(ts_text, 6, 2) AS month, avg(value) AS mean, count(*) AS n, min(value) AS min, max(value) AS max FROM lw GROUP BY 1, 2) SELECT raw_label, month, round(mean, 6) AS mean, n, min, max, round(max(mean) OVER (PARTITION BY raw_label) - min(mean) OVER (PARTITION BY raw_label), 6) AS amplitude FROM m",
    "agg05_last_wins": f"WITH {POINTS}, {LAST} SELECT * FROM lw",
    "agg06_pearson_reference": AGG06_SQL,
    "jon03_pair_correlation": JON03_SQL,
}
