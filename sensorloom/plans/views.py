"""The engine's input shapes as views of plain arithmetic over the star-schema tables, for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point samples: 300 labels; every 11th row is five days late, every 97th value unreadable; counters, binaries and constants occur."""
    e = table(spark, sf_dir, "events")
    u = F.col("user_id") % 150
    label = F.expr("""concat('N1:7001000', cast(user_id % 5 as string), '-OU00', cast(user_id % 7 as string), '/Loop.', case user_id % 3 when 0 then '320001' when 1 then '360002' else '370003' end, '.-', case when user_id % 4 = 3 then 'SB' else 'RT' end, cast(400 + 100 * (user_id % 2) + (user_id % 150) % 60 as string), case when event_id % 2 = 0 then '' else '_SP' end)""")
    late = F.when(F.col("event_id") % 11 == 0, F.expr("ts - interval 5 days")).otherwise(F.col("ts"))
    value = (
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("double"))
        .when(u % 6 == 0, (F.col("event_id") % 4 == 0).cast("double"))
        .when(u % 6 == 1, F.col("event_id").cast("double"))
        .when(u % 6 == 2, F.lit(21.5))
        .otherwise(F.floor("value") - 20.0)
    )
    return e.select(
        label.alias("raw_label"),
        F.date_format(F.date_trunc("hour", late), "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        value.alias("value"),
        F.col("event_id").alias("arrival"),
        F.format_string("file%d %s punkter.csv", F.col("user_id") % 4, F.when(F.col("user_id") % 2 == 0, "AV").otherwise("BV")).alias("file"),
        F.when(F.col("user_id") % 2 == 0, "AV").otherwise("BV").alias("file_kind"),
    )


POINTS = """pts AS (SELECT 'N1:7001000' || (user_id % 5) || '-OU00' || (user_id % 7) || '/Loop.' || CASE user_id % 3 WHEN 0 THEN '320001' WHEN 1 THEN '360002' ELSE '370003' END
  || '.-' || CASE WHEN user_id % 4 = 3 THEN 'SB' ELSE 'RT' END || (400 + 100 * (user_id % 2) + (user_id % 150) % 60) || CASE WHEN event_id % 2 = 0 THEN '' ELSE '_SP' END AS raw_label,
  strftime(date_trunc('hour', CASE WHEN event_id % 11 = 0 THEN ts - INTERVAL 5 DAY ELSE ts END), '%Y-%m-%d %H:%M:%S') AS ts_text,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN (user_id % 150) % 6 = 0 THEN CASE WHEN event_id % 4 = 0 THEN 1.0 ELSE 0.0 END WHEN (user_id % 150) % 6 = 1 THEN event_id::DOUBLE
       WHEN (user_id % 150) % 6 = 2 THEN 21.5 ELSE floor(value) - 20.0 END::DOUBLE AS value,
  event_id AS arrival, 'file' || (user_id % 4) || ' ' || CASE WHEN user_id % 2 = 0 THEN 'AV' ELSE 'BV' END || ' punkter.csv' AS file,
  CASE WHEN user_id % 2 = 0 THEN 'AV' ELSE 'BV' END AS file_kind FROM events)"""


def zone_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone grids: ten zones in three buildings; a schedule of set points, free decay at night, gaps and unreadable rows."""
    e = table(spark, sf_dir, "events")
    z, h = F.col("user_id") % 10, F.hour("ts")
    night = (h >= 21) | (h < 5)
    empty, bad = F.col("event_id") % 13 == 0, F.col("event_id") % 101 == 0
    gone = empty | bad
    actual = F.when(night, 21.0 - 0.4 * ((h + 3) % 24)).otherwise(F.lit(20.5)) + (F.col("event_id") % 5) * 0.05
    phase = F.col("event_id") % 4000
    actual = F.when(z == 4, 18.0 + F.when(phase < 2000, 0.0).otherwise(F.least(F.lit(3.0), (phase - 2000) / 250.0))).otherwise(actual)
    gain = F.when(z == 4, F.when(phase < 2000, 0.0).otherwise(80.0)).when(night, F.when(F.col("event_id") % 50 == 1, 30.0).otherwise(0.0)).when(z % 3 == 0, F.when(F.col("event_id") % 2 == 0, 100.0).otherwise(0.0)).when(z == 7, 0.0).otherwise((F.col("event_id") % 97).cast("double"))
    order = Window.partitionBy(z).orderBy("ts", "event_id")
    return e.select(
        F.concat(F.lit("B"), (z % 3).cast("string")).alias("building"),
        F.concat(F.lit("Z"), z.cast("string")).alias("zone"),
        "ts",
        F.when(~gone & (F.col("event_id") % 17 != 0), actual).alias("actual"),
        F.when(~gone & (F.col("event_id") % 23 != 0), F.when(night & (z != 4), 17.0).otherwise(21.0)).alias("setpoint"),
        F.when(~gone & (F.col("event_id") % 19 != 0), gain).alias("gain"),
        F.row_number().over(order).cast("bigint").alias("grid_idx"),
        empty.alias("is_empty"),
        (bad & ~empty).alias("is_bad"),
    )


ZONES = """zs AS (SELECT 'B' || (z % 3) AS building, 'Z' || z AS zone, ts,
  CASE WHEN NOT gone AND event_id % 17 <> 0 THEN CASE WHEN z = 4 THEN 18.0::DOUBLE + CASE WHEN event_id % 4000 < 2000 THEN 0.0 ELSE least(3.0, (event_id % 4000 - 2000) / 250.0) END ELSE CASE WHEN night THEN 21.0::DOUBLE - 0.4::DOUBLE * ((h + 3) % 24) ELSE 20.5::DOUBLE END + (event_id % 5) * 0.05::DOUBLE END END AS actual,
  CASE WHEN NOT gone AND event_id % 23 <> 0 THEN CASE WHEN night AND z <> 4 THEN 17.0::DOUBLE ELSE 21.0::DOUBLE END END AS setpoint,
  CASE WHEN NOT gone AND event_id % 19 <> 0 THEN (CASE WHEN z = 4 THEN CASE WHEN event_id % 4000 < 2000 THEN 0.0 ELSE 80.0 END WHEN night THEN CASE WHEN event_id % 50 = 1 THEN 30.0 ELSE 0.0 END WHEN z % 3 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 100.0 ELSE 0.0 END
       WHEN z = 7 THEN 0.0 ELSE (event_id % 97) END)::DOUBLE END AS gain,
  row_number() OVER (PARTITION BY z ORDER BY ts, event_id) AS grid_idx, is_empty, bad AND NOT is_empty AS is_bad
  FROM (SELECT *, user_id % 10 AS z, hour(ts) AS h, hour(ts) >= 21 OR hour(ts) < 5 AS night, event_id % 13 = 0 AS is_empty, event_id % 101 = 0 AS bad,
               event_id % 13 = 0 OR event_id % 101 = 0 AS gone FROM events))"""


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outdoor temperature by day."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.to_date("ts").alias("day")).agg((F.sum(F.floor("value")) / F.count("*") - 45.0 + F.dayofmonth(F.first(F.to_date("ts"))) % 20).alias("temp"))


WEATHER = """wx AS (SELECT ts::DATE AS day, sum(floor(value)) / count(*) - 45.0 + day(first(ts::DATE)) % 20 AS temp FROM events GROUP BY ts::DATE)"""
