"""Times the headline queries once each, after a warm-up on the smallest tables, and prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sensorloom import plans
from sensorloom.operators import zones
from sensorloom.plans.views import zone_samples
from sensorloom.sources import files, stores

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "agg08_zone_stats",
    "agg10_hourly_proxy",
    "agg12_orientation",
    "agg13_gain_regime",
    "agg03_series_stats",
    "agg04_monthly_profile",
    "agg06_pearson_reference",
    "jon03_pair_correlation",
    "win06_decay_events",
    "agg16_step_summary",
    "dec_rules",
    "lbl_tokens",
)


#: Rows of the zone grids that the statistics are measured on, from text and from Parquet.
VOLUME = int(os.environ.get("BENCH_VOLUME_ROWS", 2_000_000))


def zone_volume(spark: SparkSession) -> dict:
    """Rows a second of the zone statistics over zone files of about VOLUME rows: the zone grids of the events, laid end to end."""
    grid = zone_samples(spark, SF_DIR)
    times = max(1, round(VOLUME / grid.count()))
    span = 1 + grid.agg(F.max("grid_idx")).first()[0]
    grid = grid.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    grid = grid.withColumns({"grid_idx": F.col("grid_idx") + F.col("_k") * span, "ts": F.col("ts") + F.make_dt_interval(days=F.col("_k") * 31)}).drop("_k")
    found = {"rows": grid.count()}
    with tempfile.TemporaryDirectory(prefix="spark-bench-") as where:
        grid.write.parquet(f"{where}/grid")
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
        line = F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), *[text(c) for c in ("actual", "setpoint", "gain")])
        body = grid.select(F.format_string("Buildings/%s/Thermal zones/%s.csv", "building", "zone").alias("name"), F.col("grid_idx").alias("n"), line.alias("line"))
        heads = body.select("name", F.lit(-1).cast("long").alias("n"), F.lit("Timestamp,T_Actualvalue,T_Setvalue,T_Gain").alias("line")).distinct()
        stores.write_named(body.unionByName(heads), f"{where}/text")
        for form, read in (("parquet", lambda: spark.read.parquet(f"{where}/grid")), ("text", lambda: files.zone_samples(files.zone_files(spark, f"{where}/text")))):
            began = time.time()
            zones.zone_stats(read()).write.format("noop").mode("overwrite").save()
            found[f"{form}_rows_per_sec"] = round(found["rows"] / (time.time() - began))
    return found


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.queries()
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    for name in HEADLINE if os.path.isdir(small) else ():
        queries[name](spark, small).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        began = time.time()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    volume = zone_volume(spark)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf, "zone_rows_per_sec": round(rows / times["agg08_zone_stats"]), "zone_volume": volume}))


if __name__ == "__main__":
    main()
