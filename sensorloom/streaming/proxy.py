"""The hourly energy proxy as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_proxy(samples: DataFrame, late: str = "2 hours") -> DataFrame:
    """Mean gain per zone and hour of a stream of samples; an hour comes out once its watermark has passed, later rows are dropped."""
    rows = samples.where("gain is not null").withWatermark("ts", late)
    hours = rows.groupBy("building", "zone", F.window("ts", "1 hour").alias("w")).agg(F.avg("gain").alias("mean_gain"), F.count("*").alias("n"))
    return hours.select("building", "zone", F.col("w.start").alias("hour"), "mean_gain", "n")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Handles all input there is now and stops; the checkpoint makes the next call start where this one ended."""
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
