"""Statistics of point series: ``points(raw_label, ts_text, value, arrival, file, file_kind)``; a null value is an unreadable one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import pearson

#: Rows of a series that one task orders at a time; distinct values counted; values listed.
CHUNK, DISTINCT_CAP, LIST_CAP = 1_000_000, 32, 8


def label_counts(points: DataFrame) -> DataFrame:
    """Rows per label, most first."""
    return points.groupBy("raw_label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "raw_label")


def last_wins(points: DataFrame) -> DataFrame:
    """One row per label and timestamp: the numeric value that arrived last."""
    return points.where("value is not null").groupBy("raw_label", "ts_text").agg(F.max_by("value", "arrival").alias("value"))


def running(df: DataFrame, keys: list[str], value: Column, chunk: Column, order: str, how: str, out: str) -> DataFrame:
    """``out``: the maximum (or last non-null) of ``value`` over earlier rows of a key."""
    return running_all(df, keys, {out: (value, how)}, chunk, order)


def running_all(df: DataFrame, keys: list[str], values: dict[str, tuple[Column, str]], chunk: Column, order: str) -> DataFrame:
    """For each name of ``values`` the maximum (``max``) or last non-null (``last``) of its column over earlier rows of a key.

    A key's rows are split into chunks: chunk summaries are few and ordered first, then chunks go to separate tasks, so a
    busy series is no single task's. All columns share one summary, one join and one sort.
    """
    df = df.withColumns({"_chunk": chunk} | {f"_v{k}": v for k, (v, _) in enumerate(values.values())})
    hows = [how for _, how in values.values()]
    known = lambda v: F.when(F.col(v).isNotNull(), F.col(order))
    sums = df.groupBy(*keys, "_chunk").agg(*[(F.max(f"_v{k}") if how == "max" else F.max_by(f"_v{k}", known(f"_v{k}"))).alias(f"_s{k}") for k, how in enumerate(hows)])
    over = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    prior = [F.max(f"_s{k}").over(over) if how == "max" else F.last(f"_s{k}", ignorenulls=True).over(over) for k, how in enumerate(hows)]
    sums = sums.select(*keys, "_chunk", *[p.alias(f"_before{k}") for k, p in enumerate(prior)])
    inner = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.join(sums, [*keys, "_chunk"])
    both = {}
    for k, (out, how) in enumerate(zip(values, hows)):
        here = F.max(f"_v{k}").over(inner) if how == "max" else F.last(f"_v{k}", ignorenulls=True).over(inner)
        both[out] = F.greatest(here, F.col(f"_before{k}")) if how == "max" else F.coalesce(here, F.col(f"_before{k}"))
    return df.withColumns(both).drop("_chunk", *[f"_v{k}" for k in range(len(hows))], *[f"_before{k}" for k in range(len(hows))])


def arrival_chunk(points: DataFrame, chunk_rows: int) -> Column:
    """Arrival numbers are cut into runs; arrivals by file and split are so already."""
    structured = points.schema["arrival"].dataType.typeName() == "struct"
    return F.struct("arrival.file", "arrival.block") if structured else F.floor(F.col("arrival") / chunk_rows)


def order_defects(points: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """``(raw_label, out_of_order, n_decreases)``: how many ``stray`` and ``decrease`` rows ``ordered_rows`` marks.

    Rows are shuffled once, by label and chunk: strays follow from the highest time before the chunk, falls inside the chunk
    are counted there, and those across chunks from each chunk's first and last accepted value.
    """
    numeric = points.where("value is not null").select("raw_label", "ts_text", "value", "arrival", arrival_chunk(points, chunk_rows).alias("_chunk"))
    before = Window.partitionBy("raw_label").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = numeric.groupBy("raw_label", "_chunk").agg(F.max("ts_text").alias("_m")).select("raw_label", "_chunk", F.max("_m").over(before).alias("_before"))
    inner = Window.partitionBy("raw_label", "_chunk").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    rows = numeric.join(tops, ["raw_label", "_chunk"])
    rows = rows.withColumn("stray", F.coalesce(F.col("ts_text") < F.greatest(F.max("ts_text").over(inner), F.col("_before")), F.lit(False)))
    rows = rows.withColumn("_good", F.when(~F.col("stray"), F.col("value")))
    rows = rows.withColumn("_prev", F.last("_good", ignorenulls=True).over(inner))
    at = F.when(F.col("_good").isNotNull(), F.col("arrival"))
    chunks = rows.groupBy("raw_label", "_chunk").agg(F.count_if("stray").alias("late"), F.count_if(F.col("_good") < F.col("_prev")).alias("falls"), F.min_by("_good", at).alias("first"), F.max_by("_good", at).alias("last"))
    chunks = chunks.withColumn("_prev", F.last("last", ignorenulls=True).over(before))
    border = F.coalesce((F.col("first") < F.col("_prev")).cast("long"), F.lit(0))
    return chunks.groupBy("raw_label").agg(F.sum("late").alias("out_of_order"), F.sum(F.col("falls") + border).alias("n_decreases"))


def ordered_rows(points: DataFrame, chunk_rows: int = CHUNK) -> DataFrame:
    """Numeric rows with ``stray`` (its timestamp is below one that arrived before) and ``decrease`` (below the accepted value before)."""
    numeric, chunk = points.where("value is not null"), arrival_chunk(points, chunk_rows)
    numeric = running(numeric, ["raw_label"], F.col("ts_text"), chunk, "arrival", "max", "_top")
    numeric = numeric.withColumn("stray", F.coalesce(F.col("ts_text") < F.col("_top"), F.lit(False))).drop("_top")
    numeric = running(numeric, ["raw_label"], F.when(~F.col("stray"), F.col("value")), chunk, "arrival", "last", "_prev")
    return numeric.withColumn("decrease", F.coalesce(~F.col("stray") & (F.col("value") < F.col("_prev")), F.lit(False))).drop("_prev")


def distinct_values(points: DataFrame) -> DataFrame:
    """Per label: ``distinct`` (null beyond the cap) and ``values`` (null beyond the list cap), without gathering a label's values."""
    pairs = points.where("value is not null").select("raw_label", (F.col("value") + F.lit(0.0)).alias("value")).distinct()
    first = Window.partitionBy("raw_label").orderBy("value")
    few = pairs.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= DISTINCT_CAP + 1)
    n = F.count("*")
    listed = F.sort_array(F.collect_list(F.when(F.col("_rn") <= LIST_CAP + 1, F.col("value"))))
    return few.groupBy("raw_label").agg(F.when(n <= DISTINCT_CAP, n).alias("distinct"), F.when(n <= LIST_CAP, listed).alias("values"))


def series_stats(points: DataFrame) -> DataFrame:
    """A row per label: counts, range, moments, distinct values, order defects and files."""
    numeric = F.col("value").isNotNull()
    facts = points.groupBy("raw_label").agg(
        F.count("*").alias("n_rows"),
        F.count_if(~numeric).alias("n_bad"),
        F.min("ts_text").alias("first_ts"),
        F.max("ts_text").alias("last_ts"),
        F.count("value").alias("n_num"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.when(F.count("value") > 0, F.coalesce(F.stddev_samp("value"), F.lit(0.0))).alias("std"),
        F.avg((F.col("value") == 0).cast("int")).alias("zero_fraction"),
        F.when(F.count("value") > 0, F.count_if(F.col("value") < 0)).alias("n_negative"),
        F.sort_array(F.collect_set("file")).alias("files"),
        F.sort_array(F.collect_set("file_kind")).alias("file_kinds"),
    )
    out = facts.join(order_defects(points), "raw_label", "left").join(distinct_values(points), "raw_label", "left")
    out = out.withColumn("distinct", F.when(F.col("n_num") == 0, F.lit(0)).otherwise(F.col("distinct")))
    out = out.withColumn("values", F.when(F.col("n_num") == 0, F.array().cast("array<double>")).otherwise(F.col("values")))
    return out.withColumns(
        {
            "out_of_order": F.coalesce("out_of_order", F.lit(0)),
            "n_decreases": F.when(F.col("n_num") > 0, F.coalesce("n_decreases", F.lit(0))),
            "is_binary": F.when(F.col("n_num") > 0, F.coalesce(F.col("distinct").isin(1, 2), F.lit(False))),
            "monotonic": F.when(F.col("n_num") > 1, F.col("n_decreases") == 0),
        }
    )


def monthly_profile(points: DataFrame) -> DataFrame:
    """Mean, count and range by label and month of the year, years pooled, with the label's amplitude."""
    monthly = last_wins(points).groupBy("raw_label", F.substring("ts_text", 6, 2).alias("month"))
    monthly = monthly.agg(F.avg("value").alias("mean"), F.count("*").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"))
    label = Window.partitionBy("raw_label")
    return monthly.withColumn("amplitude", F.max("mean").over(label) - F.min("mean").over(label))


def resolve_reference(labels: DataFrame, part: str) -> str:
    """The one label that contains ``part``; an error names the candidates otherwise."""
    found = [r[0] for r in labels.where(F.col("raw_label").contains(part)).select("raw_label").distinct().orderBy("raw_label").limit(21).collect()]
    if len(found) != 1:
        raise ValueError(f"{part!r} must match one label, matches {found}")
    return found[0]


def correlate_with(series: DataFrame, reference: DataFrame) -> DataFrame:
    """Correlation of each series with ``reference(ts_text, ref)`` over equal timestamps."""
    aligned = series.join(reference, "ts_text")
    return aligned.groupBy("raw_label").agg(F.count("*").alias("n"), pearson("value", "ref").alias("r"))


def aligned_pairs(series: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs(a, b, ...)`` with both values at each common timestamp."""
    left = series.select(F.col("raw_label").alias("a"), "ts_text", F.col("value").alias("x"))
    right = series.select(F.col("raw_label").alias("b"), "ts_text", F.col("value").alias("y"))
    return pairs.join(left, "a").join(right, ["b", "ts_text"])
