"""Order over many tasks: numbers in a global order, order statistics of any key, and rows with their neighbours.

No key is sorted by one task. Where something is counted per partition or bin, only those counts meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import staged

#: Bins that an interval is cut into, and rows of an interval that are ranked instead.
BINS, FEW = 256, 1000


def numbered(df: DataFrame, order: list, out: str = "number", keys: list[str] | None = None) -> DataFrame:
    """``out``: the number of each row from 1 in ``order``, within its ``keys`` where they are given.

    Rows are sorted in ranges over the cluster; a range's rows are numbered after those of the ranges before it, of
    which only the counts are added up. A key may fill many ranges. Equal rows are numbered in any order.
    """
    keys = keys or []
    spark = df.sparkSession
    order = [*[F.col(k) for k in keys], *order]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = staged(ranges.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    rows = placed.join(starts, "_part").withColumn(out, F.col("_start") + F.col("_at") + 1).drop("_part", "_at", "_start")
    if not keys:
        return rows
    first = rows.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.min(out).alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return rows.join(first, same).withColumn(out, F.col(out) - F.col("_first") + 1).select(*rows.columns)


def split_numbers(lines: DataFrame, file: str = "file", split: str = "block", seen: str = "id") -> DataFrame:
    """``line``: the number of each line of a file from 1, from the number ``seen`` within its ``split``.

    Splits are read by different tasks; the lines of those before a split are added up from a count per split, so
    lines are not shuffled by file. ``seen`` rises by one from line to line of a split, from any start.
    """
    sizes = lines.groupBy(file, split).agg(F.count("*").alias("_n"), F.min(seen).alias("_low"))
    before = Window.partitionBy(file).orderBy(split).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(file, split, "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return lines.join(sizes, [file, split]).withColumn("line", F.col(seen) - F.col("_low") + F.col("_before") + 1).drop("_low", "_before")


def at_positions(rows: DataFrame, keys: list[str], value: str, wanted: DataFrame) -> DataFrame:
    """``(keys, pos, value)``: of each key the value at position ``pos`` (from 0) of its sorted values.

    ``wanted(keys, pos)`` names the positions; those beyond a key's values give no row. Null and not-a-number values are
    left out; keys are not null. The values around a position are narrowed down to one bin of their range, by
    counts per bin that tasks add up before they meet, until the bin holds one value or few rows, which are ranked.
    """
    v = F.col(value).cast("double")
    rows = staged(rows.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("_v")))
    spans = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    intervals = staged(wanted.select(*keys, F.col("pos").cast("long").alias("pos")).distinct().join(spans, keys).where("pos < _n").withColumn("_rank", F.col("pos")))
    found = []
    while True:
        found.append(intervals.where("_lo = _hi").select(*keys, "pos", F.col("_lo").alias(value)))
        inside = rows.join(intervals.where("_lo < _hi"), keys).where("_v between _lo and _hi")
        turn = F.row_number().over(Window.partitionBy(*keys, "pos").orderBy("_v"))
        found.append(inside.where(F.col("_n") <= FEW).withColumn("_turn", turn).where("_turn = _rank + 1").select(*keys, "pos", F.col("_v").alias(value)))
        if intervals.where((F.col("_lo") < F.col("_hi")) & (F.col("_n") > FEW)).isEmpty():
            break
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)  # halves do not overflow
        finite = (F.abs("_lo") < F.lit(float("inf"))) & (F.abs("_hi") < F.lit(float("inf")))
        middle = F.when(finite, F.least(F.floor(share * (BINS - 2)), F.lit(BINS - 3)).cast("int") + 1).otherwise(1)
        bins = F.when(F.col("_v") == F.col("_lo"), 0).when(F.col("_v") == F.col("_hi"), BINS - 1).otherwise(middle)
        counts = inside.where(F.col("_n") > FEW).groupBy(*keys, "pos", "_rank", bins.alias("_bin")).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = F.sum("_n").over(Window.partitionBy(*keys, "pos").orderBy("_bin"))  # BINS rows at most
        counts = counts.withColumn("_rank", F.col("_rank") - upto + F.col("_n")).where("_rank >= 0 and _rank < _n")
        intervals = staged(counts.select(*intervals.columns))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _picked(rows: DataFrame, keys: list[str], value: str, positions: Column) -> DataFrame:
    """``(keys, n, at)``: how many values each key has, and a map of the (few) ``positions`` to their values."""
    v = F.col(value).cast("double")
    counts = staged(rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys).agg(F.count("*").alias("n")))
    wanted = counts.select(*keys, F.explode(F.array_distinct(positions)).alias("pos"))
    at = at_positions(rows, keys, value, wanted).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("pos", value))).alias("at"))
    return counts.join(at, keys)


def medians(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``(keys, n, median)`` of keys with any value."""
    n = F.col("n")
    low, high = F.floor((n - 1) / 2).cast("long"), F.floor(n / 2).cast("long")
    found = _picked(rows, keys, value, F.array(low, high))
    return found.select(*keys, "n", ((F.col("at")[low] + F.col("at")[high]) / 2).alias("median"))


def quartiles(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``(keys, n, median, iqr)`` of keys with any value: exclusive quartiles, positions k(n+1)/4 interpolated; under four
    values the plain median and no range."""
    n = F.col("n")
    low, high = F.floor((n - 1) / 2).cast("long"), F.floor(n / 2).cast("long")
    place = [F.least(F.greatest(F.floor(F.lit(k) * (n + 1) / 4), F.lit(1)), n - 1).cast("long") for k in (1, 2, 3)]
    positions = F.when(n < 4, F.array(low, high)).otherwise(F.array(*[x for p in place for x in (p - 1, p)]))
    found, at = _picked(rows, keys, value, positions), F.col("at")
    cut = []
    for k, p in zip((1, 2, 3), place):
        over = F.lit(k) * (n + 1) - p * 4
        cut.append((at[p - 1] * (4 - over) + at[p] * over) / 4)
    plain = (at[low] + at[high]) / 2
    return found.select(*keys, "n", F.when(n < 4, plain).otherwise(cut[1]).alias("median"), F.when(n >= 4, cut[2] - cut[0]).alias("iqr"))


def haloed(rows: DataFrame, index: str, chunk: int, before: int, after: int) -> DataFrame:
    """``rows`` in chunks of ``index``, each with copies (``_guest``) of the ``before`` rows before it and the ``after`` rows after it."""
    own, at = F.floor(F.col(index) / chunk), F.col(index) % chunk
    place = lambda c, guest: F.struct(c.alias("_chunk"), F.lit(guest).alias("_guest"))
    places = F.array_compact(F.array(place(own, False), F.when(at >= chunk - before, place(own + 1, True)), F.when(at < after, place(own - 1, True))))
    return rows.withColumn("_p", F.explode(places)).select(*rows.columns, "_p.*")
