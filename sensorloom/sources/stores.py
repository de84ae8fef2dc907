"""Tables that jobs add to and may add to again: keyed appends, merges by key, rescans of changed files, files of chosen names.

Each write replaces whole partitions that only it fills, so a job that runs twice, or again after it was cut off, leaves
the table as one run does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import staged

#: Folders that a merged table is dealt over; a merge rewrites those that its keys fall in.
BUCKETS = 64


def file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or nothing if none was written yet."""
    fs, where = file_system(spark, path)
    if not fs.exists(where) or not any(s.isDirectory() or s.getPath().getName().endswith(".parquet") for s in fs.listStatus(where)):
        return None
    return spark.read.parquet(path)


def append_once(rows: DataFrame, path: str, key: list[str], batch: str) -> DataFrame:
    """Adds to the table at ``path`` the rows whose ``key`` no other batch has brought, under the name ``batch``; returns the table.

    The same batch again replaces itself. Of rows that share a key the least is taken. A key may be null.
    """
    spark = rows.sparkSession
    others = [c for c in rows.columns if c not in key]
    least = F.min(F.struct(*others)).alias("_row") if others else F.lit(None).alias("_row")
    fresh = rows.groupBy(*key).agg(least)
    have = stored(spark, path)
    if have is not None:
        seen = have.where(F.col("_batch") != batch).select(*[F.col(k).alias(f"_has_{k}") for k in key])
        same = [F.col(k).eqNullSafe(F.col(f"_has_{k}")) for k in key]
        fresh = fresh.join(seen, same, "left_anti")
    fresh = staged(fresh.select(*key, *([F.col(f"_row.{c}").alias(c) for c in others]), F.lit(batch).alias("_batch")).select(*rows.columns, "_batch"))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)
    return spark.read.schema(fresh.schema).parquet(path)


def ledger(table: DataFrame) -> DataFrame:
    """How many rows each batch has brought."""
    return table.groupBy(F.col("_batch").alias("batch")).agg(F.count("*").alias("n"))


def merge(rows: DataFrame, path: str, key: list[str], version: str) -> DataFrame:
    """Puts ``rows`` into the table at ``path``: of rows with one ``key`` that with the largest ``version`` stays; returns the table.

    Rows are dealt over BUCKETS folders by key; only those that ``rows`` touch are read and replaced.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
    new = rows.withColumn("_bucket", bucket)
    touched = [r[0] for r in new.select("_bucket").distinct().collect()]  # BUCKETS at most
    have = stored(spark, path)
    if have is not None:
        new = have.where(F.col("_bucket").isin(touched)).select(*new.columns).unionByName(new)
    values = [c for c in rows.columns if c not in key]
    latest = F.max(F.struct(F.col(version).alias("_version"), F.struct(*values).alias("_row"))).alias("_top")
    merged = staged(new.groupBy(*key, "_bucket").agg(latest).select(*key, *[F.col(f"_top._row.{c}").alias(c) for c in values], "_bucket").select(*rows.columns, "_bucket"))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)
    return spark.read.schema(merged.schema).parquet(path)


LISTED = "path string, size long, modified timestamp"


def listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``(path, size, modified)`` of the files under ``folder`` whose names fit ``pattern``; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def rescan(spark: SparkSession, folder: str, store: str, parse: Callable[[DataFrame], DataFrame], pattern: str = "*.csv") -> int:
    """Brings the rows of new and changed files under ``folder`` into ``store``; returns how many files were read.

    ``parse(lines)`` gives a table of rows from ``lines(value, path, block, id)``; it keeps ``path``. A scan writes its rows under
    its own number and then a manifest of all files as they are; rows count if the latest manifest names their file in
    that state, so rows of changed and deleted files go. A scan that was cut off has no manifest and is done again.
    """
    now = staged(listing(spark, folder, pattern))
    done = stored(spark, f"{store}/manifest")
    number = 0 if done is None else done.agg(F.max("scan")).first()[0] + 1
    fresh = now if done is None else now.join(done.where(F.col("scan") == number - 1), ["path", "size", "modified"], "left_anti")
    fresh = staged(fresh)
    paths = [r["path"] for r in fresh.collect()]  # names of files that Spark's reader lists itself
    if paths:
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
        rows = parse(lines).join(fresh, "path")
        rows.withColumn("scan", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scan").parquet(f"{store}/rows")
    now.withColumn("scan", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scan").parquet(f"{store}/manifest")
    return len(paths)


def scanned(spark: SparkSession, store: str) -> DataFrame:
    """The rows of all files as the latest scan found them, with the ``scan`` that read each."""
    manifest = spark.read.parquet(f"{store}/manifest")
    latest = manifest.where(F.col("scan") == manifest.agg(F.max("scan")).first()[0]).drop("scan")
    return spark.read.parquet(f"{store}/rows").join(latest, ["path", "size", "modified"], "left_semi").drop("size", "modified")


def stream_new_lines(spark: SparkSession, folder: str, store: str, parse: Callable[[DataFrame], DataFrame]) -> None:
    """The lines of files that were never streamed before into ``store/rows``, each once; files that change later are not read again."""
    lines = spark.readStream.schema(T.StructType([T.StructField("value", T.StringType())])).text(folder)
    lines = lines.select("value", F.col("_metadata.file_path").alias("path"))
    stream = parse(lines).writeStream.format("parquet").option("checkpointLocation", f"{store}/state").trigger(availableNow=True).start(f"{store}/rows")
    stream.awaitTermination()


def write_named(lines: DataFrame, folder: str) -> None:
    """Text files of chosen names from ``lines(name, n, line)``: one file per ``name`` (a path under ``folder``), lines by ``n``.

    A file is written by one task, as one file is one stream of bytes, and put in its place once all are written.
    """
    spark = lines.sparkSession
    names = sorted(r[0] for r in lines.select("name").distinct().collect())  # as many as files
    numbers = spark.createDataFrame(list(enumerate(names)), "_file int, name string")
    part = f"{folder}/_parts"
    dealt = lines.join(numbers, "name").repartition(max(1, len(names)), "_file").sortWithinPartitions("_file", "n")
    dealt.select("_file", "line").write.mode("overwrite").partitionBy("_file").text(part)
    for k, name in enumerate(names):
        fs, source = file_system(spark, f"{part}/_file={k}")
        _, target = file_system(spark, f"{folder}/{name}")
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        files = [s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")]
        fs.rename(files[0], target)
    fs, where = file_system(spark, part)
    fs.delete(where, True)
