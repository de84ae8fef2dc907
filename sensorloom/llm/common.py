"""Helpers that the corpus operators share: table access, lineage cuts and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space that separates words, as a regular expression for a word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only where that is unset on a local master (as in tests) is a folder of this machine taken instead: elsewhere other
    executors could not read it, so that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def cut(df: DataFrame, partitions_by: str | None = None) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back.

    The lineage ends there, so work survives lost executors and is done once however often it is read. The table goes
    when the session ends, or by ``discard`` once nothing reads it any more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partitions_by:
        writer = writer.partitionBy(partitions_by)
    writer.parquet(path)
    fs, where = _file_system(spark, path)
    fs.deleteOnExit(where)
    found = spark.read.schema(df.schema).parquet(path)
    found._cut_path = path
    return found


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``cut`` that no unfinished result reads."""
    for t in tables:
        fs, where = _file_system(t.sparkSession, t._cut_path)
        fs.delete(where, True)


def salted_join(rows: DataFrame, small: DataFrame, key: str, by: str, salts: int = 16) -> DataFrame:
    """Inner join on ``key`` where many ``rows`` may share one key: they are dealt over ``salts`` tasks by ``by``.

    ``small`` has one row per key and is repeated ``salts`` times.
    """
    dealt = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).join(dealt, [key, "_salt"]).drop("_salt")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(a, b)`` with sortable ids: returns ``(node, component)``.

    ``component`` is the smallest node reachable. Large-star/small-star rounds: each is one grouped minimum and
    one join on the node, so a node with many neighbours is pre-aggregated and Spark can split its join; the edge
    list never leaves the executors. Ends when a round changes no edge. Empty input gives an empty result.
    """
    pairs = cut(edges.select("a", "b").where("a <> b and a is not null and b is not null").distinct())

    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if larger:
            least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
            return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = both.where("b < a")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return linked.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    def digest(e: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        row = e.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.sum(F.pmod(h, F.lit(1000003)))).first()
        return tuple(row)

    before = None
    for _ in range(max_rounds):
        last, pairs = pairs, cut(star(star(pairs, True), False))
        discard(last)
        now = digest(pairs)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    low = pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = low.select(F.col("component").alias("node"), "component").distinct()
    return low.unionByName(roots)


def first_rows(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each key; Spark limits each task's groups before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def sorted_groups(batches, key: str):
    """From Arrow batches sorted by ``key``: yields (table, [start, end) bounds of whole groups), holding back the last group of each batch."""
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part]).combine_chunks()
        keys = held.column(key).to_numpy()
        edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if len(edges):
            bounds = np.r_[0, edges]
            yield held.slice(0, int(edges[-1])), bounds
            held = held.slice(int(edges[-1]))
    if held is not None:
        yield held, np.array([0, held.num_rows])


def by_group(df: DataFrame, key: str, function, schema: str) -> DataFrame:
    """Runs ``function(batches)`` over ``df`` with equal ``key`` together and in order, many small groups to a batch."""
    return df.repartition(partitions(df.sparkSession), key).sortWithinPartitions(key).mapInArrow(function, schema)


def fixed_lists(column, width: int):
    """A list column whose lists all have ``width`` numbers, as a matrix."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def spanning(n: int, left, right) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph over 0..n-1 with the given edges."""
    parent, out = list(range(n)), []

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left, right):
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out
