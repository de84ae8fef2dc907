"""Near-duplicate embeddings by sorted projection passes (operator 10)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_group, components, cut, discard, partitions, salted_join, sorted_groups, spanning, table

THRESHOLD = 0.93
#: Hash bits concatenated in a pass, and neighbours compared after each vector of it.
BITS, WINDOW = 64, 64
#: Chance that a pair at the threshold, alone in its label, is brought together by some pass.
TARGET = 0.99
#: Rows of a pass compared in one group, which the WINDOW rows after them join.
BLOCK = 4096
#: Vectors of a united group compared at once; larger groups are split by angle, then compared tile by tile.
LEAF = 1000
#: Vectors whose angles to a third one differ by more than this are no pair.
ANGLE = math.acos(THRESHOLD) + 1e-9


def passes_for(n: int) -> int:
    """Passes that reach TARGET in a label of ``n`` different vectors.

    Two vectors at the threshold agree in a random sign with chance 1 - angle / pi, and are neighbours in a pass once they
    agree in the first log2(n / WINDOW) signs.
    """
    near = (1 - ANGLE / math.pi) ** max(0.0, math.log2(max(1, n) / WINDOW))
    return max(2, math.ceil(math.log(1 - TARGET) / math.log(1 - min(near, 0.999))))


def matrix(column) -> np.ndarray:
    """A list column of equal lengths as unit vectors in double precision; very large and very small components are safe."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def projected(vectors: DataFrame, passes: int) -> DataFrame:
    """``(rep, label, dim, hashes, small, step)`` of ``vectors(rep, label, dim, embedding)``.

    ``hashes``: for each pass, BITS signs of random projections as one number whose order is that of the bits. ``small``:
    the unit vector in whole ``step``s, a byte each.
    """

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            out, step, small = np.zeros((b.num_rows, passes), np.int64), np.zeros(b.num_rows), [b""] * b.num_rows
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([20240817, int(dim)]).standard_normal((int(dim), passes * BITS))
                x = matrix(b.column("embedding").take(pa.array(at)))
                signs = (x @ planes[dim] > 0).reshape(len(at), passes, BITS)
                packed = np.packbits(signs, axis=2).view(">u8")[:, :, 0].astype(np.uint64)
                out[at] = (packed ^ np.uint64(1 << 63)).view(np.int64)
                step[at] = np.abs(x).max(axis=1) / 127
                for k, row in zip(at.tolist(), np.rint(x / step[at][:, None]).astype(np.int8)):
                    small[k] = row.tobytes()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * passes), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("label"), b.column("dim"), lists, pa.array(small, pa.binary()), pa.array(step)], names=["rep", "label", "dim", "hashes", "small", "step"])

    added = [T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("small", T.BinaryType()), T.StructField("step", T.DoubleType())]
    return vectors.select("rep", "label", "dim", "embedding").mapInArrow(run, T.StructType([*[vectors.schema[c] for c in ("rep", "label", "dim")], *added]))


def neighbours(batches):
    """Of blocks of rows in order: a forest of the pairs within WINDOW that may reach THRESHOLD.

    Vectors in steps of ``step`` are off by half a step in each component, which bounds how far a cosine can be off,
    so no pair is lost here; what falls short is told by the exact comparison later.
    """
    for t, bounds in sorted_groups(batches, "block"):
        turn, dims, rep, step = (t.column(c).to_numpy() for c in ("pass", "dim", "rep", "step"))
        label = t.column("label").combine_chunks().dictionary_encode()
        label = (label.combine_chunks() if isinstance(label, pa.ChunkedArray) else label).indices.to_numpy()
        small, a, b = t.column("small"), [], []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            left, right = [], []
            for d in np.unique(dims[lo:hi]):
                at = lo + np.flatnonzero(dims[lo:hi] == d)
                x = np.frombuffer(b"".join(small.take(pa.array(at)).to_pylist()), np.int8).reshape(len(at), d).astype(np.float32) * step[at][:, None].astype(np.float32)
                slack = step[at] * (math.sqrt(d) * 0.505) + 1e-5
                for k in range(0, len(at), 256):
                    i, j = np.arange(k, min(k + 256, len(at)))[:, None], np.arange(k, min(k + 256 + WINDOW, len(at)))[None, :]
                    near = (x[i[:, 0]] @ x[j[0]].T >= THRESHOLD - slack[i] - slack[j]) & (i < j) & (j <= i + WINDOW)
                    near &= (label[at[i]] == label[at[j]]) & (turn[at[i]] == turn[at[j]])
                    p, q = np.nonzero(near)
                    left += (at[p + k] - lo).tolist()
                    right += (at[q + k] - lo).tolist()
            for p, q in spanning(hi - lo, left, right):
                a.append(rep[lo + p])
                b.append(rep[lo + q])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def found_by_passes(reps: DataFrame, passes: int) -> DataFrame:
    """Candidate pairs ``(a, b)`` of all passes: keys and byte vectors are sorted over the whole cluster, not the vectors.

    Rows are numbered in the order of (pass, label, length, hash) by a range sort and the counts of its partitions,
    which alone come to the driver; blocks of BLOCK numbers are compared with the WINDOW rows after them.
    """
    spark = reps.sparkSession
    order = ["pass", "label", "dim", "hash", "rep"]
    keys = cut(projected(reps, passes))
    rows = keys.select(F.posexplode("hashes").alias("pass", "hash"), "rep", "label", "dim", "small", "step")
    rows = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    sorted_ = cut(rows.select("pass", "label", "dim", "rep", "small", "step", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    discard(keys)
    start, starts = 0, []
    for r in sorted_.groupBy("part").count().orderBy("part").collect():  # a row per partition
        starts.append((r["part"], start))
        start += r["count"]
    starts = F.broadcast(spark.createDataFrame(starts, "part int, start long"))  # as many rows
    rows = sorted_.join(starts, "part").withColumn("number", F.col("start") + F.col("at"))
    block = F.floor(F.col("number") / BLOCK).cast("long")
    joins = (F.col("number") % BLOCK < WINDOW) & (block > 0)
    rows = rows.withColumn("block", F.explode(F.when(joins, F.array(block, block - 1)).otherwise(F.array(block))))
    placed = rows.repartition(partitions(spark), "block").sortWithinPartitions("block", "number")
    pairs = cut(placed.select("block", "pass", "label", "dim", "rep", "small", "step").mapInArrow(neighbours, "a long, b long"))
    discard(sorted_)
    return pairs


def counted(batches):
    """Of whole groups: how many other vectors each one links with, and a forest of the links. Guests are compared with hosts alone."""
    for t, bounds in sorted_groups(batches, "g"):
        rep, side, guest, copies = (t.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "side", "guest", "copies"))
        lists, out = t.column("embedding").combine_chunks(), []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            x, s, v = matrix(lists.slice(lo, hi - lo)), side[lo:hi], guest[lo:hi]
            near = x @ x.T >= THRESHOLD
            np.fill_diagonal(near, False)
            if s.any():  # rows of different tiles
                near &= s[:, None] != s[None, :]
            near &= ~(v[:, None] & v[None, :])
            links = near @ copies[lo:hi]
            out += [(int(rep[lo + k]), int(links[k]), None) for k in np.flatnonzero(links)]
            i, j = np.nonzero(np.triu(near))
            out += [(int(rep[lo + a]), 0, int(rep[lo + b])) for a, b in spanning(hi - lo, i.tolist(), j.tolist())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], names=["rep", "links", "other"])


def ringed(rows: DataFrame) -> DataFrame:
    """Adds ``ring`` to ``rows`` with ``embedding`` and ``pivot``: the angle between them in whole ANGLEs; ``pivot`` goes."""

    def run(batches):
        for b in batches:
            ring = np.zeros(b.num_rows, np.int32)
            dims = pc.list_value_length(b.column("embedding")).to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                cosine = (matrix(b.column("embedding").take(pa.array(at))) * matrix(b.column("pivot").take(pa.array(at)))).sum(axis=1)
                ring[at] = np.arccos(np.clip(cosine, -1, 1)) / ANGLE
            kept = [c for c in b.schema.names if c != "pivot"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(ring)], names=[*kept, "ring"])

    fields = [f for f in rows.schema.fields if f.name != "pivot"]
    return rows.select(*[f.name for f in fields], "pivot").mapInArrow(run, T.StructType([*fields, T.StructField("ring", T.IntegerType())]))


def compared(reps: DataFrame, groups: DataFrame) -> DataFrame:
    """``(rep, links, other)`` of all pairs inside ``groups(node, component)``, exactly, in double precision.

    A group above LEAF is split into rings by the angle to its first vector: a vector links within its ring and the
    next ones alone. A ring that is still larger is compared tile by tile, so no task holds more than twice LEAF.
    """
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    members = salted_join(groups, sizes, "component", "node")
    members = cut(members.join(reps.select("rep", "copies", "embedding"), members["node"] == reps["rep"]).select("rep", "copies", "embedding", "component", "size"))
    small = members.where(F.col("size") <= LEAF).select("rep", "copies", "embedding", F.col("component"), F.lit(0).alias("ring"), F.lit(False).alias("guest"))
    large = members.where(F.col("size") > LEAF)
    pivots = large.where(F.col("rep") == F.col("component")).select("component", F.col("embedding").alias("pivot"))
    large = ringed(salted_join(large.select("rep", "copies", "embedding", "component"), pivots, "component", "rep"))
    cells = F.array(F.struct(F.col("ring").alias("ring"), F.lit(False).alias("guest")), F.struct((F.col("ring") - 1).alias("ring"), F.lit(True).alias("guest")))
    large = large.withColumn("cell", F.explode(cells)).select("rep", "copies", "embedding", "component", "cell.*")
    whole = cut(small.unionByName(large).withColumn("cell", F.xxhash64("component", "ring")))
    counts = whole.groupBy("cell").agg(F.count("*").alias("n"))
    whole = salted_join(whole, counts, "cell", "rep").withColumn("tiles", F.ceil(F.col("n") / LEAF).cast("int"))
    whole = whole.withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    side = F.when(F.col("to") == F.col("tile"), 0).when(F.col("tile") < F.col("to"), 1).otherwise(2).cast("int")
    whole = whole.select("rep", "copies", "embedding", "guest", side.alias("side"), F.xxhash64("cell", F.least("tile", "to"), F.greatest("tile", "to")).alias("g"))
    return cut(by_group(whole, "g", counted, "rep long, links long, other long"))


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, n_links, component_id, kept)``, a row per row of ``rows``; ids and labels keep their type.

    Vectors of equal label and length link at a cosine of ``THRESHOLD`` or more. Equal vectors are one with a number
    of copies. In each pass all vectors are sorted by label and concatenated random sign bits over the whole cluster, and
    each is compared with the ``WINDOW`` after it, across partition borders too. The number of passes follows the
    largest label, so that recall does not fall as a label grows (``passes_for``). Pairs of all passes are united; then
    every pair inside a united group is compared, so counts of links do not depend on the window. A pair is missed only
    where no pass joins its groups.

    A null label, null or empty vector, one with a null, infinite or not-a-number component, or of zero length links with nothing
    and is its own component. A null id: no links, null component, not kept. Rows that repeat an id count as
    vectors. An empty table gives an empty result. Other columns of ``rows`` are not read, whatever their names.
    """
    values = F.col(vector_col).cast("array<double>")
    fine = F.coalesce((F.size(values) > 0) & F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists(values, lambda x: x != 0), F.lit(False))
    base = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), values.alias("embedding"), fine.alias("fine"))
    # equal vectors are told by 128 bits
    valid = base.where("fine and label is not null and id is not null").select("id", "label", "embedding", F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(17), F.reverse("embedding")).alias("k2"))
    reps = valid.groupBy("label", "k1", "k2").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    # numbered once, as the table is written
    reps = cut(reps.withColumn("dim", F.size("embedding")).withColumn("rep", F.monotonically_increasing_id()))
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0]
    pairs = found_by_passes(reps, passes_for(largest or 1))
    facts = compared(reps, components(pairs))
    discard(pairs)
    links = facts.where("links > 0").groupBy("rep").agg(F.sum("links").alias("links"))
    final = components(facts.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "rep")
    low = final.join(reps.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("low"))
    final = salted_join(final, low, "component", "rep").select("rep", "low")
    known = reps.select("label", "k1", "k2", "rep", "least", "copies").join(links, "rep", "left").join(final, "rep", "left")
    out = valid.select("id", "label", "k1", "k2").join(known, ["label", "k1", "k2"])
    out = out.select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("low", "least").alias("component_id"))
    alone = base.where("not fine or label is null or id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
    return out.withColumnRenamed("id", id_col)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all ``embeddings``; edge cases as in ``near_vectors``."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
