"""Sharding by extendible hashing (operator 7)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

BITS = 60
#: Bits that one round looks at beyond those already settled, and the most cells a first round may make (2^20).
ROUND_BITS, FIRST_BITS = 12, 20


def hash_bits(key: Column) -> Column:
    """The first 60 bits of an MD5 digest."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def settle(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """``cells(cell, bytes, n, least, most)`` at depth ``high``: the shallowest depth from ``low`` at which each one's bucket fits.

    Adds ``depth`` (null: no bucket up to ``high`` fits), ``prefix``, ``shard_bytes``, ``shard_rows`` and ``single``
    (the bucket has one hash value only, which no further bit can split).
    """
    nodes = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    sums = nodes.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"), F.min("least").alias("least"), F.max("most").alias("most"))
    sums = sums.withColumn("single", F.col("least") == F.col("most")).where((F.col("shard_bytes") <= limit) | F.col("single"))
    fits = nodes.select("cell", "depth", "prefix").join(sums, ["depth", "prefix"])
    best = fits.groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows", "single")).alias("b"))
    return cells.select("cell").join(best, "cell", "left").select("cell", "b.*")


def extendible_shards(docs: DataFrame, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``shard`` (string), ``shard_depth`` (int) and ``shard_bytes`` (long) to each row of ``docs``.

    A directory is indexed by the leading bits of a hash of the id. A bucket whose texts (UTF-8 bytes) exceed
    ``limit_bytes`` is split on one more bit, and only such a bucket; so a shard is the shallowest prefix that fits.
    Sums are made once for fine cells and rolled up to all coarser prefixes, which gives what splitting bit by bit
    would, in one round per ``ROUND_BITS`` bits. Documents move once, to the shard's cell, by a join with the directory.

    A hash value is not split by bits. If rows of one id exceed the limit together, they overflow by text, equal
    rows in counted blocks, so only a document larger than the limit exceeds it (in a shard of its own).
    Null id: the hash of the text. Null text: 0 bytes. An empty table gives an empty result. The shard's name is ``b``
    and its bits; overflow adds the text's digest and a block number. Columns of ``docs`` named like the added ones
    are replaced.
    """
    names = ("shard", "shard_depth", "shard_bytes")
    given = {c: f"_in{i}" for i, c in enumerate(c for c in docs.columns if c not in names)}
    # columns go by other names inside, so that none can clash with those added here
    docs = docs.select(*given).withColumnsRenamed(given)
    id_col, text_col, columns = given[id_col], given[text_col], list(given.values())
    back = lambda df: df.select(*[F.col(n).alias(c) for c, n in given.items()], *names)
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(text_col, F.lit("")))))
    rows = docs.select(*columns).withColumn("_h", hash_bits(key))
    slim = cut(rows.select("_h", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("_bytes")))
    total = slim.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    low, high = 0, min(FIRST_BITS, max(1, math.ceil(math.log2(max(1, total / limit_bytes))) + 6))
    found, left = [], slim
    while True:
        cells = left.groupBy(F.shiftright("_h", BITS - high).alias("cell")).agg(F.sum("_bytes").alias("bytes"), F.count("*").alias("n"), F.min("_h").alias("least"), F.max("_h").alias("most"))
        settled = cut(settle(cells, low, high, limit_bytes))
        found.append((high, settled))
        if high == BITS or not settled.where("depth is null").head(1):
            break
        left = cut(left.join(settled.where("depth is null").select(F.col("cell").alias("_c")), F.shiftright("_h", BITS - high) == F.col("_c")).drop("_c"))
        low, high = high + 1, min(BITS, high + ROUND_BITS)
    out = rows
    for i, (high, settled) in enumerate(found):
        own = settled.where("depth is not null").select(F.col("cell").alias(f"_c{i}"), F.struct("depth", "prefix", "shard_bytes", "shard_rows", "single").alias(f"_b{i}"))
        if i == 0 and high <= 16:
            own = F.broadcast(own)  # at most 65536 directory entries
        out = out.join(own, F.shiftright("_h", BITS - high) == F.col(f"_c{i}"), "left").drop(f"_c{i}")
    out = out.withColumn("_b", F.coalesce(*[F.col(f"_b{i}") for i in range(len(found))])).drop(*[f"_b{i}" for i in range(len(found))])
    bits = F.concat(F.lit("b"), F.when(F.col("_b.depth") > 0, F.lpad(F.bin("_b.prefix"), F.col("_b.depth"), F.lit("0"))).otherwise(""))
    out = out.withColumns({"shard": bits, "shard_depth": F.col("_b.depth").cast("int"), "shard_bytes": F.col("_b.shard_bytes"), "_over": F.col("_b.single") & (F.col("_b.shard_bytes") > limit_bytes) & (F.col("_b.shard_rows") > 1)})
    over = [s.where(f"single and shard_bytes > {int(limit_bytes)} and shard_rows > 1") for _, s in found]
    if not any(s.head(1) for s in over):
        return back(out)
    # equal rows are counted and dealt out by number, so that no task holds all copies of one id
    long_ = out.where("_over").groupBy(*columns, *names).agg(F.count("*").alias("_n"))
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    per = F.greatest(F.lit(1), F.floor(F.lit(limit_bytes) / F.greatest(size, F.lit(1))))
    long_ = long_.withColumn("_per", per).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / F.col("_per")))))
    held = F.least(F.col("_per"), F.col("_n") - F.col("_block") * F.col("_per"))
    digest = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]))
    long_ = long_.withColumn("_held", held).withColumn("shard", F.concat_ws("-", "shard", digest, F.col("_block").cast("string"))).withColumn("shard_bytes", F.col("_held") * size)
    long_ = long_.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_held"))))
    return back(out.where("not _over")).unionByName(back(long_))


#: Bytes of text a shard may hold.
LIMIT = 4 << 20


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all ``documents``; edge cases as in ``extendible_shards``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return extendible_shards(docs, LIMIT).select("doc_id", "shard", "shard_depth", "shard_bytes")


OP7_SQL = f"""
WITH d AS (SELECT doc_id, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS h, coalesce(strlen(text), 0) AS bytes FROM documents),
n AS (SELECT g.depth, d.h >> (60 - g.depth) AS prefix, CAST(sum(d.bytes) AS BIGINT) AS shard_bytes
      FROM d, (SELECT unnest(range(0, 25))::INTEGER AS depth) g GROUP BY 1, 2),
f AS (SELECT d.doc_id, d.h, min(n.depth) AS depth FROM d JOIN n ON n.prefix = d.h >> (60 - n.depth) AND n.shard_bytes <= {LIMIT} GROUP BY 1, 2)
SELECT f.doc_id, 'b' || CASE WHEN f.depth = 0 THEN '' ELSE lpad(bin(n.prefix), f.depth, '0') END AS shard, f.depth AS shard_depth, n.shard_bytes
FROM f JOIN n ON n.depth = f.depth AND n.prefix = f.h >> (60 - f.depth)
"""
