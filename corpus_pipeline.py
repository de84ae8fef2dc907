"""The corpus pipeline: toxic documents go, one of each group of near copies stays, documents that hold benchmark items go, sources are mixed to target weights, and what is left is dealt into shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import decontamination, jaccard, mixing, sharding, toxicity
from sensorloom.llm.common import cut, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without rows whose text scores as toxic; the lexicon is learned from ``labels`` outside the held-out fifth.

    Null and empty texts are clean and stay; very long ones are matched whole; repeated rows are judged alike. Without
    labels the seed lexicon judges. An empty table gives an empty one. All columns stay as they are, whatever their names.
    """
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs.withColumnsRenamed(names), model).where("tox_score < 0.5").drop("tox_score", "tox_hits")
    return scored.withColumnsRenamed({n: c for c, n in names.items()})


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, of exact repeats one row.

    Rows with a null id stay, as do null and empty texts, each id once. An empty table gives an empty one. All columns
    stay as they are.
    """
    return jaccard.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without rows that hold an item of ``benchmark``; null and empty texts hold none, very long ones are
    searched whole. An empty table, or a benchmark without items, drops nothing. All columns stay as they are."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes: none to three of a document. Null sources are one source; null and empty texts
    have no words and are taken as their size class is. An empty table gives an empty one; the columns stay as they are."""
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    mixed = mixing.mix(docs.withColumnsRenamed(names)).where("_copies > 0")
    copies = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return copies.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with ``shard``, ``shard_depth`` and ``shard_bytes``, which replace columns of these names. Null ids go by their
    text, null texts have no bytes, copies of one id that exceed a shard overflow into more. An empty table gives an empty one."""
    return sharding.extendible_shards(docs, sharding.LIMIT)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Learned and hashed stages have no SQL; tests hold the pipeline against its stages and a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
