"""Mixing sources to target weights: whole copies first, then Pareto order sampling (operator 6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, table

#: Slices of the rank key in each of two rounds, for finding the last document taken without sorting a whole source in one task.
SLICES = 4096
#: Merit by size in words, as (below, merit): the odds of being taken grow with it. Stubs and scraps repeat least.
MERITS = ((16, 0.5), (64, 0.75), (1024, 1.0), (None, 1.25))


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """A fixed draw strictly between 0 and 1: 52 bits of an MD5 digest."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """``sizes(skey, source_size)``, a row per source: adds ``target``.

    Sources share the total by weight; a target stops at ``cap`` times its source and the excess goes to the
    others by weight (the level at which it settles comes from one pass over the sources by cap / weight).
    The table has a row per source, so its one sorted window reads no document.
    """
    ranked = sizes.withColumn("_i", F.row_number().over(Window.orderBy("skey")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "skey")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranked.withColumn("_total", F.sum("source_size").over(every)).withColumn("_rn", F.row_number().over(order))
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    ranked = ranked.withColumn("_level", level)
    open_ = F.when(F.col("_cap") / F.col("_w") >= F.col("_level"), F.struct("_rn", "_level"))
    ranked = ranked.withColumn("_found", F.min(open_).over(every)["_level"])
    goal = F.when(F.col("_found").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_found") * F.col("_w")))
    return ranked.select("skey", "source_size", goal.alias("target"))


def merit_by_size(size: Column) -> Column:
    out = F.lit(MERITS[-1][1])
    for below, merit in reversed(MERITS[:-1]):
        out = F.when(size < below, merit).otherwise(out)
    return out


def copies_of(classes: DataFrame, cap: float) -> DataFrame:
    """``classes(skey, merit, words, target)``: adds ``copies``, the expected copies of a document of a source and merit.

    They are in proportion to merit but for ``cap``, and their words sum to the target: classes of high merit reach
    the cap first, and the others share what is left. The table has at most a row per source and merit.
    """
    order = Window.partitionBy("skey").orderBy(F.desc("merit"))
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy("skey")
    free = F.col("target") - F.lit(float(cap)) * F.coalesce(F.sum("words").over(before), F.lit(0))
    weight = F.sum(F.col("words") * F.col("merit")).over(rest)
    rows = classes.withColumn("_rate", F.when(weight > 0, free / weight).otherwise(F.lit(0.0)))
    # the first class that the rate leaves below the cap ends the capped ones
    rows = rows.withColumn("_level", F.max(F.when(F.col("_rate") * F.col("merit") <= F.lit(float(cap)), F.struct("merit", "_rate"))).over(every)["_rate"])
    return rows.withColumn("copies", F.coalesce(F.least(F.lit(float(cap)), F.col("_level") * F.col("merit")), F.lit(float(cap)))).drop("_rate", "_level")


def told_apart(rows: DataFrame, twice: DataFrame, text_col: str, others: list[str], seed: int) -> DataFrame:
    """``rows`` with a key and a draw of its own for each row of the keys in ``twice``: by digest of its text and ``others``, and by number
    among equal rows. Numbers come from counts per partition of a written table, so no task holds all rows of a key."""
    marked = rows.join(twice.withColumn("_twice", F.lit(True)), ["_skey", "_key"], "left")
    single = marked.where("_twice is null").select(*rows.columns)
    parts = [F.md5(F.coalesce(F.col(text_col), F.lit("")))]
    if others:
        parts.append(F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in others])))
    many = marked.where("_twice").select(*rows.columns, F.concat_ws(":", *parts).alias("_digest"))
    many = cut(many.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    same = ["_skey", "_key", "_digest"]
    counts = many.groupBy(*same, "_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*same).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    many = many.join(counts.select(*same, "_part", before.alias("_before")), [*same, "_part"])
    number = F.row_number().over(Window.partitionBy(*same, "_part").orderBy("_at")) + F.col("_before")
    many = many.withColumn("_key", F.concat_ws(":", "_key", "_digest", number.cast("string"))).withColumn("_u", uniform(F.col("_key"), seed))
    return single.unionByName(many.select(*rows.columns))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", merit_col: str | None = None) -> DataFrame:
    """Adds ``_size``, ``_source_size``, ``_target`` and ``_copies`` to each row of ``docs``.

    Every source gets a target in words (``source_targets``). A document's expected copies are in proportion to its
    merit, at most ``cap`` (``copies_of``). It is certainly taken the whole number of times; the fractions are the
    inclusion probabilities of a fixed-size sample in Pareto order: documents are ranked by the odds of a fixed uniform
    draw over the odds of inclusion, and taken in that order until the words come as near to the target as whole
    documents can. Merit is ``merit_col`` to hundredths, between 0.01 and 100 (null: 0.01), or by size (``MERITS``).

    The last document taken is found without sorting a source: words are summed in slices of the rank key, then in
    slices of the slice that holds the boundary, and only the last of them is sorted. So a source with a third of all
    rows makes no large task.

    Null source: a source of its own, last in order. Null or empty text: size 0. Very long texts count whole. Null id:
    the draw comes from the text. Rows that repeat an id within a source each have a draw of their own
    (``told_apart``); ties of the rank go by id. A source without words has target 0. Empty input gives an empty result. Extra
    columns are kept; names starting with ``_`` that this function adds replace columns of the same name.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(text_col, F.lit("")))))
    merit = F.greatest(F.lit(0.01), F.least(F.lit(100.0), F.coalesce(F.round(F.col(merit_col).cast("double"), 2), F.lit(0.01)))) if merit_col else merit_by_size(F.col("_size"))
    kept = [c for c in docs.columns if c not in ("_size", "_source_size", "_target", "_copies")]
    names = {c: f"_in{i}" for i, c in enumerate(kept)}  # no name of ``docs`` can clash while it is worked on
    rows = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string"))).alias("_skey"), word_count(text_col).alias("_size"), key.alias("_key"), uniform(key, seed).alias("_u"), *([merit.alias("_merit")] if merit_col else []))
    rows = rows if merit_col else rows.withColumn("_merit", merit)
    draws = ["_skey", "_size", "_key", "_u", "_merit"]
    slim = cut(rows.select(*draws))
    twice = cut(slim.groupBy("_skey", "_key").agg(F.count("*").alias("_n")).where("_n > 1").select("_skey", "_key"))
    if twice.head(1):
        others = [n for c, n in names.items() if c not in (id_col, text_col, source_col)]
        rows = told_apart(rows, twice, names[text_col], others, seed)
        slim = cut(rows.select(*draws))
    sums = cut(slim.groupBy(F.col("_skey").alias("skey"), F.col("_merit").alias("merit")).agg(F.sum("_size").alias("words")))
    goals = source_targets(sums.groupBy("skey").agg(F.sum("words").alias("source_size")), weights, cap)
    goals = copies_of(sums.join(goals, "skey"), cap)
    goals = goals.withColumn("whole", F.floor("copies")).withColumn("p", F.col("copies") - F.floor("copies"))
    goals = cut(goals.withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(Window.partitionBy("skey"))).drop("words"))

    def rank(df: DataFrame) -> DataFrame:
        """Adds the rank key and its slices; expects a document's draw beside its source's goal."""
        q = F.when(F.col("p") > 0, (F.col("_u") / (1 - F.col("_u"))) / (F.col("p") / (1 - F.col("p"))))
        place = F.col("_q") / (1 + F.col("_q")) * SLICES
        df = df.withColumn("_q", q).withColumn("_slice", F.least(F.lit(SLICES - 1), F.floor(place)))
        return df.withColumn("_part", F.least(F.lit(SLICES - 1), F.floor((place - F.col("_slice")) * SLICES)))

    def boundary(df: DataFrame, by: str) -> DataFrame:
        """The slice that holds the last document taken, and the words before it."""
        sums = df.groupBy("skey", by, "start", "rest").agg(F.sum("_size").alias("words"))
        upto = F.col("start") + F.sum("words").over(Window.partitionBy("skey").orderBy(by))
        sums = sums.withColumn("end", upto).withColumn("start", F.col("end") - F.col("words"))
        return cut(sums.where("start <= rest and end > rest").select("skey", by, "start"))

    ranked = rank(slim.join(goals, (F.col("_skey") == F.col("skey")) & (F.col("_merit") == F.col("merit")))).where("_q is not null").withColumn("start", F.lit(0).cast("long"))
    edge = boundary(ranked, "_slice")
    inside = ranked.drop("start").join(edge, ["skey", "_slice"])
    part = boundary(inside, "_part").withColumnRenamed("start", "begin")
    tied = inside.join(part, ["skey", "_part"]).groupBy("skey", "_part", "begin", "rest", "_q", "_key").agg(F.sum("_size").alias("words"))
    upto = F.col("begin") + F.sum("words").over(Window.partitionBy("skey").orderBy("_q", "_key"))
    last = tied.withColumn("upto", upto).where("upto - words / 2.0D <= rest").groupBy("skey").agg(F.max(F.struct("_q", "_key")).alias("last"))
    edges = edge.select("skey", F.col("_slice").alias("edge")).join(part.select("skey", F.col("_part").alias("inner")), "skey").join(last, "skey", "left")
    goals = cut(goals.join(edges, "skey", "left"))

    found = rank(rows.join(goals, (F.col("_skey") == F.col("skey")) & (F.col("_merit") == F.col("merit"))))
    at, to = F.struct("_slice", "_part"), F.struct(F.col("edge").alias("_slice"), F.col("inner").alias("_part"))
    taken = F.when(F.col("edge").isNull(), F.col("rest") > 0).otherwise((at < to) | ((at == to) & (F.struct("_q", "_key") <= F.col("last"))))
    taken = F.coalesce(taken, F.lit(False)) & F.col("_q").isNotNull()
    return found.select(*[F.col(n).alias(c) for c, n in names.items()], "_size", F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), (F.col("whole") + taken.cast("int")).cast("long").alias("_copies"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``; edge cases as in ``mix``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mix(docs)
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.round("_target", 6).alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


OP6_SQL = r"""
WITH i AS (
  SELECT doc_id, text, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey, coalesce(CAST(doc_id AS VARCHAR), 't' || md5(coalesce(text, ''))) AS id FROM documents),
k AS (
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY skey, id) = 1 THEN id
                 ELSE id || ':' || md5(coalesce(text, '')) || ':' || row_number() OVER (PARTITION BY skey, id, md5(coalesce(text, ''))) END AS key FROM i),
d0 AS (
  SELECT doc_id, skey, key, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         (('0x' || substr(md5('17:' || key), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM k),
d AS (SELECT *, CASE WHEN size < 16 THEN 0.5::DOUBLE WHEN size < 64 THEN 0.75::DOUBLE WHEN size < 1024 THEN 1.0::DOUBLE ELSE 1.25::DOUBLE END AS merit FROM d0),
s AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY skey),
r AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY skey) - 1) % 3 + 1] AS w, 3.0::DOUBLE * source_size AS c FROM s),
l AS (SELECT *, row_number() OVER (ORDER BY c / w, skey) AS rn,
             ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(c) OVER (ORDER BY c / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
               / sum(w) OVER (ORDER BY c / w, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM r),
t AS (SELECT skey, source_size, coalesce(least(c, w * (SELECT min_by(lev, rn) FROM l WHERE c / w >= lev)), c) AS target FROM l),
m AS (SELECT skey, merit, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY skey, merit),
-- expected copies in proportion to merit: each way of capping the k classes of highest merit, and the first that leaves the others below the cap
v AS (SELECT a.skey, a.merit, t.target, a.words,
             t.target - 3.0::DOUBLE * coalesce((SELECT sum(b.words) FROM m b WHERE b.skey = a.skey AND b.merit > a.merit), 0)::DOUBLE AS free,
             (SELECT sum(b.words * b.merit) FROM m b WHERE b.skey = a.skey AND b.merit <= a.merit) AS weight
      FROM m a JOIN t USING (skey)),
x AS (SELECT *, CASE WHEN weight > 0 THEN free / weight ELSE 0.0 END AS rate FROM v),
y AS (SELECT skey, max_by(rate, merit) AS lvl FROM x WHERE rate * merit <= 3.0 GROUP BY skey),
e AS (SELECT x.skey, x.merit, x.words, x.target, CASE WHEN y.lvl IS NULL THEN 3.0::DOUBLE ELSE least(3.0::DOUBLE, y.lvl * x.merit) END AS copies FROM x LEFT JOIN y USING (skey)),
g AS (SELECT *, floor(copies) AS whole, copies - floor(copies) AS p, target - sum(floor(copies) * words) OVER (PARTITION BY skey) AS rest FROM e),
q AS (SELECT d.*, g.whole, g.rest, t.source_size, t.target, CASE WHEN g.p > 0 THEN (d.u / (1 - d.u)) / (g.p / (1 - g.p)) END AS q
      FROM d JOIN g ON g.skey = d.skey AND g.merit = d.merit JOIN t ON t.skey = d.skey),
n AS (SELECT *, CASE WHEN q IS NOT NULL THEN sum(size) OVER (PARTITION BY skey, q IS NULL ORDER BY q, key ROWS UNBOUNDED PRECEDING) - size / 2.0 END AS mid FROM q)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 6) AS target,
       CAST(size * (whole + CASE WHEN q IS NOT NULL AND mid <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM n
"""
