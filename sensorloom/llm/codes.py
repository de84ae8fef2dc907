"""Vector codes by Lloyd rounds whose members stay where their entry lives (operator 13)."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, discard, partitions, table
from .whitening import lists, of_one_length, stepped, usable

PARTS, ENTRIES, ROUNDS, STEPS = 4, 256, 4, 1024
#: Components beyond this many steps count as this many: squared distances of 512 of them fit into 64 bits.
LIMIT = 1 << 26


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of each row's nearest entry, the lower of equals, and the squared distance; exact in integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * most * most * max(1, x.shape[1]) < 1 << 52 else np.int64
    a, c = x.astype(kind), book.astype(kind)
    to = ((c * c).sum(axis=1)[None, :] - 2 * (a @ c.T)).argmin(axis=1)
    return to.astype(np.int32), ((x - book[to]) ** 2).sum(axis=1)


def cut_up(batches):
    """Of batches of whole vectors: a row per part."""
    for b in batches:
        if not b.num_rows:
            continue
        x = lists(b.column("x"))
        x = np.pad(x, ((0, 0), (0, -x.shape[1] % PARTS)))
        n, width = len(x), x.shape[1] // PARTS
        flat = pa.ListArray.from_arrays(np.arange(n * PARTS + 1, dtype=np.int32) * width, pa.array(x.reshape(-1)))
        row = np.repeat(b.column("row").to_numpy(), PARTS)
        position = np.tile(np.arange(PARTS, dtype=np.int32), n)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(position), pa.array(np.full(n * PARTS, -1, np.int32)), flat], names=["row", "position", "entry", "part"])


def looked_up(books: list[np.ndarray]):
    """Of batches of members: where each part's nearest entry is now, and whether that is another one than before."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            position, x = b.column("position").to_numpy(), lists(b.column("part"))
            to, distance = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
            for p, book in enumerate(books):
                at = np.flatnonzero(position == p)
                for k in range(0, len(at), 4096):
                    now = at[k : k + 4096]
                    to[now], distance[now] = nearest(x[now], book)
            moved = to != b.column("entry").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("position"), pa.array(to), b.column("part"), pa.array(distance), pa.array(moved)], names=["row", "position", "entry", "part", "distance", "moved"])

    return run


def summed(batches):
    """Of the members that live in one task: count and sums of each entry."""
    totals: dict = {}
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column("position").to_numpy().astype(np.int64) << 32 | b.column("entry").to_numpy()
        x = lists(b.column("part"))
        keys, at = np.unique(key, return_inverse=True)
        sums = np.zeros((len(keys), x.shape[1] + 1), np.int64)
        np.add.at(sums, at, np.c_[x, np.ones(len(x), np.int64)])
        for k, s in zip(keys.tolist(), sums):
            totals[k] = totals[k] + s if k in totals else s
    if totals:
        keys = np.array(list(totals))
        rows = np.array([totals[k] for k in keys.tolist()])
        flat = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), flat], names=["position", "entry", "sums"])


def dealt(members: DataFrame, counts: dict[tuple[int, int], int], total: int) -> DataFrame:
    """``members`` moved to the owners of (position, entry, salt): an entry has as many owners as its share of all parts asks for."""
    spark = members.sparkSession
    n = partitions(spark)
    share = max(1, total // n)
    owners = [(p, e, math.ceil(c / share)) for (p, e), c in counts.items()]
    if not owners:
        return members
    owners = F.broadcast(spark.createDataFrame(owners, "position int, entry int, owners int"))  # a row per entry of a book
    salted = members.join(owners, ["position", "entry"]).withColumn("salt", F.pmod(F.xxhash64("row"), F.col("owners")))
    return salted.repartition(n, "position", "entry", "salt").select(*members.columns)


def coded(rows: DataFrame, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, code, error, label_error, codebooks_sha256)``, a row per usable vector; ids keep their type.

    Components become whole steps of 1/1024, rounded down; vectors are cut into four equal consecutive parts. The books of
    256 entries start as the parts of the vectors with the smallest ids and are moved by Lloyd rounds in integers. Parts
    are members that live with the owners of (position, entry, salt); a round sums the members where they live and looks
    up the new nearest entry there; members that keep their entry are not shuffled again, those that change it move to
    its owners. Only sums of entries reach the driver: their number is that of the books, whatever the rows. A popular
    entry has as many owners as its count asks for.

    Rows whose vector is null, empty or holds null, infinite or not-a-number components go, and so do those of another length than
    the most frequent one. A length that four does not divide is filled up with zeros. Components beyond ``LIMIT`` steps count
    as ``LIMIT``. Null ids come last in the order of ids, repeated ids go by their vectors. Fewer than 256 vectors make
    shorter books. Null labels are one label. An empty table gives an empty result. Other columns are not read.
    """
    spark = rows.sparkSession
    values = F.col(vector_col).cast("array<double>")
    base = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), values.alias("x")).where(usable(values))
    base = cut(base.select("id", "label", stepped(F.col("x"), STEPS, LIMIT).alias("x"), F.monotonically_increasing_id().alias("row")))
    base = of_one_length(base, "x")
    first = np.array([r["x"] for r in base.orderBy(F.asc_nulls_last("id"), "x").select("x").limit(ENTRIES).collect()], np.int64)
    if not len(first):
        first = np.zeros((1, PARTS), np.int64)
    first = np.pad(first, ((0, 0), (0, -first.shape[1] % PARTS)))
    books = [b.copy() for b in np.split(first, PARTS, axis=1)]
    members = base.select("row", "x").mapInArrow(cut_up, "row long, position int, entry int, part array<long>")
    found = "row long, position int, entry int, part array<long>, distance long, moved boolean"
    kept = ["row", "position", "entry", "part"]
    total, old = PARTS * base.count(), []
    for _ in range(rounds):
        seen = cut(members.mapInArrow(looked_up(books), found), partitions_by="moved")
        moving = seen.where("moved").select(*kept)
        counts = {(r["position"], r["entry"]): r["count"] for r in seen.groupBy("position", "entry").count().collect()}
        moved = cut(dealt(moving, counts, total))
        members = seen.where("not moved").select(*kept).unionByName(moved)
        sums = members.mapInArrow(summed, "position int, entry int, sums array<long>").select("position", "entry", F.posexplode("sums").alias("j", "v"))
        for p, e, v in entries(sums):
            books[p][e] = [s // v[-1] for s in v[:-1]]
        discard(*old)
        old = [seen, moved]
    last = members.mapInArrow(looked_up(books), found)
    codes = [F.format_string("%02x", F.max(F.when(F.col("position") == p, F.col("entry")))) for p in range(PARTS)]
    whole = last.groupBy("row").agg(F.concat(*codes).alias("code"), F.sum("distance").alias("error"))
    out = cut(base.select("row", "id", "label").join(whole, "row").select("id", "label", "code", "error"))
    discard(*old)
    labels = out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b.tolist() for v in e).encode()).hexdigest()
    out = out.join(labels, F.col("label").eqNullSafe(F.col("of"))).select("id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
    return out.withColumnRenamed("id", id_col)


def entries(sums: DataFrame):
    """``(position, entry, sums and count)`` of each entry that has members: as many numbers as the books have."""
    found: dict = {}
    for r in sums.groupBy("position", "entry", "j").agg(F.sum("v").alias("v")).collect():
        found.setdefault((r["position"], r["entry"]), {})[r["j"]] = r["v"]
    return [(p, e, [v[j] for j in sorted(v)]) for (p, e), v in found.items()]


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all ``embeddings``; edge cases as in ``coded``."""
    return coded(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """Books of round 0 to 4, each assignment by the least of (squared distance, index)."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} as materialized (
  select p.vec_id, p.position, p.part, min((p.square - 2 * list_dot_product(p.part, b.part) + b.square) * 256 + b.entry)::bigint as k
  from parts p join b{r} b using (position) group by all)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} as (select position, k % 256 as entry, unnest(part) as v, generate_subscripts(part, 1) as j from a{r}),
n{r} as (
  select position, entry, list(floor(s / c) order by j) as part
  from (select position, entry, j, sum(v) as s, count(*) as c from m{r} group by all) group by all),
b{r + 1} as materialized (
  select position, entry, part, list_dot_product(part, part) as square
  from (select b.position, b.entry, coalesce(n.part, b.part) as part from b{r} b left join n{r} n using (position, entry)))""")
    return f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as x from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select vec_id, position, part, list_dot_product(part, part) as square
  from (select vec_id, position, x[(position * len(x) // 4 + 1):((position + 1) * len(x) // 4)] as part from kept, range(4) t(position))),
b0 as materialized (
  select position, row_number() over (partition by position order by vec_id) - 1 as entry, part, square
  from parts where vec_id in (select vec_id from kept order by vec_id limit 256)),{",".join(steps)},
coded as (
  select vec_id, string_agg(format('{{:02x}}', k % 256), '' order by position) as code, sum(k // 256)::bigint as error from a{ROUNDS} group by all),
books as (
  select sha256(string_agg(v::bigint::varchar, ',' order by position, entry, j)) as codebooks_sha256
  from (select position, entry, unnest(part) as v, generate_subscripts(part, 1) as j from b{ROUNDS}))
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded join kept using (vec_id), books"""


OP13_SQL = _sql()
