"""N-gram Jaccard self-join of documents by chosen paths (operator 8)."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_group, components, cut, discard, fixed_lists, salted_join, sorted_groups, spanning, table

SHINGLE, THRESHOLD = 5, 0.8
#: Minwise tokens of a set, and how many of them a node samples: a set enters a child node for each.
TOKENS, BRANCH = 128, 2
#: A bucket of at most LEAF sets is compared by brute force; a larger one splits again, unless its sets are mostly alike: those are compared in tiles of TILE sets.
LEAF, TILE = 1000, 2000
#: Tokens by which a large bucket's mean similarity is estimated, and levels after which what is left goes in tiles.
PROBES, DEEPEST = 8, 30
#: Chance that a pair at the threshold is brought together, over all runs, however deep its paths go.
TARGET = 0.9999
#: Least equal bits of two sketches: six deviations under what the threshold gives.
BITS = 95


def recall_of_run(threshold: float = THRESHOLD, branch: int = BRANCH) -> float:
    """Least chance that a run of paths of any depth keeps a pair at ``threshold`` together.

    A node keeps the pair if one of the ``branch`` tokens it samples is shared and that child keeps it. As
    ``branch * threshold`` exceeds 1, this settles above 0 and does not fall with depth.
    """
    q = 1.0
    for _ in range(1000):
        q = 1 - (1 - threshold * q) ** branch
    return q


#: Runs repeated until the chance that a pair at the threshold is missed by all is at most 1 - TARGET.
RUNS = math.ceil(math.log(1 - TARGET) / math.log(1 - recall_of_run()))
SLOTS = RUNS * BRANCH

_RNG = np.random.default_rng(20240817)
_A = _RNG.integers(0, 2**32, TOKENS, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, TOKENS, dtype=np.uint32)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sets of hashed five-word shingles, with powers of the rolling hash kept between texts."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; a text of fewer than five words has one shingle, an empty one none. Case is ignored."""
        joined = " ".join((text or "").lower().split()).encode()
        if not joined:
            return np.empty(0, np.uint64)
        data = np.frombuffer(joined, np.uint8)
        gaps = np.flatnonzero(data == 32)
        starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(data)]
        if len(starts) > SHINGLE:
            starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1 :]
        else:
            starts, ends = starts[:1], ends[-1:]
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        return np.unique(mix64((sums[ends] - sums[starts]) * self.down[starts]))


def signature(hashes: np.ndarray) -> np.ndarray:
    low = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(hashes), 512):
        part = (hashes[i : i + 512] >> np.uint64(32)).astype(np.uint32)
        low = np.minimum(low, (part[:, None] * _A + _B).min(axis=0))
    return low


def sketches(tokens: np.ndarray) -> np.ndarray:
    """One bit of each minwise token, as two 64-bit numbers."""
    # a scrambled bit: the lowest one of a multiply-add would follow the input's
    bit = (mix64(tokens.astype(np.uint64) + np.uint64(77)) & np.uint64(1)).astype(np.uint64)
    return (bit.reshape(len(tokens), 2, 64) << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def described(texts: DataFrame) -> DataFrame:
    """``(id, digest, key, n, s1, s2, tokens)`` of ``texts(id, digest, text)``: 128 bits of the set's digest, its size, sketch and minwise tokens."""

    def run(batches):
        shingler = Shingler()
        for b in batches:
            keys, n, tokens = [], [], []
            for t in b.column("text").to_pylist():
                h = shingler(t)
                n.append(len(h))
                keys.append(set_key(h))
                tokens.append(signature(h))
            tokens = np.array(tokens, np.uint32).reshape(-1, TOKENS)
            s = sketches(tokens).view(np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * TOKENS), pa.array(tokens.view(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("digest"), pa.array(keys, pa.binary()), pa.array(n, pa.int32()), pa.array(s[:, 0]), pa.array(s[:, 1]), listed], names=["id", "digest", "key", "n", "s1", "s2", "tokens"])

    added = [T.StructField("key", T.BinaryType()), T.StructField("n", T.IntegerType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()), T.StructField("tokens", T.ArrayType(T.IntegerType()))]
    return texts.mapInArrow(run, T.StructType([texts.schema["id"], texts.schema["digest"], *added]))


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def met_before(i, j, slots, deep, slot: int, bucket: int):
    """Of index pairs of one bucket: whether they share a bucket that comes earlier, where they are compared.

    The order is that of the first level's slots, then that of deeper buckets by number.
    """
    width = SLOTS if slot < 0 else slot
    met = ((slots[i, :width] == slots[j, :width]) & (slots[i, :width] != 0)).any(axis=1) if width else np.zeros(len(i), bool)
    if slot < 0:
        for k in np.flatnonzero(~met):
            met[k] = any(x < bucket for x in deep[i[k]] & deep[j[k]])
    return met


def pairs_at(size, side, sketch, slots, deep, slot: int, bucket: int):
    """Index pairs of one bucket that sketches, sizes and sides allow and that meet in no earlier bucket."""
    found = []
    for lo in range(0, len(size), 256):
        i = np.arange(lo, min(lo + 256, len(size)))[:, None]
        j = np.arange(lo, len(size))[None, :]
        keep = (i < j) & ((side[i] == 0) | (side[i] != side[j]))
        keep &= np.minimum(size[i], size[j]) >= THRESHOLD * np.maximum(size[i], size[j]) - 1e-9
        x, y = np.nonzero(keep)
        x, y = x + lo, y + lo
        near = 128 - np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64) >= BITS
        x, y = x[near], y[near]
        new = ~met_before(x, y, slots, deep, slot, bucket)
        found.append((x[new], y[new]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact Jaccard similarities of the pairs."""
    size = np.array([len(s) for s in sets], np.int64)
    if len(i) <= 32:
        shared = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    else:
        owner = np.repeat(np.arange(len(sets)), size)
        values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        often = count > 1
        place = np.cumsum(often) - 1
        keep = often[at]
        row, col = owner[keep], place[at[keep]]
        both = np.zeros((len(sets), len(sets)), np.float32)
        width = max(256, 20_000_000 // max(1, len(sets)))
        for lo in range(0, int(often.sum()), width):
            inside = (col >= lo) & (col < lo + width)
            m = np.zeros((len(sets), width), np.float32)
            m[row[inside], col[inside] - lo] = 1
            both += m @ m.T
        shared = both[i, j].astype(np.int64)
    return shared / (size[i] + size[j] - shared)


def columns(t):
    sketch = np.c_[t.column("s1").to_numpy(), t.column("s2").to_numpy()].view(np.uint64)
    deep = [frozenset(d or ()) for d in t.column("deep").to_pylist()]
    return t.column("set").to_numpy(), t.column("n").to_numpy().astype(np.int64), t.column("side").to_numpy(), sketch, fixed_lists(t.column("slots"), SLOTS), deep, t.column("slot").to_numpy(), t.column("bucket").to_numpy()


def candidates(t, bounds):
    """``(lo, hi, i, j)`` of each group of a table that has pairs to verify."""
    _, n, side, sketch, slots, deep, slot, bucket = columns(t)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo > 1:
            i, j = pairs_at(n[lo:hi], side[lo:hi], sketch[lo:hi], slots[lo:hi], deep[lo:hi], int(slot[lo]), int(bucket[lo]))
            if len(i):
                yield lo, hi, i, j


def promising(batches):
    """Of sorted groups: the (set, group) that have a pair to verify."""
    for t, bounds in sorted_groups(batches, "g"):
        hits = [lo + np.unique(np.r_[i, j]) for lo, _, i, j in candidates(t, bounds)]
        if hits:
            yield from t.select(["set", "g", "side", "slot", "bucket"]).take(pa.array(np.concatenate(hits))).to_batches()


def verified(batches):
    """Of sorted groups with whole sets: links of each set, in documents, and a forest of the linked sets."""
    for t, bounds in sorted_groups(batches, "g"):
        which, copies, raw = t.column("set").to_numpy(), t.column("copies").to_numpy(), t.column("hashes")
        out: list[tuple[int, int, int | None]] = []
        for lo, hi, i, j in candidates(t, bounds):
            sets = [np.frombuffer(raw[k].as_py(), np.uint64) for k in range(lo, hi)]
            good = overlaps(sets, i, j) >= THRESHOLD - 1e-12
            i, j = i[good], j[good]
            if not len(i):
                continue
            links = np.bincount(i, copies[lo + j], hi - lo) + np.bincount(j, copies[lo + i], hi - lo)
            out += [(int(which[lo + k]), int(links[k]), None) for k in np.flatnonzero(links)]
            out += [(int(which[lo + a]), 0, int(which[lo + b])) for a, b in spanning(hi - lo, i.tolist(), j.tolist())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], names=["set", "links", "other"])


def place(run: int | Column, code: int | Column):
    """Which minwise token is sampled for a child ``code`` of a run; nodes are numbered as in a heap, so a path of six levels repeats none."""
    return (code + run * (TOKENS // RUNS)) % TOKENS


def buckets_of(sets: DataFrame) -> DataFrame:
    """``(set, slot, bucket, size, level)``: the buckets in which the paths of each set end; those of one set are left out.

    All sets are in the root of each run. A node samples ``BRANCH`` tokens; a set enters the child of each token's value.
    A bucket above ``LEAF`` splits again while the mean similarity of its sets, as ``PROBES`` tokens show it, is below
    1 / ``BRANCH``: then each level leaves fewer pairs to compare. A bucket of sets that are more alike ends there.
    Sizes are counted with partial sums and joined back by salted keys, so a bucket with a third of all sets is no
    single task's. ``slot`` is the place among the first level's buckets, -1 below it.
    """
    order = np.random.default_rng(7).permutation(TOKENS).tolist()
    start = [(r, BRANCH + k) for r in range(RUNS) for k in range(BRANCH)]
    entries = [F.struct(F.lit(s).alias("slot"), F.lit(r).alias("run"), F.lit(c).cast("long").alias("code"), F.xxhash64(F.lit(r), F.lit(c), F.col("tokens")[order[place(r, c)]]).alias("bucket")) for s, (r, c) in enumerate(start)]
    rows = sets.select("set", F.explode(F.array(*entries)).alias("e")).select("set", "e.*")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    rows, done = cut(salted_join(rows, sizes, "bucket", "set")), None
    for level in range(1, DEEPEST + 1):

        def ended(part: DataFrame) -> DataFrame:
            part = part.select("set", "slot", "bucket", "size", F.lit(level).alias("level"))
            return part if done is None else done.unionByName(part)

        large = rows.where(F.col("size") > LEAF)
        if level == DEEPEST or not large.head(1):
            return ended(rows)
        done = ended(rows.where(F.col("size") <= LEAF))
        child, tokens = F.col("code") * BRANCH, F.array(*[F.lit(x) for x in order])
        value = lambda k: F.get(F.col("tokens"), F.get(tokens, ((place(F.col("run"), child + k) + (11 * k if k >= BRANCH else 0)) % TOKENS).cast("int")))
        probes = F.array(*[F.xxhash64("bucket", F.lit(k), value(k)) for k in range(PROBES)])
        kids = cut(large.join(sets.select("set", "tokens"), "set").select("set", "slot", "run", "code", "bucket", "size", probes.alias("kids")))
        found = cut(kids.select("bucket", "size", F.posexplode("kids").alias("k", "child")).groupBy("bucket", "size", "k", "child").agg(F.count("*").alias("n")).where("n > 1"))
        likeness = F.sum(F.pow(F.col("n") / F.col("size"), F.lit(2.0))) / PROBES
        alike = cut(found.groupBy("bucket", "size").agg(likeness.alias("s")).where(F.col("s") >= 1 / BRANCH).select("bucket"))
        done = ended(salted_join(large, alike, "bucket", "set"))
        onward = found.where(F.col("k") < BRANCH).join(alike, "bucket", "left_anti").select("child", "n")
        rows = kids.select("set", F.lit(-1).alias("slot"), "run", "code", F.posexplode(F.slice("kids", 1, BRANCH)).alias("k", "child")).withColumn("code", F.col("code") * BRANCH + F.col("k")).drop("k")
        rows = cut(salted_join(rows, onward, "child", "set").select("set", "slot", "run", "code", F.col("child").alias("bucket"), F.col("n").alias("size")))
        discard(kids)


def dealt(rows: DataFrame) -> DataFrame:
    """Adds the group ``g`` and ``side`` in which a row is compared; a bucket above LEAF is compared tile by tile.

    Each two tiles of it meet in one group, where only rows of different sides are compared, so every pair is
    compared once, however large the bucket, and no group exceeds about twice TILE.
    """
    tiles = F.when(F.col("size") <= LEAF, 1).otherwise(F.ceil(F.col("size") / TILE)).cast("int")
    rows = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("set", "bucket"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("to", F.explode(F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1))))
    side = F.when(F.col("to") == F.col("tile"), 0).when(F.col("tile") < F.col("to"), 1).otherwise(2)
    return rows.withColumn("side", side.cast("int")).withColumn("g", F.xxhash64("bucket", F.least("tile", "to"), F.greatest("tile", "to"))).drop("tiles", "tile", "to")


def classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, digest, class_id, root, n_links)`` of rows with an id: ``digest`` of the text, ``root`` names the class."""
    text = F.col(text_col).cast("string")
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.md5(F.coalesce(text, F.lit(""))).alias("digest"), text.alias("text"))
    known = cut(described(texts))
    sets = known.where("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.min(F.struct("id", "digest"))["digest"].alias("rep_digest"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "s1", "s2", "tokens")])
    # numbered once, as the table is written; two sets never share a number
    sets = cut(sets.withColumn("set", F.monotonically_increasing_id()))
    ends = buckets_of(sets)
    slot = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda r: F.coalesce(F.element_at("ends", r), F.lit(0).cast("long")))
    first, later = F.col("level") == 1, F.col("level") > 1
    lists = ends.groupBy("set").agg(F.map_from_entries(F.collect_list(F.when(first, F.struct("slot", "bucket")))).alias("ends"), F.collect_set(F.when(later, F.col("bucket"))).alias("deep"), F.collect_list(F.struct("slot", "bucket", "size")).alias("all"))
    placed = cut(lists.join(sets.drop("tokens", "key"), "set").withColumn("slots", slot).drop("ends"))
    facts = ["n", "s1", "s2", "slots", "deep"]
    rows = dealt(placed.withColumn("e", F.explode("all")).select("set", *facts, "e.*"))
    hits = cut(by_group(rows.select("set", "g", "side", "slot", "bucket", *facts), "g", promising, "set long, g long, side int, slot int, bucket long"))

    need = hits.groupBy("set").agg(F.collect_list(F.struct("g", "side", "slot", "bucket")).alias("groups"))
    need = need.join(placed.select("set", "rep", "rep_digest", "copies", *facts), "set")
    whole = texts.join(need.withColumnRenamed("rep", "id").withColumnRenamed("rep_digest", "digest"), ["id", "digest"])

    def hashed(batches):
        shingler = Shingler()
        for b in batches:
            names = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array([shingler(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())], names=[*names, "hashes"])

    names = ["set", "groups", "copies", *facts]
    whole = whole.select(*names, "text")
    whole = whole.mapInArrow(hashed, T.StructType([*whole.schema.fields[:-1], T.StructField("hashes", T.BinaryType())])).dropDuplicates(["set"])
    whole = whole.withColumn("e", F.explode("groups")).select("set", "e.*", "copies", *facts, "hashes")
    found = cut(by_group(whole, "g", verified, "set long, links long, other long"))

    linked = found.where("links > 0").groupBy("set").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null").select(F.col("set").alias("a"), F.col("other").alias("b")))
    reps = sets.select("set", "key", "rep", "copies")
    least = joined.join(reps, joined["node"] == reps["set"]).select("set", "component", "rep")
    least = salted_join(least, least.groupBy("component").agg(F.min("rep").alias("low")), "component", "set").select("set", "low", "component")
    merged = reps.join(linked, "set", "left").join(least, "set", "left")
    merged = merged.select("key", F.coalesce("low", "rep").alias("class_id"), F.coalesce("component", "set").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = salted_join(known.where("n > 0").select("id", "digest", "key"), merged, "key", "id", 4).drop("key")
    alone = known.where("n = 0").select("id", "digest", F.col("id").alias("class_id"), F.lit(None).cast("long").alias("root"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(alone)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, class_id, n_links)``, a row per row of ``docs``; ids keep their type.

    Documents link whose sets of five-word shingles (white-space words, case ignored) have a Jaccard similarity of
    ``THRESHOLD`` or more. ``n_links`` counts the other documents linked directly, ``class_id`` is the smallest id
    reachable over links. Documents with equal sets (128 bits of a digest) are one set with a number of copies; sets
    are found by chosen paths and proved on their whole shingles. The paths of all runs miss a pair at the threshold
    with a chance of at most ``1 - TARGET``, however deep they go; a pair is compared in the first bucket that it shares.

    Null or empty texts link with nothing and are classes of their own. Very long texts count whole. Rows with a null
    id link with nothing and return null class and 0 links. Rows that repeat an id count as documents. An empty table
    gives an empty result. Other columns of ``docs`` are not read, whatever their names.
    """
    out = classes(docs, id_col, text_col).select("id", "class_id", "n_links")
    missing = docs.where(F.col(id_col).isNull()).select(F.col(id_col).alias("id"))
    missing = missing.select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(missing).withColumnRenamed("id", id_col)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id, of repeats of that id the one whose text's
    digest comes first, and of wholly equal ones any. Rows with a null id stay, and so do all null or empty texts, each
    id once. Edge cases as in ``near_copies``; all columns stay as they are."""
    least = classes(docs, id_col, text_col).where("id = class_id")
    kept = least.groupBy("class_id", "root").agg(F.min("digest").alias("_kept")).select(F.col("class_id").alias("_id"), "_kept")
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns)}  # no name of ``docs`` can clash with those added here
    own, text = names[id_col], names[text_col]
    rows = docs.withColumnsRenamed(names).where(F.col(own).isNotNull()).withColumn("_digest", F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    rows = rows.join(kept, (F.col(own) == F.col("_id")) & (F.col("_digest") == F.col("_kept"))).dropDuplicates([own, "_digest"])
    rows = rows.select(*[F.col(n).alias(c) for c, n in names.items()])
    return rows.unionByName(docs.where(F.col(id_col).isNull()))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and link counts of all ``documents``; edge cases as in ``near_copies``."""
    return near_copies(table(spark, sf_dir, "documents"))
