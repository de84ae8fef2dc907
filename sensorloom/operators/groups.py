"""Labels that share a group of any size: membership with counts, and correlations by blocks of labels and times."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labels of a tile, and times of a block, that a task holds as one matrix.
TILE, TIMES = 256, 4096
#: Correlations of this size or more support a relationship.
SUPPORT = 0.3
#: A series is constant where its variance is this part of its mean square or less.
FLAT = 1e-12


def group_table(members: DataFrame) -> DataFrame:
    """``(kind, key, n)`` of groups of two labels or more, from ``members(raw_label, kind, key)``."""
    return members.select("raw_label", "kind", "key").distinct().groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")


def memberships(members: DataFrame) -> DataFrame:
    """``(raw_label, kind, key, others)``: the groups of each label, and how many others share them.

    With the member table this says all that pairs of labels do, in as many rows as there are members.
    """
    m = members.select("raw_label", "kind", "key").distinct()
    return m.join(group_table(m), ["kind", "key"]).select("raw_label", "kind", "key", (F.col("n") - 1).alias("others"))


def tiled(series: DataFrame, members: DataFrame, constants: DataFrame) -> DataFrame:
    """Centred samples of each label of a group, once per pair of tiles that its tile is in, by block of times."""
    m = members.select("raw_label", "kind", "key").distinct().join(constants, "raw_label", "left_anti")
    span = series.groupBy("raw_label").agg(F.avg("value").alias("_mean"), F.count("*").alias("_rows"))
    m = m.join(span, "raw_label")
    sizes = m.groupBy("kind", "key").agg(F.count("*").alias("_n"), F.max("_rows").alias("_most")).where("_n > 1")
    sizes = sizes.select("kind", "key", F.ceil(F.col("_n") / TILE).cast("int").alias("_tiles"), F.ceil(F.col("_most") / TIMES).cast("int").alias("_times"))
    placed = m.join(sizes, ["kind", "key"]).withColumn("_tile", F.pmod(F.xxhash64("raw_label"), F.col("_tiles")).cast("int"))
    placed = placed.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    placed = placed.select("raw_label", "kind", "key", F.least("_tile", "_with").alias("i"), F.greatest("_tile", "_with").alias("j"), (F.col("_tile") > F.col("_with")).alias("second"), "_mean", "_times")
    cells = series.select("raw_label", "ts_text", "value").join(placed, "raw_label")
    block = F.pmod(F.xxhash64("ts_text"), F.col("_times")).cast("int").alias("block")
    return cells.select("kind", "key", "i", "j", block, "second", "raw_label", "ts_text", (F.col("value") - F.col("_mean")).alias("value"))


class _Sums:
    """Sums over common times of all pairs of two tiles."""

    NAMES = ("n", "x", "y", "xx", "yy", "xy")

    def __init__(self, one: bool):
        self.one, self.left, self.right = one, {}, {}
        self.right = self.left if one else self.right
        self.sums = {c: np.zeros((0, 0)) for c in self.NAMES}

    def add(self, frame: pd.DataFrame) -> None:
        times, at = np.unique(frame["ts_text"].to_numpy(object).astype(str), return_inverse=True)
        second = frame["second"].to_numpy(bool)
        sides = []
        for known, rows in ((self.left, np.ones(len(frame), bool) if self.one else ~second), (self.right, np.ones(len(frame), bool) if self.one else second)):
            labels = frame["raw_label"].to_numpy(object)[rows]
            for name in labels:
                known.setdefault(name, len(known))
            x, m = np.zeros((len(known), len(times))), np.zeros((len(known), len(times)))
            place = [known[name] for name in labels]
            x[place, at[rows]], m[place, at[rows]] = frame["value"].to_numpy(float)[rows], 1
            sides.append((x, m))
        (x, a), (y, b) = sides
        for c, v in zip(self.NAMES, (a @ b.T, x @ b.T, a @ y.T, (x * x) @ b.T, a @ (y * y).T, x @ y.T)):
            old = self.sums[c]
            v[: old.shape[0], : old.shape[1]] += old
            self.sums[c] = v

    def pairs(self) -> tuple[list, list, np.ndarray, np.ndarray, np.ndarray]:
        """Names of both sides, which pairs met, at how many times, and their correlation (not a number if one is constant)."""
        n, x, y, xx, yy, xy = (self.sums[c] for c in self.NAMES)
        with np.errstate(all="ignore"):
            vx, vy = xx - x * x / n, yy - y * y / n
            r = (xy - x * y / n) / np.sqrt(vx * vy)
        r[(n < 2) | ~(vx > FLAT * xx) | ~(vy > FLAT * yy)] = np.nan
        left, right = list(self.left), list(self.right)
        met = n > 0
        if self.one:
            met &= np.array(left, object)[:, None] < np.array(right, object)[None, :]
        return left, right, met, n, r


def _as_pairs(group: tuple, s: _Sums) -> pd.DataFrame:
    left, right, met, n, r = s.pairs()
    i, j = np.nonzero(met)
    a, b = np.array(left, object)[i], np.array(right, object)[j]
    a, b = np.where(a < b, a, b), np.where(a < b, b, a)
    return pd.DataFrame({"kind": group[0], "key": group[1], "a": a, "b": b, "n": n[i, j].astype(np.int64), "r": r[i, j]})


def _as_counts(group: tuple, s: _Sums) -> pd.DataFrame:
    """Of each label of two tiles: partners by verdict, and the strongest of them."""
    left, right, met, n, r = s.pairs()
    if s.one:
        met, r = met | met.T, r
    size = np.where(met, np.abs(np.round(r, 6)), np.nan)
    out = []
    for names, others, m, q, w in ((left, right, met, size, r), *(() if s.one else ((right, left, met.T, size.T, r.T),))):
        if not names or not others:
            continue
        order = np.argsort(np.array(others, object).astype(str), kind="stable")
        q_, w_ = q[:, order], w[:, order]
        best = np.where(np.isnan(q_), -1.0, q_).argmax(axis=1)
        line = np.arange(len(names))
        some = ~np.isnan(q_[line, best])
        f = pd.DataFrame({"kind": group[0], "key": group[1], "raw_label": names, "supported": (m & (np.abs(w) >= SUPPORT)).sum(axis=1), "no_signal": (m & (np.abs(w) < SUPPORT)).sum(axis=1), "skipped": (m & np.isnan(w)).sum(axis=1)})
        f["best"] = pd.array(np.where(some, np.array(others, object)[order][best], None), dtype=object)
        f["best_r"] = np.where(some, w_[line, best], np.nan)
        out.append(f[m.any(axis=1)])
    return pd.concat(out) if out else pd.DataFrame(columns=["kind", "key", "raw_label", "supported", "no_signal", "skipped", "best", "best_r"])


PAIRS = "kind string, key string, a string, b string, n long, r double"
COUNTS = "kind string, key string, raw_label string, supported long, no_signal long, skipped long, best string, best_r double"


def _over_blocks(cells: DataFrame, give, schema: str) -> DataFrame:
    """``give(group, sums)`` of each pair of tiles; a task holds one block of times of them at once."""
    order = ["kind", "key", "i", "j", "block"]
    placed = cells.repartition("kind", "key", "i", "j").sortWithinPartitions(*order)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        now, sums = None, None
        arrow = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
        kinds = pa.schema([(c.split()[0], arrow[c.split()[1]]) for c in schema.split(", ")])

        def blocks():
            held, tag = [], None
            for b in batches:
                frame = b.to_pandas()
                if not len(frame):
                    continue
                edges = [*np.flatnonzero(frame[order].ne(frame[order].shift()).any(axis=1).to_numpy()).tolist(), len(frame)]
                for lo, hi in zip(edges[:-1], edges[1:]):
                    part = frame.iloc[lo:hi]
                    if held and tuple(part[order].iloc[0]) != tag:
                        yield pd.concat(held)
                        held = []
                    held.append(part)
                    tag = tuple(part[order].iloc[0])
            if held:
                yield pd.concat(held)

        def done():
            return pa.RecordBatch.from_pandas(give(now, sums)[names], schema=kinds, preserve_index=False)

        for f in blocks():
            group = tuple(f[order[:4]].iloc[0])
            if group != now:
                if now is not None:
                    yield done()
                now, sums = group, _Sums(group[2] == group[3])
            sums.add(f)
        if now is not None:
            yield done()

    return placed.mapInArrow(run, schema)


def pair_correlations(series: DataFrame, members: DataFrame, constants: DataFrame) -> DataFrame:
    """``(a, b, n, r)`` of each unordered pair of a group with a common time, once even if it shares several groups.

    ``series(raw_label, ts_text, value)`` has one value per label and time; labels of ``constants`` are left out. A series
    moves once per tile of its group, as a line of a matrix; sums of all pairs of two tiles are matrix products.
    """
    pairs = _over_blocks(tiled(series, members, constants), _as_pairs, PAIRS)
    return pairs.dropDuplicates(["a", "b"]).select("a", "b", "n", F.nanvl("r", F.lit(None)).alias("r"))


def correlation_counts(series: DataFrame, members: DataFrame, constants: DataFrame) -> DataFrame:
    """``(kind, key, raw_label, supported, no_signal, skipped, best, best_r)`` of each label of a group: how many others go with
    it, do not, or cannot be told, and the one whose correlation is the largest (the first by name of equals to six digits).

    The pairs themselves are counted where they are worked out, so that a group of n labels gives n rows, not n squared.
    """
    parts = _over_blocks(tiled(series, members, constants), _as_counts, COUNTS)
    best = F.struct((-F.abs(F.round("best_r", 6))).alias("size"), F.col("best").alias("best"), F.col("best_r").alias("best_r"))
    total = parts.groupBy("kind", "key", "raw_label").agg(*[F.sum(c).alias(c) for c in ("supported", "no_signal", "skipped")], F.min(F.when(F.col("best").isNotNull(), best)).alias("_best"))
    return total.select("kind", "key", "raw_label", "supported", "no_signal", "skipped", "_best.best", "_best.best_r")
