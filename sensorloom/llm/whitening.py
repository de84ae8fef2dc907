"""Whitening of embeddings by contour integration of the covariance (operator 12)."""

from __future__ import annotations

import decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table

#: Components returned, steps of a vector's entry, and the largest entry: larger ones count as this.
COMPONENTS, STEPS, LIMIT = 4, 256, 1 << 40
#: Points of the quadrature on the upper half of a contour.
NODES = 16
#: Eigenvalues below this part of the trace count as zero, and two of them this near count as one.
TINY = 1e-12


def usable(values):
    """Whether a list column holds entries, all of them finite numbers."""
    finite = F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(values) > 0) & finite, F.lit(False))


def stepped(values, steps: int, limit: int):
    """Each entry in whole steps, rounded down."""
    return F.transform(values, lambda x: F.floor(F.greatest(F.lit(-float(limit)), F.least(F.lit(float(limit)), x * F.lit(float(steps))))).cast("long"))


def of_one_length(vectors: DataFrame, column: str) -> DataFrame:
    """The vectors of the most frequent length, of equally frequent ones the longest."""
    sizes = vectors.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return vectors.where(F.size(column) == (sizes["d"] if sizes else 0))


def lists(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def exact_sums(vectors: DataFrame, row_of) -> dict:
    """Entrywise exact sums over ``vectors(x)`` of what ``row_of(x)`` gives: ``{i: [sums]}`` of a matrix whose size does not
    depend on the number of vectors. Each task adds up what it reads; the sums of tasks meet by entry."""

    def run(batches):
        total = None
        for b in batches:
            for k in range(0, b.num_rows, 4096):
                x = lists(b.column("x").slice(k, 4096))
                if x.size:
                    m = row_of(x)
                    total = m if total is None else total + m
        if total is not None:
            flat = [decimal.Decimal(int(v)) for v in total.ravel()]
            i, j = (np.indices(total.shape).reshape(2, -1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(flat, pa.decimal128(38, 0))], names=["i", "j", "v"])

    entries = vectors.select("x").mapInArrow(run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r["i"], r["j"]): int(r["v"]) for r in entries.collect()}  # as many as the matrix has entries


def products(x: np.ndarray) -> np.ndarray:
    """The matrix of sums of products, in Python's integers where 64 bits may not hold them."""
    most = int(np.abs(x).max(initial=0))
    if most * most * len(x) < 1 << 53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T @ y


def covariance(vectors: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """``(n, sums, covariance)`` of distinct integer ``vectors(x)``: exact up to one last rounding.

    Entries are centred on the rounded mean before they are multiplied; what the rounding leaves is taken off exactly.
    """
    ones = exact_sums(vectors, lambda x: np.vstack([x.astype(object).sum(axis=0), np.full(x.shape[1], len(x), object)]))
    if not ones:
        return 0, [], np.zeros((0, 0))
    d = max(j for _, j in ones) + 1
    n, sums = ones[1, 0], [ones[0, j] for j in range(d)]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    at = np.array(middle, np.int64)
    second = exact_sums(vectors, lambda x: products(x - at))
    left = [s - n * c for s, c in zip(sums, middle)]
    v = np.array([[float(Fraction(second[i, j] * n - left[i] * left[j], n * n)) for j in range(d)] for i in range(d)])
    return n, sums, v


def swap(a: np.ndarray, i: int, j: int) -> None:
    a[[i, j]] = a[[j, i]]
    a[:, [i, j]] = a[:, [j, i]]


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of symmetric ``v`` exceed ``shift``: the positive ones of the pivots of ``v - shift`` (inertia), whole-matrix pivoting in blocks of one and two."""
    a, k, found = v - shift * np.eye(len(v)), 0, 0
    n = len(a)
    while k < n:
        rest = np.abs(a[k:, k:])
        one = np.diag(rest)
        off = np.triu(rest, 1)
        if one.max() >= 0.64 * off.max():
            p = k + int(one.argmax())
            swap(a, k, p)
            if a[k, k] == 0:
                break
            found += a[k, k] > 0
            a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k] / a[k, k], a[k, k + 1 :])
            k += 1
        else:
            p, q = (int(x) + k for x in np.unravel_index(off.argmax(), off.shape))
            swap(a, k, p)
            swap(a, k + 1, q)
            found += 1  # such a block has a negative determinant: one eigenvalue of each sign
            c = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(a[k : k + 2, k : k + 2], c.T)
            k += 2
    return int(found)


def nth(v: np.ndarray, k: int, low: float, high: float) -> float:
    """The ``k``-th largest eigenvalue, to the precision of an interval's border, by counts alone."""
    for _ in range(60):
        if high - low <= TINY * max(abs(low), abs(high)):
            break
        middle = (low + high) / 2
        low, high = (middle, high) if above(v, middle) >= k else (low, middle)
    return (low + high) / 2


def contour(v: np.ndarray, low: float, high: float, want: int) -> tuple[np.ndarray, np.ndarray]:
    """All ``want`` eigenpairs of symmetric ``v`` within (low, high), by falling eigenvalue.

    A random block is projected on their space by Gauss-Legendre quadrature of the resolvent along a circle through the
    borders (a complex shifted solve at each point); Rayleigh-Ritz in that space gives pairs, which are filtered again
    until their residuals are of rounding size. Fewer or more pairs than ``want`` raise an error.
    """
    d = len(v)
    scale, eye = np.abs(v).sum(axis=1).max(), np.eye(d)
    t, w = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 + t))
    middle, radius = (low + high) / 2, (high - low) / 2
    block = np.random.default_rng(20241105).standard_normal((d, min(d, 2 * want + 4)))
    before = np.inf
    for _ in range(60):
        image = sum(0.5 * wj * np.real(radius * turn * np.linalg.solve((middle + radius * turn) * eye - v, block.astype(complex))) for turn, wj in zip(turns, w))
        q, _ = np.linalg.qr(image)
        values, small = np.linalg.eigh(q.T @ v @ q)
        block = q @ small
        inside = (values > low) & (values < high)
        off = np.abs(v @ block[:, inside] - block[:, inside] * values[inside]).max(initial=0.0) / scale
        if inside.sum() == want and (off < 4e-16 or off >= before / 2 and off < 1e-13):
            order = np.argsort(-values[inside], kind="stable")
            return values[inside][order], block[:, inside][:, order]
        before = off
    raise ArithmeticError(f"{int(inside.sum())} of {want} eigenvalues were found between {low} and {high}")


def leading(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a covariance that are not zero, with unit eigenvectors in columns.

    The interval's lower border lies in the gap below them, or in the next wide enough gap where eigenvalues meet.
    """
    trace = float(np.trace(v))
    top = float(np.abs(v).sum(axis=1).max(initial=0.0))
    count = min(count, above(v, TINY * trace)) if trace > 0 else 0
    if not count:
        return np.zeros(0), np.zeros((len(v), 0))
    first = nth(v, 1, 0.0, top * 1.01)
    k, last = count, nth(v, count, 0.0, top * 1.01)
    while True:
        following = nth(v, k + 1, -top * 0.01, top * 1.01) if k < len(v) else -0.5 * last
        if last - following > 1e-9 * top or k == len(v):
            break
        k, last = k + 1, following
    low, high = (last + max(following, -last)) / 2, first + max(first - last, 0.05 * first)
    values, vectors = contour(v, low, high, above(v, low) - above(v, high))
    return values[:count], vectors[:, :count]


def projected(n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
    """Of batches with ``x``: adds ``deviation``, exact or null beyond 64 bits, and ``white``, the whitened components."""
    mean = np.array([float(Fraction(s, n)) for s in sums])
    along = vectors / np.sqrt(values)
    most = max((abs(s) for s in sums), default=0)

    def run(batches):
        total = np.array(sums, object)
        for b in batches:
            if not b.num_rows:
                continue
            x = lists(b.column("x"))
            reach = n * int(np.abs(x).max(initial=0)) + most
            if reach * reach * len(sums) < 1 << 62:
                deviation = pa.array(((n * x - total.astype(np.int64)) ** 2).sum(axis=1))
            else:
                deviation = pa.array([v if v < 1 << 63 else None for v in (((n * x.astype(object) - total) ** 2).sum(axis=1)).tolist()], pa.int64())
            white = (x - mean) @ along
            nested = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1], pa.array(white.ravel()))
            kept = [c for c in b.schema.names if c != "x"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], deviation, nested], names=[*kept, "deviation", "white"])

    return run


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``, a row per vector and component; ids keep their type.

    Entries become whole steps of 1/256, rounded down. The covariance is that of the distinct vectors in steps: exact
    integer sums that tasks add up, so it does not depend on the order of rows. It has as many entries as a vector's
    length squared, whatever the rows, and its leading eigenpairs are found on the driver by contour integration
    (``leading``), verified by inertia counts. Rows and distinct vectors never leave the executors.

    Rows whose vector is null, empty or holds null, infinite or not-a-number entries go, and so do those of another length than
    the most frequent one. Entries beyond ``LIMIT`` steps count as ``LIMIT``. A null or repeated id is an id like
    others, and repeated vectors count once in the fit. ``deviation`` is null where 64 bits do not hold it. Vectors
    shorter than ``components`` give as many components as entries. Components without variance (one vector, all
    equal, or too few) have a null ``whitened`` and are left out of ``identity_error``, which is null where none has
    any. An empty table gives an empty result. Other columns of ``rows`` are not read, whatever their names.
    """
    values = F.col(vector_col).cast("array<double>")
    base = rows.select(F.col(id_col).alias("id"), values.alias("x")).where(usable(values)).select("id", stepped(F.col("x"), STEPS, LIMIT).alias("x"))
    base = of_one_length(cut(base), "x")
    fit = cut(base.select("x").distinct())
    n, sums, v = covariance(fit)
    eigenvalues, vectors = leading(v, min(components, len(v)))
    found, trace = len(eigenvalues), float(np.trace(v)) if n else 0.0
    run = projected(n or 1, sums, eigenvalues, vectors)
    white = fit.mapInArrow(run, "deviation long, white array<double>").select(*[F.col("white")[k].alias(f"w{k}") for k in range(found)])
    error = None
    if found:
        means = white.agg(*[F.avg(c).alias(c) for c in white.columns]).first()
        pairs = [(i, j) for i in range(found) for j in range(i, found)]
        seconds = white.agg(*[F.avg((F.col(f"w{i}") - means[i]) * (F.col(f"w{j}") - means[j])) for i, j in pairs]).first()
        error = max(abs(s - (i == j)) for s, (i, j) in zip(seconds, pairs))
    given = T.StructType([base.schema["id"], T.StructField("deviation", T.LongType()), T.StructField("white", T.ArrayType(T.DoubleType()))])
    shares = [float(e / trace) for e in eigenvalues] + [0.0 if trace else None] * (min(components, len(v)) - found)
    numbers = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("component"), F.lit(s).cast("double").alias("explained")) for k, s in enumerate(shares)])) if shares else F.explode(F.array().cast("array<struct<component:int,explained:double>>"))
    out = base.mapInArrow(run, given).select("id", "deviation", "white", numbers.alias("c"))
    whitened = F.when(F.col("c.component") <= found, F.try_element_at("white", F.col("c.component")))
    out = out.select("id", F.col("c.component").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", whitened.alias("whitened"), F.col("c.explained").alias("explained"), F.lit(error).cast("double").alias("identity_error"))
    return out.withColumnRenamed("id", id_col)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of all ``embeddings``; edge cases as in ``whiten``."""
    return whiten(table(spark, sf_dir, "embeddings"))
