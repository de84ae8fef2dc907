"""Repeated windows, whitening and vector codes against brute force, with nulls, empties, ties, repeats and clashing columns."""

import collections
import hashlib
import random

import numpy as np
import pytest
from compare import assert_same
from pyspark.sql import functions as F

from sensorloom.llm import codes, suffixes, whitening

DATA = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


# --- 11: repeated windows


def windows_by_hand(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


def windows(spark, texts, length):
    got = suffixes.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), length).collect()
    return [tuple(r)[1:] for r in sorted(got, key=lambda r: r.doc_id)]


@pytest.mark.parametrize(("length", "letters"), [(2, "ab"), (9, "abc"), (40, "abcdé")])
def test_repeated_windows(spark, length, letters):
    rng = random.Random(length)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(20)]
    texts = ["".join(rng.choice(base)[rng.randrange(50) :][: rng.randrange(1, 200)] for _ in range(rng.randrange(4))) for _ in range(60)]
    texts += [None, "", "a" * 700, "ab" * 300, texts[5], texts[5], "é" * (length // 2)]
    assert windows(spark, texts, length) == windows_by_hand(texts, length)


def test_repeated_windows_of_a_shared_passage_in_different_surroundings(spark):
    rng = random.Random(4)
    some = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = some(260)
    texts = [some(rng.randrange(90)) + passage[rng.randrange(3) * 20 :][: 200 + rng.randrange(60)] + some(rng.randrange(90)) for _ in range(300)]
    got = windows(spark, texts, 200)
    assert got == windows_by_hand(texts, 200) and sum(g[1] for g in got) > 50_000


def test_repeated_windows_across_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 1000)
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh") for _ in range(3500))
    texts = [text, "x" * 50 + text[300:2900] + "y", text[:40] * 40, "z" * 5000]
    at, first, last, _ = suffixes.anchors(text.encode(), np.array([len(text)]), 40)
    assert ((at >= first) & (at + suffixes.gram_length(40) <= first + 40) & (last >= first)).all() and (first[1:] == last[:-1] + 1).all()
    ranges = []
    for held in suffixes.pieces([t.encode() for t in texts], 40):
        ranges += [(k, lo + i) for part, k, lo in held for i in range(len(part) - 39)]
    assert sorted(ranges) == [(k, i) for k, t in enumerate(texts) for i in range(len(t) - 39)]  # each window once
    assert windows(spark, texts, 40) == windows_by_hand(texts, 40)


def test_repeated_windows_of_odd_rows(spark):
    twice = "one passage that stands in two rows of this table " * 5
    rows = [(None, twice, 1), (7, twice, 2), (7, "short", 3), (8, None, 4), (9, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long").withColumn("gram", F.lit("clash")).withColumn("ranges", F.lit("clash"))
    got = sorted(tuple(r)[1:] for r in suffixes.remove_repeats(docs).collect())
    assert got == sorted(windows_by_hand([r[1] for r in rows], 200))
    none = suffixes.remove_repeats(docs.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    named = suffixes.remove_repeats(docs.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("body")), 200, "key", "body")
    assert dict(named.dtypes)["key"] == "string" and named.count() == 5


def test_registered_windows(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = {(i, *w) for (i, _), w in zip(docs, windows_by_hand([t for _, t in docs], 200))}
    assert {tuple(r) for r in suffixes.op11(spark, DATA).collect()} == want


# --- 12: whitening


def whitened_by_hand(vectors, k=4):
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, along = np.linalg.eigh(centred.T @ centred / n)
    values, along = values[::-1][:k], along[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ along / np.sqrt(values), values / np.var(fit, axis=0).sum()


def assert_white(got, ids, want):
    n, deviation, white, explained = want
    k = white.shape[1]
    table = {(r.vec_id, r.component): r for r in got}
    assert len(table) == len(got) == len(ids) * k
    ours = np.array([[table[i, c + 1].whitened for c in range(k)] for i in ids])
    assert np.abs(ours * np.sign((ours * white).sum(axis=0)) - white).max() < 1e-8
    assert all(table[i, 1].deviation == d and table[i, 1].n == n for i, d in zip(ids, deviation.tolist()))
    assert np.allclose([table[ids[0], c + 1].explained for c in range(k)], explained, rtol=1e-10)
    assert got[0].identity_error < 1e-9 and len({r.identity_error for r in got}) == 1


def test_registered_whitening(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    assert_white(whitening.op12(spark, DATA).collect(), [r.vec_id for r in rows], whitened_by_hand([r.embedding for r in rows]))


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in rng.normal(size=6) * [9, 5, 3, 2, 1, 1]], 1) for i in range(80)]
    odd = [(200, None, 1), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (202, [float("nan")] * 6, 1), (203, [float("inf")] * 6, 1), (204, [1.0, 2.0], 1), (205, [], 1)]
    twice = [(300 + i, good[0][1], None) for i in range(30)]
    df = spark.createDataFrame(good + odd + twice, VECTORS).withColumn("n", F.lit("clash")).withColumn("x", F.lit("clash"))
    kept = good + twice
    stored = {r.vec_id: r.embedding for r in df.collect() if r.vec_id not in range(200, 206)}
    assert_white(whitening.whiten(df).collect(), [r[0] for r in kept], whitened_by_hand([stored[r[0]] for r in kept]))
    assert whitening.whiten(df.limit(0)).count() == 0


def test_whitening_without_variance_and_beyond_64_bits(spark):
    alike = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 1) for i in range(5)], VECTORS)
    got = whitening.whiten(alike).collect()
    assert len(got) == 15 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, None, None)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 1) for i in range(5)], VECTORS)
    got = whitening.whiten(line).collect()
    assert all((r.whitened is None) == (r.component > 1) and abs(r.explained - (r.component == 1)) < 1e-9 for r in got)
    far = spark.createDataFrame([(i, [float(v) * 1e30, 1.0], 1) for i, v in enumerate((-1, 1, 1, 0))], VECTORS)
    got = {(r.vec_id, r.component): r for r in whitening.whiten(far).collect()}
    assert got[0, 1].deviation is None and got[3, 1].deviation == 0 and abs(got[0, 1].whitened + got[1, 1].whitened) < 1e-9


def test_inertia_and_contour():
    rng = np.random.default_rng(8)
    for values in ([5, 3, 2.9999, 2, 1, 0], [4, 4, 4, 1, 0.5, 0.1], [2, 2, 2, 2, 2, 2], [7, 1e-3, 1e-3, 0, 0, 0]):
        q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
        v = (q * values) @ q.T
        v = (v + v.T) / 2
        for shift in (-1, 0.05, 1.5, 2.5, 2.99995, 3.5, 4.5, 8):
            assert whitening.above(v, shift) == sum(x > shift for x in values)
        found, along = whitening.leading(v, 4)
        want = [x for x in values[:4] if x > 0]
        assert np.allclose(found, want, rtol=1e-9) and np.abs(v @ along - along * found).max() < 1e-12 and np.allclose(along.T @ along, np.eye(len(want)))
    assert whitening.above(np.array([[0.0, 1], [1, 0]]), 0) == 1  # a block of two
    with pytest.raises(ArithmeticError):
        whitening.contour(np.diag([3.0, 2, 1]), 1.5, 3.5, 3)


# --- 13: vector codes


def coded_by_hand(rows):
    """Plain Lloyd rounds over ``(id, vector, label)``: rows by id, order of rows kept."""
    x = np.array([[int(np.floor(1024 * float(c))) for c in r[1]] for r in rows])
    width = x.shape[1] // 4
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, tuple(x[k])))[:256]
    parts = [x[:, p * width : (p + 1) * width] for p in range(4)]
    books = [part[order].copy() for part in parts]
    near = lambda part, book: [min(range(len(book)), key=lambda e: (int(((v - book[e]) ** 2).sum()), e)) for v in part]
    for _ in range(4):
        for part, book in zip(parts, books):
            to = np.array(near(part, book))
            for e in set(to.tolist()):
                mine = part[to == e]
                book[e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    to = [near(part, book) for part, book in zip(parts, books)]
    error = [sum(int(((parts[p][k] - books[p][to[p][k]]) ** 2).sum()) for p in range(4)) for k in range(len(rows))]
    of = collections.Counter()
    for r, e in zip(rows, error):
        of[r[2]] += e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b.tolist() for v in e).encode()).hexdigest()
    return [(r[0], "".join(f"{to[p][k]:02x}" for p in range(4)), error[k], of[r[2]], digest) for k, r in enumerate(rows)]


def by_text(rows):
    return sorted(str(tuple(r)) for r in rows)


def test_registered_codes(spark):
    assert_same(spark, codes.op13, codes.OP13_SQL)


def test_codes_move_members_and_update_where_they_live(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=8) + 3 * (i % 5)], i % 3) for i in range(700)]
    rows += [(1000 + i, rows[0][1], None) for i in range(400)]  # one popular vector
    got = codes.coded(spark.createDataFrame(rows, VECTORS).repartition(5)).collect()
    assert by_text(got) == by_text(coded_by_hand(rows))


def test_codes_of_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i if i % 9 else None, [float(np.float32(v)) for v in rng.normal(size=4)], i % 2 if i % 4 else None) for i in range(40)]
    good += [(5, good[7][1], 1), (5, good[3][1], 1)]
    odd = [(200, None, 1), (201, [1.0, None, 0.0, 0.0], 1), (202, [float("nan")] * 4, 1), (203, [float("-inf")] * 4, 1), (204, [1.0, 2.0], 1), (205, [], 1)]
    df = spark.createDataFrame(good + odd, VECTORS).withColumn("row", F.lit("clash")).withColumn("entry", F.lit("clash"))
    assert by_text(codes.coded(df).collect()) == by_text(coded_by_hand(good))
    none = codes.coded(df.limit(0))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    huge = spark.createDataFrame([(1, [1e30, -1e30, 0.0], 1), (2, [-1e30, 1e30, 0.0], 1)], VECTORS)
    assert [(r.code, r.error) for r in codes.coded(huge).orderBy("vec_id").collect()] == [("00000000", 0), ("01010000", 0)]
