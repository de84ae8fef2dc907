"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text (operator 4)."""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import defaultdict
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table

#: Letters of other scripts that look like Latin ones, and digits or signs put for letters.
LOOKALIKES = dict(zip("авеёзкмнорстухіїјѕԁԛԝһαβγεικνορτυχωӏ", "abeeskmhopctyxiijsdqwhabyeikvoptuxwl", strict=True))
DIGITS = dict(zip("013457@$", "oieastas", strict=True))

#: Insults that count before any label is seen; labels may raise, lower or drop them.
SEED = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "imbecile", "bastard")
SEED_WEIGHT = 3.0

#: Phrases in which a lexicon word says nothing bad.
EXCEPTIONS = ("trash can", "trash bin", "taking out the trash", "class clown", "clown fish", "circus clown")

#: Bound of a fit: labelled rows read. Its entries are as many as their words at most.
FIT_ROWS = 40_000
#: Least likelihood-ratio statistic of an entry (chance level about 1e-6) and least log odds, and prefix lengths tried beside whole words.
MIN_G, MIN_WEIGHT, PREFIXES = 24.0, 2.0, range(4, 8)


def _fold_table() -> dict[int, str]:
    """By rule: compatibility forms and accents go to plain letters, anything that is no letter to a space."""
    out: dict[int, str] = {}
    for lo, hi in ((0x00, 0x250), (0x1E00, 0x1F00), (0x2000, 0x2070), (0x2100, 0x2150), (0x3000, 0x3020), (0xFF01, 0xFF5F), (0x1D400, 0x1D800)):
        for cp in range(lo, hi):
            plain = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c)).lower()
            plain = "".join(DIGITS.get(c, c if c.isalpha() else " ") for c in plain)
            if plain != chr(cp):
                out[cp] = plain or " "
    out |= {cp: "" for cp in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)} | {cp: "" for cp in range(0x300, 0x370)}
    out |= {ord(k): v for k, v in LOOKALIKES.items()} | {ord("ß"): "ss"}
    return out


FOLD = _fold_table()


def fold(text: str | None) -> str:
    """Lower-case letters between single separators' spaces; homoglyphs, accents and letter-like digits replaced."""
    return f" {(text or '').lower().translate(FOLD)} "


@dataclass
class Lexicon:
    """``weights``: folded word (``' word '``) or word beginning (``' wor'``) to weight; ``coef``: of the length-normalised sums."""

    weights: dict[str, float] = field(default_factory=lambda: {f" {w} ": SEED_WEIGHT for w in SEED})
    exceptions: tuple[str, ...] = EXCEPTIONS
    coef: tuple[float, float, float] = (-4.0, 2.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(p := " ".join(["", *fold(phrase).split(), ""]), (len(p), None))
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        if len(found):
            found.make_automaton()
        return found


def features(folded: str, automaton: ahocorasick.Automaton) -> tuple[float, float, int]:
    """Sum of weights, the same per 1000 characters, and hits.

    Each different word counts once, with its heaviest entry, and not where it stands inside an exception phrase.
    """
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    if len(automaton):
        for end, (n, weight) in automaton.iter(folded):
            start = end - n + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
    if spared:
        # one sweep: the furthest end of the phrases that start at or before a hit
        spared.sort()
        kept, k, reach = {}, 0, -1
        for s in sorted(best):
            while k < len(spared) and spared[k][0] <= s:
                reach, k = max(reach, spared[k][1]), k + 1
            if s >= reach:
                kept[s] = best[s]
        best = kept
    by_word = {folded[s + 1 : folded.find(" ", s + 1)]: w for s, w in sorted(best.items(), key=lambda x: x[1])}
    total = sum(by_word.values())
    return total, 1000 * total / (len(folded) + 200), len(best)


def inputs(total: float, rate: float) -> tuple[float, float]:
    return math.log1p(total), math.log1p(rate)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the first coefficient is the intercept."""
    x = np.c_[np.ones(len(x)), x]
    w, penalty = np.zeros(x.shape[1]), ridge * len(x) ** 0.5 * np.array([0.0, 1.0, 1.0])
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (y - p) - penalty * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _shingles(text: str | None) -> set[int]:
    words = (text or "").lower().split()
    return {zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))}


def without_copies(rows: DataFrame) -> DataFrame:
    """``rows(text, toxic)`` of a fit's sample without near copies of the same label.

    Rows that share the least hash of their five-word shingles are held against the first of them by text digest, and
    go only where their shingles have a Jaccard similarity of 0.8 or more. The order of rows does not matter.
    """

    def sketched(batches):
        for b in batches:
            yield b.append_column("sketch", pa.array([min(_shingles(t)) for t in b.column("text").to_pylist()], pa.int64()))

    known = cut(rows.select("text", "toxic").mapInArrow(sketched, "text string, toxic int, sketch long").withColumn("digest", F.md5(F.coalesce("text", F.lit("")))))
    first = known.groupBy("sketch", "toxic").agg(F.min(F.struct("digest", "text")).alias("first"))
    known = known.dropDuplicates(["sketch", "toxic", "digest"]).join(first, ["sketch", "toxic"])
    known = known.select("text", "toxic", F.when(F.col("digest") != F.col("first.digest"), F.col("first.text")).alias("other"))

    def kept(batches):
        for b in batches:
            keep = []
            for t, other in zip(b.column("text").to_pylist(), b.column("other").to_pylist()):
                s, o = (_shingles(t), _shingles(other)) if other is not None else ({0}, set())
                keep.append(len(s & o) < 0.8 * len(s | o))
            yield b.select(["text", "toxic"]).filter(pa.array(keep, pa.bool_()))

    return known.mapInArrow(kept, "text string, toxic int")


def closest(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Entry to weight, from entry to (weight, toxic texts): leaves out a beginning where a longer entry covers its toxic texts with higher odds."""
    longer: dict[str, list[tuple[float, int]]] = defaultdict(list)
    for entry, value in found.items():
        for n in range(min(PREFIXES) + 1, len(entry)):
            longer[entry[:n]].append(value)
    return {e: w for e, (w, a) in found.items() if e.endswith(" ") or not any(v > w + 0.2 and n >= 0.8 * a for v, n in longer[e])}


def fit(labelled: DataFrame) -> Lexicon:
    """Learns entries, weights and the scale from ``labelled(text, toxic)``, a bounded sample (see ``training_rows``).

    Presence of each word and word beginning is counted by class; one row stands for each group of near copies, so a
    text that was copied a thousand times does not make its words toxic. Every entry with a likelihood-ratio statistic of
    ``MIN_G`` toward toxic is taken. Where one class is missing, the seed lexicon and its scale stay. The result does not
    depend on the order of rows. Rows without a label teach nothing; null and empty texts count as texts without words.
    """
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null")
    rows = cut(without_copies(rows))

    def counted(batches):
        seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])

        def flush():
            out = pa.RecordBatch.from_pydict({"entry": list(seen), "toxic": [v[1] for v in seen.values()], "clean": [v[0] for v in seen.values()]}, schema=pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())]))
            seen.clear()
            return out

        for b in batches:
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                found = set()
                for w in set(fold(text).split()):
                    found.add(f" {w} ")
                    found.update(" " + w[:n] for n in PREFIXES if n < len(w))
                for entry in found:
                    seen[entry][1 if toxic else 0] += 1
                if len(seen) > 500_000:
                    yield flush()
        if seen:
            yield flush()

    n1, n0 = rows.agg(F.coalesce(F.sum(F.when(F.col("toxic") > 0, 1)), F.lit(0)), F.coalesce(F.sum(F.when(F.col("toxic") <= 0, 1)), F.lit(0))).first()
    if not n1 or not n0:
        return Lexicon()
    counts = rows.select("text", "toxic").mapInArrow(counted, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b, n = F.col("a").cast("double"), F.col("b").cast("double"), F.lit(float(n1 + n0))
    term = lambda x, share: F.when(x > 0, x * F.log(x / ((F.col("a") + F.col("b")) * share))).otherwise(0.0)
    g = 2 * (term(a, F.lit(float(n1)) / n) + term(b, F.lit(float(n0)) / n))
    weight = F.log((a + 0.5) / (n1 + 1.0)) - F.log((b + 0.5) / (n0 + 1.0))
    learned = counts.select("entry", "a", "b", g.alias("g"), weight.alias("weight")).where(F.col("a") + F.col("b") >= 3)
    strong = learned.where((F.col("g") >= MIN_G) & (F.col("weight") >= MIN_WEIGHT)).collect()  # words of FIT_ROWS rows at most
    seeds = {r["entry"]: r for r in learned.where(F.col("entry").isin([f" {w} " for w in SEED])).collect()}
    weights = {f" {w} ": SEED_WEIGHT for w in SEED}
    weights = {k: v for k, v in weights.items() if k not in seeds or seeds[k]["a"] + seeds[k]["b"] < 8 or seeds[k]["weight"] >= MIN_WEIGHT}
    weights |= closest({r["entry"]: (float(r["weight"]), int(r["a"])) for r in strong})
    model = Lexicon(weights)

    def measured(batches):
        automaton = model.automaton()
        for b in batches:
            found = [inputs(*features(fold(t), automaton)[:2]) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"x1": [f[0] for f in found], "x2": [f[1] for f in found], "toxic": b.column("toxic")}, schema=pa.schema([("x1", pa.float64()), ("x2", pa.float64()), ("toxic", pa.int32())]))

    # FIT_ROWS rows of three numbers at most come to the driver, for a regression with three coefficients
    sample = rows.select("text", "toxic").mapInArrow(measured, "x1 double, x2 double, toxic int").toArrow()
    sample = sample.sort_by([("x1", "ascending"), ("x2", "ascending"), ("toxic", "ascending")])
    x = np.c_[sample["x1"].to_numpy(), sample["x2"].to_numpy()]
    # pseudo-rows keep the scale finite and the empty sum clean, however small the sample
    x, y = np.r_[x, [[0.0, 0.0]] * 4, [[math.log1p(9.0), math.log1p(9.0)]] * 2], np.r_[(sample["toxic"].to_numpy() > 0).astype(float), [0.0] * 4, [1.0] * 2]
    model.coef = tuple(float(v) for v in logistic(x, y))
    return model


def score(docs: DataFrame, model: Lexicon, text_col: str = "text") -> DataFrame:
    """Adds ``tox_score`` (0 to 1) and ``tox_hits`` to each row; null and empty texts score as texts without hits.

    Very long texts are matched whole, and repeated rows are scored each. An empty table gives an empty result. The
    lexicon, whose size ``FIT_ROWS`` bounds, goes to the executors with the task. Columns named like the added ones are
    replaced; all others are kept as they are.
    """
    keep = [c for c in docs.columns if c not in ("tox_score", "tox_hits")]
    docs = docs.select(*keep)

    def scored(batches):
        automaton, (c0, c1, c2) = model.automaton(), model.coef
        for b in batches:
            out, hits = [], []
            for t in b.column(text_col).to_pylist():
                total, rate, n = features(fold(t), automaton)
                x1, x2 = inputs(total, rate)
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, c0 + c1 * x1 + c2 * x2)))))
                hits.append(n)
            yield b.append_column("tox_score", pa.array(out, pa.float64())).append_column("tox_hits", pa.array(hits, pa.int32()))

    schema = T.StructType([*docs.schema.fields, T.StructField("tox_score", T.DoubleType()), T.StructField("tox_hits", T.IntegerType())])
    return docs.mapInArrow(scored, schema)


def fold_number(id_col: str, n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Labelled texts outside the held-out fifth: ``fit_rows`` labels in hash order, the highest label of an id."""
    marks = labels.where("doc_id is not null and toxic is not null").where(fold_number("doc_id", 5) != 0).select("doc_id", "toxic")
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "toxic")  # at most FIT_ROWS rows


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``, learning from labels outside the held-out fifth; edge cases as in ``score``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(training_rows(docs, table(spark, sf_dir, "labels")))
    out = score(docs, model)
    return out.select("doc_id", (fold_number("doc_id", 5) == 0).alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.5).cast("int").alias("predicted"), F.col("tox_hits").alias("hits"))
