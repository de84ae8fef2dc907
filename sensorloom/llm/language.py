"""Language identification by rank-order n-gram profiles (operator 2)."""

from __future__ import annotations

import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import first_rows, table

#: Letters in an n-gram (1 to ORDER), and n-grams in a profile; one that a profile lacks counts as PROFILE places off.
ORDER, PROFILE = 3, 300
#: Characters worked on at once, and different n-grams that a task holds of all languages before it hands them on.
CHUNK, HELD = 1 << 20, 400_000
UNKNOWN = "und"

#: What stands between words, as one edge mark.
EDGE = "_"
#: Whether each code point is a letter. A table, as a pattern of the gaps (numerals and signs count as word characters to ``re``) is searched through per letter.
_LETTER = np.fromiter(map(str.isalpha, map(chr, range(sys.maxunicode + 1))), bool)


def ngrams(text: str | None) -> np.ndarray:
    """All n-grams of a text's words with their edges marked, but for the mark alone; each n-gram is its letters in 21 bits each."""
    spelled = EDGE + (text or "").lower() + EDGE
    a = np.frombuffer(spelled.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _LETTER[a]
    first = np.append(True, letter[:-1]) | letter  # of each gap its first character
    a, letter = a[first], letter[first]
    a[~letter] = ord(EDGE)
    pairs = a[:-1] << 21 | a[1:]
    triples = (pairs[:-1] << 21 | a[2:])[letter[1:-1]]
    return np.concatenate([a[letter], pairs, triples])


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of a text in order, and how often each occurs. A very long text is counted in parts cut at white space."""
    if text is None or len(text) <= CHUNK:
        return np.unique(ngrams(text), return_counts=True)
    parts, at = [], 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and not text[end].isspace() and end < at + 2 * CHUNK:
            end += 1
        parts.append(np.unique(ngrams(text[at:end]), return_counts=True))
        at = end
    return summed(parts)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def spell(gram: int) -> str:
    """The letters of an n-gram."""
    return "".join(chr(gram >> s & 0x1FFFFF) for s in (42, 21, 0) if gram >> s)


def learn(rows: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """Language to its most frequent n-grams in order (ties by n-gram), from all of ``rows(text, lang)``.

    Tasks count, Spark sums, and only ``profile`` n-grams of each language come to the driver. Rows without a language
    or letters teach nothing.
    """
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        seen: dict[str, list] = defaultdict(list)

        def flush():
            for lang, parts in seen.items():
                keys, n = summed(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys), pa.array(n)], schema=schema)
            seen.clear()

        size = 0
        for b in batches:
            texts: dict[str, list[str]] = defaultdict(list)
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                texts[lang].append(text)
            for lang, some in texts.items():
                seen[lang].append(counted("\n".join(some)))
                if len(seen[lang]) > 8:
                    seen[lang] = [summed(seen[lang])]
            size = sum(len(p[0]) for parts in seen.values() for p in parts)
            if size > HELD:
                yield from flush()
        yield from flush()

    counts = rows.where("lang is not null and text is not null").select("text", "lang").mapInArrow(run, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = first_rows(counts, ["lang"], [F.desc("n"), F.asc("gram")], profile).collect()
    found: dict[str, list] = defaultdict(list)
    for r in best:
        found[r["lang"]].append((-r["n"], r["gram"]))
    return {lang: [g for _, g in sorted(v)] for lang, v in sorted(found.items())}


class Classifier:
    """Compares a text's most frequent n-grams (ties by n-gram) with each profile."""

    def __init__(self, profiles: dict[str, list[int]], profile: int = PROFILE):
        self.langs, self.size = list(profiles), profile
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.places = np.full((len(self.grams) + 1, len(self.langs)), profile, np.int64)
        for k, p in enumerate(profiles.values()):
            self.places[np.searchsorted(self.grams, p), k] = np.arange(len(p))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the least out-of-place distance, and how far the second best is behind it, 0 to 1."""
        grams, n = counted(text)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        top = grams[np.argsort(-n, kind="stable")[: self.size]]
        at = np.searchsorted(self.grams, top)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != top] = len(self.grams)
        places = self.places[at]
        off = np.where(places == self.size, self.size, np.abs(places - np.arange(len(top))[:, None])).sum(axis=0)
        best = int(off.argmin())
        if len(self.langs) == 1:
            return self.langs[0], 1.0
        second = np.delete(off, best).min()
        return self.langs[best], float((second - off[best]) / second) if second else 0.0


def identify(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``lang_score`` to each row, from the whole text and nothing else.

    Null texts and texts without letters (signs, digits, fractions, numerals) are ``und`` with score 0, and so is every
    text where nothing was learned. Equal distances: the first language by name, with score 0. Very long texts are
    counted in parts. Repeated rows are predicted each. An empty table gives an empty result. Columns named like the
    added ones are replaced, all others kept.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "lang_score")])

    def run(batches):
        classifier = Classifier(profiles)
        for b in batches:
            found = [classifier.predict(t) for t in b.column(text_col).to_pylist()]
            yield b.append_column("lang_pred", pa.array([f[0] for f in found], pa.string())).append_column("lang_score", pa.array([f[1] for f in found], pa.float64()))

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all ``documents`` by profiles of those outside the held-out quarter; edge cases as in ``identify``."""
    docs = table(spark, sf_dir, "documents")
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    profiles = learn(docs.where(~out).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
