"""Secret scan: patterns, and a battery of randomness tests with false-discovery control (operator 9)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .spans import let, matches

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Greedy runs, so asking for the least length in the pattern drops the same matches as checking it afterwards.
ACCESS, HEX = r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12

#: What may be a key: at least 16 characters of a key alphabet, bare or after an equals sign; padding stands at the end only.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?(?![A-Za-z0-9+/_-])"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets a key may be written in, in the order tried. Plain numbers are none: they are dates, cards and counters.
ENCODINGS = (
    ("hex", "^[0-9a-f]*[a-f][0-9a-f]*$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]*[A-F][0-9A-F]*$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]*[A-Z][A-Z2-7]*=*$", UPPER + "234567"),
    ("base36", "^[0-9a-z]*[a-z][0-9a-z]*$", DIGITS + LOWER),
    ("BASE36", "^[0-9A-Z]*[A-Z][0-9A-Z]*$", DIGITS + UPPER),
    ("base64", "^[A-Za-z0-9+/]*[A-Za-z][A-Za-z0-9+/]*={0,2}$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]*[A-Za-z][A-Za-z0-9_-]*={0,2}$", UPPER + LOWER + DIGITS + "-_"),
)
#: A random key fails one of the three tests with about this chance; share of false discoveries among those found.
ALPHA, FDR = 0.003, 0.01
#: Ordinary words and identifiers: the chance that two letters are equal, that three are, and that neighbours differ in class (digit, small, capital, sign).
EQUAL, EQUAL3, SWITCH = 0.065, 0.0056, 0.12
#: Sum of the battery's three scores under the text model has at most this variance: correlations of one half.
SPREAD = 6.0
#: Bins of a round of the false-discovery cut.
BINS = 1024


def _tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, never too small above z = 0: by Sampford's bound, within 1 % above z = 0.8 and 13 % at 0."""

    def bound(x: Column) -> Column:
        return F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * 4 / (3 * x + F.sqrt(x * x + 8))

    return let(z, lambda z: F.when(z >= 0, bound(F.least(z, F.lit(37.0)))).otherwise(1 - bound(F.least(-z, F.lit(37.0)))))


def _pairs_sum(xs: Column, f) -> Column:
    """Sum of f over neighbours of an array."""
    n = F.size(xs)
    return F.aggregate(F.zip_with(F.slice(xs, 1, F.greatest(n - 1, F.lit(0))), F.slice(xs, 2, F.greatest(n - 1, F.lit(0))), f), F.lit(0.0), lambda a, x: a + x.cast("double"))


def battery(token: Column) -> Column:
    """``(encoding, p_random, p_text)`` of a token; encoding null: none fits, and it is no candidate.

    Three statistics over the n characters of the inferred encoding's alphabet of a symbols: equal pairs c, of which
    chi-squared is a linear function (a / n (2 c + n) - n); runs of one character class; and the mean step between
    neighbours' places in the alphabet, for serial correlation. ``p_random``: the smallest of their p-values under uniform
    draws, each toward what text has (more equal pairs, fewer runs, shorter steps), times three. ``p_text``: one p-value under the text model (``EQUAL``, ``EQUAL3``, ``SWITCH``) from the sum of the three
    scores: fewer equal pairs, more runs and longer steps than text has. All scores grow with length, so a short
    token needs a stronger pattern. Under uniform draws equal pairs are Poisson-like, also where cells are sparse.
    """
    body = F.regexp_replace(token, "=+$", "")
    name, alphabet, p_same = F.lit(None).cast("string"), F.lit(""), F.lit(0.0)
    for kind, pattern, letters in reversed(ENCODINGS):
        fits = token.rlike(pattern)
        same = sum((sum(c in group for c in letters) / len(letters)) ** 2 for group in (DIGITS, LOWER, UPPER, "+/-_"))
        name, alphabet, p_same = F.when(fits, kind).otherwise(name), F.when(fits, letters).otherwise(alphabet), F.when(fits, same).otherwise(p_same)

    def tests(v: Column) -> Column:
        n, a = F.length(v["body"]).cast("double"), F.length(v["alphabet"]).cast("double")
        squares = F.aggregate(F.array_distinct(v["chars"]), F.lit(0.0), lambda s, c: s + F.pow(n - F.length(F.replace(v["body"], c, F.lit(""))), F.lit(2.0)))
        switches = _pairs_sum(v["class"], lambda x, y: (x != y).cast("int"))
        step = _pairs_sum(v["at"], lambda x, y: F.abs(x - y)) / a / (n - 1)
        return F.struct(v["name"].alias("encoding"), n.alias("n"), a.alias("a"), (n * (n - 1) / 2).alias("pairs"), ((squares - n) / 2).alias("c"), switches.alias("w"), step.alias("step"), (1 - v["p_same"]).alias("s"))

    def scores(v: Column) -> Column:
        n, a, c, w, s, few = v["n"], v["a"], v["c"], v["w"], v["s"], v["n"] - 1
        mean = v["pairs"] / a
        # P(Poisson(mean) >= c) by the cube-root rule for its gamma form
        z_equal = F.when(c < 0.5, F.lit(-37.0)).otherwise(-3 * F.sqrt(c) * (F.pow(mean / c, F.lit(1 / 3)) - 1 + 1 / (9 * c)))
        z_runs = (s * few - w - 0.5) / F.sqrt(few * s * (1 - s))
        z_step = ((a * a - 1) / (3 * a * a) - v["step"]) / F.sqrt((1 / 18 + 1 / 90) / few)
        p_random = F.least(F.lit(1.0), 3 * F.least(_tail(z_equal), _tail(z_runs), _tail(z_step)))
        t_equal = (v["pairs"] * EQUAL - c - 0.5) / F.sqrt(v["pairs"] * EQUAL * (1 - EQUAL) + n * few * (n - 2) * (EQUAL3 - EQUAL**2))
        t_runs = (w - 0.5 - SWITCH * few) / F.sqrt(SWITCH * (1 - SWITCH) * few)
        usual = F.least((1 - SWITCH) * 26 / (3 * a) + SWITCH / 2, (a * a - 1) / (3 * a * a))
        t_step = (v["step"] - usual) / F.sqrt((1 / 18 + 1 / 90) / few)
        return F.struct(v["encoding"].alias("encoding"), p_random.alias("p_random"), _tail((t_equal + t_runs + t_step) / math.sqrt(SPREAD)).alias("p_text"))

    def spelled(v: Column) -> Column:
        chars = F.split(v["body"], "")
        at = F.transform(chars, lambda c: (F.instr(v["alphabet"], c) - 1).cast("double"))
        order = lambda c: F.instr(F.lit(DIGITS + LOWER + UPPER + "+/-_"), c)
        kind = F.transform(chars, lambda c: let(order(c), lambda k: F.when(k <= 10, 0).when(k <= 36, 1).when(k <= 62, 2).otherwise(3)))
        given = F.struct(v["name"].alias("name"), v["alphabet"].alias("alphabet"), v["body"].alias("body"), v["p_same"].alias("p_same"), chars.alias("chars"), at.alias("at"), kind.alias("class"))
        return let(given, lambda g: let(tests(g), scores))

    none = F.struct(F.lit(None).cast("string").alias("encoding"), F.lit(0.0).alias("p_random"), F.lit(1.0).alias("p_text"))
    return let(F.struct(name.alias("name"), alphabet.alias("alphabet"), p_same.alias("p_same"), body.alias("body")), lambda v: F.when(v["name"].isNull(), none).otherwise(spelled(v)))


def discovery_cut(p: DataFrame, fdr: float) -> float:
    """The largest p-value of ``p(p)`` that Benjamini-Hochberg's step-up rule accepts at ``fdr``; -1 where it accepts none.

    Exact without a sort: p-values are counted in BINS bins of their logarithm, and a bin in which the rule may be met
    before its end is counted again in finer bins. ``BINS`` rows of a round come to the driver.
    """
    total = p.count()
    lg = F.log(F.greatest(F.col("p"), F.lit(1e-300)))

    def search(rows: DataFrame, low: float, high: float, before: int) -> float:
        bin_ = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((lg - low) / (high - low) * BINS))).cast("int")
        bins = rows.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("p").alias("least"), F.max("p").alias("most")).orderBy("bin").collect()
        upto = before + sum(r["n"] for r in bins)
        for r in reversed(bins):
            if r["most"] <= fdr * upto / total:
                return r["most"]
            if r["least"] < r["most"] and r["least"] <= fdr * upto / total:
                inside = rows.where((F.col("p") >= r["least"]) & (F.col("p") <= r["most"]))
                found = search(inside, math.log(max(r["least"], 1e-300)), math.log(r["most"]), upto - r["n"])
                if found >= 0:
                    return found
            upto -= r["n"]
        return -1.0

    return search(p, math.log(1e-300), 1e-9, 0) if total else -1.0


def scan(docs: DataFrame, keep: list[str], text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """``keep`` columns, ``base`` and ``added``: arrays of ``(start, rank, end, kind)`` by start, for each row of ``docs``.

    Base spans come from three patterns. A bare token is added where the battery takes it for random (``ALPHA``) and the
    corpus' false-discovery cut on the battery's p-value under text (Benjamini-Hochberg over all candidates of all
    documents) takes it for no text. Tokens that overlap a base span are not added. Null and empty texts have no spans.
    Very long texts are scanned whole. Repeated rows are scanned each, and their candidates count each. An empty table
    gives an empty result. Columns of ``keep`` named ``base`` or ``added`` are replaced. Only counts come to the driver.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keep = [c for c in keep if c not in ("base", "added")]

    def spans(found: Column, rank: int, kind: str) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))

    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["part"]) >= ASSIGN_LEAST)
    base = F.array_sort(F.concat(spans(assign, 0, "assign"), spans(matches(text, ACCESS), 1, "access"), spans(matches(text, HEX), 2, "hex")))
    tried = F.transform(matches(text, CANDIDATE), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), battery(m["text"]).alias("t")))
    rows = docs.select(*[F.col(c).alias(f"_in{i}") for i, c in enumerate(keep)], base.alias("base"), tried.alias("tried"))
    free = F.filter("tried", lambda c: c["t"]["encoding"].isNotNull() & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    rows = cut(rows.withColumn("tried", free))
    least = discovery_cut(rows.select(F.explode("tried").alias("c")).select(F.col("c.t.p_text").alias("p")), fdr)
    added = F.transform(F.filter("tried", lambda c: (c["t"]["p_random"] >= ALPHA) & (c["t"]["p_text"] <= least)), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("rank"), c["end"].alias("end"), F.lit("random").alias("kind")))
    return rows.select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(keep)], "base", F.array_sort(added).alias("added"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all ``documents``; edge cases as in ``scan``."""
    found = scan(table(spark, sf_dir, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.array_sort(F.concat("base", "added"))).alias("spans"))
