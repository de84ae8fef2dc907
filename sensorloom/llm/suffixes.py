"""Removal of repeated byte windows by a depth-limited radix sort of suffixes (operator 11)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, discard, table

#: Bytes of a repeated window: suffixes are ordered through this depth.
LENGTH = 200
#: Parts into which a class of window offsets splits in each pass after the first.
FAN = 6
#: Bytes of text hashed at once, and the most of one text; longer texts go in overlapping pieces.
CHUNK = 1 << 18
#: Rows of a batch of contexts.
MOST_ROWS = 20_000
#: Low bits of a hash that hold a place in a chunk while the least hash of a window is sought.
PLACE = 20

_BASE = 0x9E3779B97F4A7C15
_ROOM = CHUNK + 8192


def _powers(base: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(_ROOM, base, np.uint64))


def anchors(data: bytes, ends: np.ndarray, length: int):
    """``(anchor, first, last, gram)`` of the windows of ``length`` bytes that start in ``data`` and end within their text.

    ``ends``: where each text of ``data`` ends, the texts being laid end to end. The anchor of a window is the leading
    digit of its suffix order: of its substrings of ``gram_length`` bytes that with the least hash, the leftmost of
    equals. So equal windows have equal grams at equal offsets. Windows ``first`` to ``last`` share an anchor.
    """
    k = gram_length(length)
    run = length - k + 1
    codes = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    if len(codes) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if not hasattr(anchors, "up"):
        anchors.up, anchors.down = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * anchors.up[: len(codes)], out=sums[1:])
    grams = (sums[k:] - sums[:-k]) * anchors.down[: len(codes) - k + 1]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    n = len(grams)
    least = (grams >> np.uint64(PLACE) << np.uint64(PLACE)) | np.arange(n, dtype=np.uint64)
    width = 1
    while width * 2 <= run:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < run:
        least = np.minimum(least[: n - run + 1], least[run - width :])
    at = (least & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    fits = np.ones(len(at), bool)
    for e in ends.tolist():
        fits[max(0, e - length + 1) : e] = False
    starts = np.flatnonzero(fits)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at = at[starts]
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[new], starts[new], starts[np.r_[new[1:] - 1, len(at) - 1]], grams[at[new]]


def gram_length(length: int) -> int:
    return max(1, length * 8 // 25)


def pieces(texts: list[bytes], length: int):
    """Chunks of texts laid end to end: ``(bytes, numbers of the texts, places in them, ends in the chunk)``."""
    held, size = [], 0
    for k, text in enumerate(texts):
        if len(text) < length:
            continue
        for lo in range(0, max(1, len(text) - length + 1), CHUNK - length):
            part = text[lo : lo + CHUNK - 1]
            if size + len(part) > CHUNK and held:
                yield held
                held, size = [], 0
            held.append((part, k, lo))
            size += len(part)
            if lo + len(part) >= len(text):
                break
    if held:
        yield held


def as_bytes(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def first_digits(length: int):
    """Of batches of ``(row, text)``: a row per anchor with its gram, the hash of all bytes of its windows, and its code."""

    def run(batches):
        for b in batches:
            rows, texts = b.column("row").to_numpy(), as_bytes(b.column("text"))
            for held in pieces(texts, length):
                data, ends = b"".join(p for p, _, _ in held), np.cumsum([len(p) for p, _, _ in held])
                at, first, last, gram = anchors(data, ends, length)
                if not len(at):
                    continue
                of = np.searchsorted(ends, at, side="right")
                begins = np.r_[0, ends[:-1]][of]
                lo, hi = at - last, at - first
                place = at - begins + np.array([x for _, _, x in held])[of]
                code = place << 24 | lo << 12 | hi
                digest = xxhash.xxh3_64_intdigest
                whole = np.array([digest(data[p : q + length], h) for p, q, h in zip(first.tolist(), last.tolist(), (lo << 12 | hi).tolist())], np.uint64)
                row = rows[np.array([k for _, k, _ in held])[of]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(row), pa.array(code)], names=["gram", "whole", "row", "code"]
                )

    return run


def contexts(length: int):
    """Of batches of ``(row, text, asked)``: the bytes of all windows of each asked anchor."""

    def run(batches):
        for b in batches:
            asked, texts = b.column("asked"), as_bytes(b.column("text"))
            sizes = np.diff(asked.offsets.to_numpy())
            flat = asked.flatten()
            codes, grams, text_of = flat.field("code").to_numpy(), flat.field("gram").to_numpy(), np.repeat(np.arange(b.num_rows), sizes)
            rows = b.column("row").to_numpy()[text_of]
            for k in range(0, len(codes), MOST_ROWS):
                now = slice(k, k + MOST_ROWS)
                code = codes[now]
                where = zip(text_of[now].tolist(), (code >> 24).tolist(), (code >> 12 & 4095).tolist(), (code & 4095).tolist())
                context = pa.array([texts[t][p - h : p - l + length] for t, p, l, h in where], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(rows[now]), pa.array(code), pa.array(grams[now]), context], names=["row", "code", "gram", "context"])

    return run


def next_digits(length: int):
    """Of batches of contexts: a row per part of the class of offsets [least, most].

    Windows with an offset (of the anchor in the window) in [l, h] share the bytes from l before the anchor to length - h
    after it: the hash of these is the digit. ``whole`` hashes all bytes of the anchor's own windows in that part.
    """

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            out = []
            columns = [b.column(c).to_pylist() for c in ("row", "code", "gram", "live", "context", "least", "most")]
            for row, code, gram, live, context, least, most in zip(*columns):
                lo, hi = code >> 12 & 4095, code & 4095
                step = -(-(most - least + 1) // FAN)
                for l in range(least, most + 1, step):
                    h = min(most, l + step - 1)
                    low, high = max(l, lo), min(h, hi)
                    if low > high:
                        continue
                    key = digest(context[hi - l : hi + length - h], l << 12 | h)
                    whole = digest(context[hi - high : hi + length - low], low << 12 | high)
                    out.append((gram, key - (1 << 63), whole - (1 << 63), row, code, l << 12 | h, live))
            if out:
                kinds = [pa.int64()] * 5 + [pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["gram", "key", "whole", "row", "code", "part", "live"])

    return run


def grouped(members: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """One pass over ``members(*keys, whole, row, code, part, live)``: ``(settled, going)``.

    Members of equal ``keys`` and ``whole`` repeat each other: they are settled. Where ``keys`` hold different ones, those
    not settled go on to the next digit, with one witness of each settled set. What is alone in its ``keys`` repeats nothing.
    """
    sets = members.groupBy(*keys, "whole").agg(F.count("*").alias("n"), F.max("live").alias("live"), F.min(F.struct("row", "code", "part")).alias("one"))
    sets = cut(sets)
    alone = F.col("live") & (F.col("n") == 1)
    mixed = cut(sets.groupBy(*keys).agg(F.count("*").alias("different"), F.max(alone).alias("open")).where("different > 1 and open").select(*keys))
    settled = members.where("live").join(sets.where("n > 1").select(*keys, "whole"), [*keys, "whole"]).select("row", "code", "part")
    going = sets.join(mixed, keys).select("gram", "one.*", alone.alias("live"))
    settled, going = cut(settled), cut(going)
    discard(sets, mixed)
    return settled, going


def freed(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes tables that are done with, and lets Spark's cleaner delete the shuffle files of finished jobs."""
    discard(*tables)
    spark._jvm.System.gc()


def repeated(texts: DataFrame, length: int) -> DataFrame:
    """``(row, first, last)``: starts of the windows of ``texts(row, text)`` that start anywhere else too, as ranges."""
    spark = texts.sparkSession
    full = length - gram_length(length)
    kinds = "gram long, whole long, row long, code long"
    suffixes = cut(texts.mapInArrow(first_digits(length), kinds))
    shared = cut(suffixes.groupBy("gram").count().where("count > 1").select("gram"))
    members = cut(suffixes.join(shared, "gram").withColumns({"part": F.lit(full), "live": F.lit(True)}))
    freed(spark, suffixes, shared)
    settled, going = grouped(members, ["gram"])
    freed(spark, members)
    found = [settled]
    asked = going.groupBy("row").agg(F.collect_list(F.struct("gram", "code")).alias("asked"))
    with_text = texts.join(asked.hint("shuffle_hash"), "row").select("row", "text", "asked")
    held = cut(with_text.mapInArrow(contexts(length), "row long, code long, gram long, context binary"))
    classes = going.select("row", "code", "live", F.lit(0).alias("least"), F.lit(full).alias("most"))
    width = full + 1
    while width > 1:
        width = -(-width // FAN)
        asked = held.join(classes, ["row", "code"]).select("row", "code", "gram", "live", "context", "least", "most")
        members = cut(asked.mapInArrow(next_digits(length), "gram long, key long, whole long, row long, code long, part int, live boolean"))
        freed(spark, going)
        settled, going = grouped(members, ["gram", "key"])
        found.append(settled)
        classes = going.select("row", "code", "live", F.shiftright("part", 12).alias("least"), F.col("part").bitwiseAND(4095).alias("most"))
        freed(spark, members)
    freed(spark, held, going)
    starts = None
    for s in found:
        place, lo, hi = F.shiftright("code", 24), F.shiftright("code", 12).bitwiseAND(4095), F.col("code").bitwiseAND(4095)
        low, high = F.greatest(lo, F.shiftright("part", 12)), F.least(hi, F.col("part").bitwiseAND(4095))
        s = s.select("row", (place - high).alias("first"), (place - low).alias("last"))
        starts = s if starts is None else starts.unionByName(s)
    return starts


def kept(length: int):
    """Of batches of texts with the ranges of their repeated windows: sizes, runs and the digest of what is left."""

    def run(batches):
        for b in batches:
            out = []
            for text, ranges in zip(as_bytes(b.column("text")), b.column("ranges").to_pylist()):
                left, at, removed, spans = hashlib.sha256(), 0, 0, 0
                for r in sorted((r["first"], r["last"] + length) for r in ranges or ()):
                    if r[0] > at or not spans:
                        left.update(text[at : r[0]])
                        spans, at = spans + 1, r[0]
                    removed, at = removed + max(0, r[1] - at), max(at, r[1])
                left.update(text[at:])
                out.append((len(text), removed, spans, left.hexdigest()))
            cols = [pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 3 + [pa.string()])] if out else [pa.array([], k) for k in [pa.int64()] * 3 + [pa.string()]]
            yield pa.RecordBatch.from_arrays([b.column("id"), *cols], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)``, a row per row of ``docs``; ids keep their type.

    Texts are UTF-8 bytes. Every byte goes that is covered by a window of ``length`` bytes which starts at another place
    too, of the same text or another; windows do not cross texts and are judged on the input.

    Suffixes are ordered by most significant digits through ``length`` bytes alone. The first digit of a window is its
    anchor's gram (see ``anchors``), so that windows which follow one another share one record and a text has a record
    per 60 bytes or so. Groups of one are dropped; members whose windows are all equal are settled; the others are split
    by classes of offsets, each with more bytes as its next digit, down to single windows, where equal groups are
    exactly the repeated windows. A pass is grouped counts and joins: a group of any size is counted before it is
    shuffled, and only one member of equal ones goes on.

    Null and empty texts have no bytes and lose none; those shorter than ``length`` lose none; very long texts are hashed in
    overlapping pieces. Repeated rows lose all windows. Rows with null or repeated ids are rows like others. An empty
    table gives an empty result. Other columns of ``docs`` are not read, whatever their names. Groups are told by 128 bits.
    """
    if not 2 <= length <= 4000:
        raise ValueError("windows have 2 to 4000 bytes")
    texts = cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id()))
    starts = repeated(texts.select("row", "text"), length)
    ranges = starts.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    whole = texts.join(ranges.hint("shuffle_hash"), "row", "left").select("id", "text", "ranges")
    added = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    out = whole.mapInArrow(kept(length), T.StructType([texts.schema["id"], *added, T.StructField("kept_sha256", T.StringType())]))
    return out.withColumnRenamed("id", id_col)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated windows of 200 bytes of all ``documents``; edge cases as in ``remove_repeats``."""
    return remove_repeats(table(spark, sf_dir, "documents"))
