"""Benchmark decontamination: BM25 index of test items, block-max WAND over every passage, overlap check (operator 5)."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import cut, table

K1, B = 1.2, 0.75
#: Least share of an item's own BM25 score that retrieves it, and of its shingles that proves it.
THETA, OVERLAP, SHINGLE = 0.6, 0.8, 5
#: Share of an item's score in its essential terms: a passage that retrieves it holds THETA + ESSENTIAL - 1 of the score in them.
ESSENTIAL = 0.8
#: Postings in a block, and bytes of item text indexed at a time.
BLOCK, ITEM_BYTES = 64, 16 << 20
#: Items are dealt to classes by length, each of which holds up to this many times the words of the one before: passages fit their
#: items. The first class holds all below GROWTH ** FIRST words, so that short items do not make passages short.
GROWTH, FIRST = 4, 3

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


class Postings:
    """One term's items in ascending order with impacts, and the largest impact of each block and of the list."""

    __slots__ = ("items", "impacts", "blocks", "top")

    def __init__(self, items: list[int], impacts: list[float]):
        self.items, self.impacts = items, impacts
        self.blocks = [(items[min(i + BLOCK, len(items)) - 1], max(impacts[i : i + BLOCK])) for i in range(0, len(items), BLOCK)]
        self.top = max(impacts)


class LengthClass:
    """Inverted index of test items of like length; impacts are shares of an item's own score, so one threshold serves all items."""

    #: Whether passages that the essential terms rule out are left unsearched; the results are the same.
    gate = True

    def __init__(self, items: list[tuple], longest: int, df: dict[str, int], count: int, mean: float, theta: float):
        """``items``: (id, question words, answer words), ``longest`` words at most; ``df``, ``count`` and ``mean`` length are those of all items."""
        self.ids, self.theta = [i for i, _, _ in items], theta
        self.parts = [[s for s in (shingles(q), shingles(a)) if s] for _, q, a in items]
        bags = [Counter(q + a) for _, q, a in items]
        self.longest = longest
        postings: dict[str, tuple[list[int], list[float]]] = defaultdict(lambda: ([], []))
        self.selfs, self.needed = [], []
        self.essential: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for k, bag in enumerate(bags):
            n = sum(bag.values())
            impact = {t: math.log(1 + (count - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * n / mean)) for t, f in bag.items()}
            whole = sum(impact.values())
            self.selfs.append(whole)
            left = 1.0
            for t, v in sorted(impact.items(), key=lambda x: (-x[1], -len(x[0]), x[0])):
                if left > 1 - ESSENTIAL:
                    self.essential[t].append((k, v / whole))
                    left -= v / whole
                postings[t][0].append(k)
                postings[t][1].append(v / whole)
            self.needed.append(theta - left - 1e-9)
        self.lists = {t: Postings(*p) for t, p in postings.items()}

    def search(self, terms) -> list[tuple[int, float]]:
        """Block-max WAND: all items whose share of their own score is ``theta`` or more, with that share."""
        cursors = [[p.items[0], 0, p] for p in (self.lists.get(t) for t in terms) if p is not None]
        found, theta = [], self.theta - 1e-9
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[2].top
                if bound >= theta:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # the blocks in which the item would stand bound its score better than whole lists do
            bound, until = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
            for c in cursors[: pivot + 1]:
                blocks = c[2].blocks
                j = c[1] // BLOCK
                while j < len(blocks) and blocks[j][0] < item:
                    j += 1
                if j < len(blocks):
                    bound += blocks[j][1]
                    until = min(until, blocks[j][0] + 1)
            if bound < theta:
                target = max(item + 1, until) if until != math.inf else item + 1
            else:
                score = 0.0
                for c in cursors[: pivot + 1]:
                    at = bisect.bisect_left(c[2].items, item, c[1])
                    if at < len(c[2].items) and c[2].items[at] == item:
                        score += c[2].impacts[at]
                if score >= theta:
                    found.append((item, score))
                target = item + 1
            for c in cursors[: pivot + 1]:
                c[1] = bisect.bisect_left(c[2].items, target, c[1])
                c[0] = c[2].items[c[1]] if c[1] < len(c[2].items) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def matches(self, words: list[str], overlap: float) -> list[tuple]:
        """(item id, BM25 of the passage, overlap, first word of the passage) of the items that the words hold.

        Passages are windows of twice the longest item of the class, half overlapping, so any stretch as long as an item lies
        whole in one. A passage whose essential terms leave every item short of the threshold, whatever else it
        holds, is not searched.
        """
        essential, needed = self.essential, self.needed
        step, size = self.longest, 2 * self.longest
        last = max(0, -(-(len(words) - size) // step))
        held: dict[int, set[str]] = defaultdict(set)
        for at, w in enumerate(words):
            if w in essential:
                held[at // step].add(w)
        best: dict[int, tuple[float, float, int]] = {}
        for s in sorted({min(last, max(0, k - d)) for k in held for d in (0, 1)}) if self.gate else range(last + 1):
            sums: dict[int, float] = defaultdict(float)
            for w in held.get(s, set()) | held.get(s + 1, set()):
                for item, share in essential[w]:
                    sums[item] += share
            if self.gate and all(v < needed[item] for item, v in sums.items()):
                continue
            passage = words[s * step : s * step + size]
            hits = self.search(set(passage))
            if not hits:
                continue
            have = shingles(passage)
            text_words = None
            for item, share in hits:
                got = []
                for part in self.parts[item]:
                    if len(next(iter(part))) < SHINGLE:  # shorter than a shingle: its words in a row
                        text_words = text_words or f" {' '.join(passage)} "
                        got.append(float(f" {' '.join(next(iter(part)))} " in text_words))
                    else:
                        got.append(len(part & have) / len(part))
                if min(got) >= overlap - 1e-9 and (item not in best or min(got) > best[item][1]):
                    best[item] = (round(share * self.selfs[item], 9), min(got), s * step)
        return [(self.ids[i], *v) for i, v in best.items()]


class ItemIndex:
    """Items in classes of like length."""

    def __init__(self, items: list[tuple], df: dict[str, int], count: int, mean: float, theta: float = THETA):
        """``items``: (id, question words, answer words), in the order of ids."""
        dealt: dict[int, list[tuple]] = defaultdict(list)
        for i, q, a in items:
            if q or a:
                dealt[max(FIRST - 1, math.floor(math.log(len(q) + len(a), GROWTH) + 1e-9))].append((i, q, a))
        self.classes = [LengthClass(part, GROWTH ** (k + 1) - 1, df, count, mean, theta) for k, part in sorted(dealt.items())]

    def matches(self, text: str | None, overlap: float = OVERLAP) -> list[tuple]:
        """Items that ``text`` holds: (item id, BM25 of the passage, overlap, first word of the passage)."""
        words = words_of(text)
        return [m for c in self.classes for m in c.matches(words, overlap)] if words else []


def index_of(items: list[tuple], theta: float = THETA) -> ItemIndex:
    """An index of ``(id, question, answer)`` texts that are all items there are."""
    spelled = [(i, words_of(q), words_of(a)) for i, q, a in items]
    bags = [set(q + a) for _, q, a in spelled if q or a]
    df = Counter(t for b in bags for t in b)
    return ItemIndex(spelled, df, len(bags), sum(len(q) + len(a) for _, q, a in spelled) / max(1, len(bags)), theta)


def item_blocks(items: DataFrame, id_col: str, question_col: str, answer_col: str | None):
    """Yields indexes of at most about ``ITEM_BYTES`` of item text each, so a large test set is searched in blocks.

    Document frequencies, the number of items and their mean length are counted over all items by Spark first; a block
    gets the frequencies of its own words. So scores do not depend on the blocks.
    """
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    rows = items.select(F.col(id_col).alias("i"), F.col(question_col).cast("string").alias("q"), answer.cast("string").alias("a")).where("i is not null")

    def spelled(batches):
        for b in batches:
            q, a = ([words_of(t) for t in b.column(c).to_pylist()] for c in ("q", "a"))
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(q, pa.list_(pa.string())), pa.array(a, pa.list_(pa.string()))], names=["i", "q", "a"])

    listed = T.ArrayType(T.StringType())
    rows = rows.mapInArrow(spelled, T.StructType([rows.schema["i"], T.StructField("q", listed), T.StructField("a", listed)])).where("size(q) + size(a) > 0")
    rows = cut(rows.withColumn("number", F.xxhash64("i", "q", "a")))
    total, count, size = rows.agg(F.coalesce(F.sum(F.length(F.concat_ws(" ", "q", "a"))), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.size("q") + F.size("a")), F.lit(0))).first()
    n = max(1, -(-total // ITEM_BYTES))
    block = F.pmod("number", F.lit(n)).alias("block")
    terms = rows.select(block, F.explode(F.array_distinct(F.concat("q", "a"))).alias("t"))
    df = terms.groupBy("t").agg(F.count("*").alias("df"))
    for k in range(n) if count else ():
        own = {r["t"]: r["df"] for r in terms.where(F.col("block") == k).select("t").distinct().join(df, "t").collect()}
        found = [(r["i"], r["q"], r["a"]) for r in rows.where(block == k).orderBy("i", "number").collect()]
        if found:
            yield ItemIndex(found, own, count, size / count), n


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", question_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """A row per document and test item it holds: ``(id, item_id, bm25, overlap, word_start)``; ids keep their type.

    Retrieval: the item reaches ``THETA`` of its own BM25 score in a passage. Proof: ``OVERLAP`` of the five-word
    shingles of the question, and of the answer where there is one, are in the passage. Words are runs of letters and
    digits, case ignored. Null or empty texts and items hold nothing, and items with a null id are left out. Rows that
    repeat an item id are items each. Very long texts are searched whole. Rows that repeat a document id are searched
    each. An empty table gives an empty result. Items go to the executors in blocks of ``ITEM_BYTES``; of several, each
    one's result is written before the next is read, so that the driver holds one at a time.
    """
    out = None
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    facts = [T.StructField("bm25", T.DoubleType()), T.StructField("overlap", T.DoubleType()), T.StructField("word_start", T.LongType())]
    schema = T.StructType([texts.schema["id"], T.StructField("item_id", items.schema[item_id].dataType), *facts])
    arrow = to_arrow_schema(schema)
    for index, blocks in item_blocks(items, item_id, question_col, answer_col):

        def searched(batches, index=index):
            for b in batches:
                rows = [(i, *m) for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist()) for m in index.matches(t)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)], schema=arrow)

        part = texts.mapInArrow(searched, schema)
        part = part if blocks == 1 else cut(part)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", question_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """``docs`` without the rows that hold a test item (see ``find_leaks``); all columns and clean rows stay as they are."""
    for index, blocks in item_blocks(items, item_id, question_col, answer_col):

        def kept(batches, index=index):
            for b in batches:
                yield b.filter(pa.array([not index.matches(t) for t in b.column(text_col).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(kept, docs.schema)
        docs = docs if blocks == 1 else cut(docs)
    return docs


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of ``benchmark`` that all ``documents`` hold; edge cases as in ``find_leaks``."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
