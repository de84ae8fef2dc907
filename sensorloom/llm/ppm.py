"""Language-model scores by prediction by partial matching over bytes (operator 3)."""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_group, cut, partitions, table

#: Bytes of context.
ORDER = 6
#: No UTF-8 text holds these bytes: what stands before a text, and its end.
BEFORE, END = 0xFE, 0xFF
#: Bytes worked on at once, and bytes of text in a block.
CHUNK, BLOCK = 1 << 20, 32 << 20
#: Different grams that a task holds before it sums them or hands them on.
HELD_GRAMS = 4_000_000
#: Least number of parts that grams, and as many that tokens are dealt to; more as the input grows.
PARTS = 256
#: Bytes of text whose grams share a context in one part; a context of more is split by the byte before it.
LIMIT = 8_000_000
#: Most contexts of a length that are split: beyond, the limit grows with the input, so that the shared tables do not.
SPLITS = 1 << 15
#: A token no word can be: the end of a text.
END_TOKEN = b"\n"
#: Kinds of packed rows: counted grams, grams to score, tokens, texts.
COUNTED, ASKED, TOKENS, TEXTS = range(4)

META = np.dtype([("id", "<i8"), ("null", "u1"), ("held", "u1"), ("size", "<i8")])
#: ``part`` is a part of the grams or tokens, or the block in rows for a block; ``keys`` and ``vals`` are packed.
PACKED = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("vals", pa.binary())])
PACKED_DDL = "part long, kind int, block long, n long, keys binary, vals binary"


def mask(order: int) -> np.uint64:
    """Keeps a gram's last byte and ``order`` bytes before it."""
    return np.uint64((1 << 8 * (order + 1)) - 1)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of each text and each end with the ORDER bytes before it, as a number; and where each text starts."""
    pad = bytes([BEFORE]) * ORDER
    data = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8).astype(np.uint64)
    full = np.zeros(len(data), np.uint64)
    for k in range(ORDER + 1):
        full[ORDER:] |= data[ORDER - k : len(data) - k] << np.uint64(8 * k)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    real = np.ones(len(data), bool)
    starts = np.r_[0, np.cumsum(sizes + ORDER)[:-1]]
    for k in range(ORDER):
        real[starts + k] = False
    return full[real], np.r_[0, np.cumsum(sizes)[:-1]]


def chunks(texts: list[bytes]):
    """Runs of texts of about CHUNK bytes."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t) + ORDER + 1
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([f[1] for f in found]), len(keys)).astype(np.int64)


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted, by a sort: NumPy's own way without counts is a hash table, several times slower here."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def as_bytes(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def pack(data: bytes | np.ndarray) -> bytes:
    return pa.compress(data if isinstance(data, bytes) else data.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, kind=np.int64) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted grams as differences, which pack to a byte or two each."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, np.uint64), dtype=np.uint64)


def pack_tokens(tokens: list[bytes]) -> bytes:
    """No token holds a space. The length stands before them."""
    joined = b" ".join(tokens)
    return len(joined).to_bytes(8, "little") + pack(joined)


def unpack_tokens(data: bytes) -> list[bytes]:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True).split(b" ")


def pack_logs(logs: np.ndarray) -> bytes:
    """Many grams share a probability, so the different ones and the place of each; their number stands before them."""
    kinds, at = np.unique(logs, return_inverse=True)
    width = np.uint16 if len(kinds) <= 1 << 16 else np.uint32
    return len(kinds).to_bytes(8, "little") + pack(kinds.tobytes() + at.astype(width).tobytes())


def unpack_logs(data: bytes, n: int) -> np.ndarray:
    kinds = int.from_bytes(data[:8], "little")
    width = np.dtype(np.uint16 if kinds <= 1 << 16 else np.uint32)
    raw = pa.decompress(data[8:], decompressed_size=8 * kinds + width.itemsize * n, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.float64, kinds)[np.frombuffer(raw, width, n, 8 * kinds)]


def packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(PACKED)], schema=PACKED)


class Dealing:
    """Which part a gram goes to. A part has whole contexts of two bytes or, where a context is split, of more.

    ``splits``: length to the sorted contexts of that length which are split.
    """

    def __init__(self, splits: dict[int, np.ndarray], parts: int):
        self.splits, self.parts = splits, parts

    def by_part(self, keys: np.ndarray):
        """``(part, places)`` of sorted grams."""
        leaf = (keys >> np.uint64(8)) & mask(1)
        at = np.arange(len(keys)) if self.splits else np.empty(0, np.int64)
        for size, split in sorted(self.splits.items()):
            at = at[split[np.minimum(np.searchsorted(split, leaf[at]), len(split) - 1)] == leaf[at]]
            leaf[at] = (keys[at] >> np.uint64(8)) & mask(size)
        part = ((leaf * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(self.parts)
        part = part.astype(np.uint16 if self.parts <= 1 << 16 else np.uint32)
        order = np.argsort(part, kind="stable")
        found, starts = np.unique(part[order], return_index=True)
        yield from zip(found.tolist(), np.split(order, starts[1:]))

    def token_part(self, token: bytes) -> int:
        return self.parts + zlib.crc32(token) % self.parts


def count_grams(texts: DataFrame, dealing: Dealing) -> DataFrame:
    """Packed rows of the grams of ``texts(text)`` and their counts within a task; a gram can be in many rows."""

    def handed(keys, n):
        yield packed_rows([(part, COUNTED, 0, len(at), pack_keys(keys[at]), pack(n[at])) for part, at in dealing.by_part(keys)])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for part in chunks([as_bytes(t) for t in b.column("text").to_pylist()]):
                held.append(np.unique(grams(part)[0], return_counts=True))
                size += len(held[-1][0])
                if size > HELD_GRAMS:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > HELD_GRAMS * 3 // 4:
                        yield from handed(*held[0])
                        held, size = [], 0
        if held:
            yield from handed(*merged(held))

    return texts.select("text").mapInArrow(run, PACKED_DDL)


def followed(rows: DataFrame, size: int, split: np.ndarray | None = None) -> DataFrame:
    """``(symbol, key, n)`` of ``rows(text, learned)`` at bytes and ends that stand after one of the ``split`` contexts of ``size`` bytes.

    With ``symbol``: how often learned texts have each context with the byte after it. Without: how often all texts have
    it with the byte before it. Both have at most 256 keys a context, a number for each task.
    """
    def after_all(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among 65,536 pairs: context and byte, byte before and context."""
        pairs = data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]
        real = data[2:] != BEFORE  # no text holds that byte
        return pairs[1:][real], pairs[:-1][real]

    def after_split(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among 256 for each split context, by the byte after it and by the byte before it."""
        at = np.flatnonzero(ends[data[:-2].astype(np.uint16) << np.uint16(8) | data[1:-1]] & (data[2:] != BEFORE)) + 2
        context = np.zeros(len(at), np.uint64)
        for k in range(size):
            context |= data[at - k - 1].astype(np.uint64) << np.uint64(8 * k)
        place = np.minimum(np.searchsorted(split, context), len(split) - 1)
        same = split[place] == context
        place, at = place[same] * 256, at[same]
        return place + data[at], place + data[at - size - 1]

    def keys_of(symbol: bool, places: np.ndarray) -> np.ndarray:
        if split is None:
            return places.astype(np.int64)
        context, byte = split[places >> 8], (places & 255).astype(np.uint64)
        return (context << np.uint64(8) | byte if symbol else byte << np.uint64(8 * size) | context).astype(np.int64)

    if split is not None:
        ends = np.zeros(1 << 16, bool)
        ends[(split & mask(1)).astype(np.int64)] = True
    width = 1 << 16 if split is None else 256 * len(split)  # SPLITS bounds it
    pad = bytes([BEFORE]) * ORDER

    def run(batches):
        n = {True: np.zeros(width, np.int64), False: np.zeros(width, np.int64)}
        for b in batches:
            learned = b.column("learned").to_pylist()
            texts = [as_bytes(t) for t in b.column("text").to_pylist()]
            for flag in (True, False):
                for part in chunks([t for t, x in zip(texts, learned) if x == flag]):
                    data = np.frombuffer(b"".join(pad + t + bytes([END]) for t in part), np.uint8)
                    for symbol, places in zip((True, False), (after_all if split is None else after_split)(data)):
                        if symbol and not flag:
                            continue
                        if width <= CHUNK:
                            n[symbol] += np.bincount(places, minlength=width)
                        else:
                            places, times = np.unique(places, return_counts=True)
                            n[symbol][places] += times
        for symbol, times in n.items():
            places = np.flatnonzero(times)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), symbol)), pa.array(keys_of(symbol, places)), pa.array(times[places])], names=["symbol", "key", "n"])

    return rows.mapInArrow(run, "symbol boolean, key long, n long").groupBy("symbol", "key").agg(F.sum("n").alias("n"))


def counts_of(found: pa.Table, symbol: bool) -> tuple[np.ndarray, np.ndarray]:
    found = found.filter(pa.compute.equal(found["symbol"], symbol)).sort_by("key")
    return found["key"].to_numpy().astype(np.uint64), found["n"].to_numpy()


def dealt(rows: DataFrame, limit: int) -> tuple[Dealing, Trie]:
    """How the grams of ``rows(text, learned)`` are dealt, and the contexts that all parts share: those of one byte or
    none, and those that are split.

    A context of two bytes that stands in more than ``limit`` bytes of text is split by the byte before it, and so on up
    to ORDER bytes, after which few grams are left (256 a block). Split contexts alone are counted here, one pass for
    each of their lengths; at most SPLITS of a length, with 256 bytes that follow each, come to the driver.
    """
    found = followed(rows, 1).toArrow()
    low = counts_of(found, True)
    keys, n = counts_of(found, False)
    total = int(n.sum())
    limit = max(limit, total // SPLITS)
    tables = {0: merged([(low[0] & mask(0), low[1])]), 1: low}
    splits, hot = {}, keys[n > limit]
    for size in range(2, ORDER):
        if not len(hot):
            break
        splits[size] = hot
        found = followed(rows, size, hot).where(F.col("symbol") | (F.col("n") > limit)).toArrow()
        tables[size], (hot, _) = counts_of(found, True), counts_of(found, False)
    return Dealing(splits, max(PARTS, -(-4 * total // limit))), Trie(tables)


class Trie:
    """Byte contexts up to ORDER with symbol counts, laid out as sorted arrays by order.

    Method D escapes with exclusion. A context's symbols are among those of its shorter context, so what exclusion
    takes from the shorter one is fixed for each context and held here beside its totals.
    """

    def __init__(self, tables: dict[int, tuple[np.ndarray, np.ndarray]], under: Trie | None = None):
        """``tables``: order to the sorted (context, byte) numbers and their counts, each context with all its bytes.

        ``under``: contexts that are held elsewhere, with all shorter ones of theirs.
        """
        self.keys, self.n, self.contexts, self.total, self.kinds, self.shadow, self.under = {}, {}, {}, {}, {}, {}, under
        for k in range(ORDER + 1):
            keys, n = tables.get(k, (np.empty(0, np.uint64), np.empty(0, np.int64)))
            contexts, at, kinds = np.unique(keys >> np.uint64(8), return_inverse=True, return_counts=True)
            self.keys[k], self.n[k], self.contexts[k], self.kinds[k] = keys, n, contexts, kinds.astype(np.int64)
            self.total[k] = np.bincount(at, n, len(contexts)).astype(np.int64)
            self.shadow[k] = np.bincount(at, self.counts(k - 1, keys & mask(k - 1)), len(contexts)).astype(np.int64) if k else np.zeros(len(contexts), np.int64)

    @classmethod
    def of(cls, keys: np.ndarray, n: np.ndarray, under: Trie) -> Trie:
        """From sorted grams of a part, whose contexts are whole but for those that ``under`` holds."""
        tables = {ORDER: (keys, n)}
        for k in range(ORDER - 1, 1, -1):
            tables[k] = merged([(tables[k + 1][0] & mask(k), tables[k + 1][1])])
        for k in range(2, ORDER):
            own = ~cls._find(under.contexts[k], tables[k][0] >> np.uint64(8))[1]
            tables[k] = tables[k][0][own], tables[k][1][own]
        return cls(tables, under)

    @staticmethod
    def _find(where: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(where):
            return np.zeros(len(what), np.int64), np.zeros(len(what), bool)
        at = np.minimum(np.searchsorted(where, what), len(where) - 1)
        return at, where[at] == what

    def counts(self, k: int, keys: np.ndarray) -> np.ndarray:
        """How often each gram of order ``k`` was learned."""
        at, seen = self._find(self.keys[k], keys)
        out = np.zeros(len(keys), np.int64)
        out[seen] = self.n[k][at[seen]]
        if self.under is not None and len(self.under.keys[k]):
            out[~seen] = self.under.counts(k, keys[~seen])
        return out

    def about(self, k: int, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each context of ``k`` bytes: its total, its different bytes (0: never seen), and what exclusion takes from the shorter one."""
        at, seen = self._find(self.contexts[k], contexts)
        out = tuple(np.zeros(len(contexts), np.int64) for _ in range(3))
        for to, values in zip(out, (self.total[k], self.kinds[k], self.shadow[k])):
            to[seen] = values[at[seen]]
        if self.under is not None and len(self.under.contexts[k]):
            for to, values in zip(out, self.under.about(k, contexts[~seen])):
                to[~seen] = values
        return out

    def log10(self, full: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last byte after the others."""
        out = np.zeros(len(full))
        live = np.arange(len(full))
        gone, gone_kinds = np.zeros(len(full), np.int64), np.zeros(len(full), np.int64)
        for k in range(ORDER, -1, -1):
            key = full[live] & mask(k)
            total, kinds, shadow = self.about(k, key >> np.uint64(8))
            n, seen = self.counts(k, key), kinds > 0
            room, left = total - gone[live], kinds - gone_kinds[live]
            with np.errstate(divide="ignore", invalid="ignore"):
                out[live] += np.where(n > 0, np.log10((2 * n - 1) / (2 * room)), np.where(seen & (left > 0), np.log10(left / (2 * room)), 0.0))
            gone[live] = np.where(seen, shadow, gone[live])
            gone_kinds[live] = np.where(seen, kinds, gone_kinds[live])
            live = live[n == 0]
        out[live] -= np.log10(256 - gone_kinds[live])
        return out


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def blocks(docs: DataFrame) -> DataFrame:
    """A packed row per block of about BLOCK bytes of texts: the texts' ``META``, and the texts."""

    def run(batches):
        base, number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, count()
        rows, texts, size = [], [], 0

        def flush():
            block = base + next(number)
            return packed_rows([(block, TEXTS, block, len(rows), np.array(rows, META).tobytes(), pack(b"".join(texts)))])

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                texts.append(as_bytes(text))
                rows.append((doc_id or 0, doc_id is None, held_out(doc_id), len(texts[-1])))
                size += len(texts[-1]) + ORDER + 1
                if size >= BLOCK:
                    yield flush()
                    rows, texts, size = [], [], 0
        if rows:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PACKED_DDL)


def texts_of(meta: np.ndarray, data: bytes) -> list[bytes]:
    whole = pa.decompress(data, decompressed_size=int(meta["size"].sum()), codec="zstd", asbytes=True)
    ends = np.cumsum(meta["size"])
    return [whole[lo:hi] for lo, hi in zip((ends - meta["size"]).tolist(), ends.tolist())]


def token_ids(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different tokens of a block, each text's tokens as places among them, and the number of tokens of each text."""
    ids: dict[bytes, int] = defaultdict(count().__next__)
    found, lengths = [], []
    for t in texts:
        words = t.split()
        words.append(END_TOKEN)
        found.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
        lengths.append(len(words))
    return list(ids), np.concatenate(found), np.array(lengths, np.int64)


def token_rows(texts: DataFrame, dealing: Dealing) -> DataFrame:
    """Packed rows of each block's tokens by part: the tokens, then their counts in training texts and places in the block."""

    def run(batches):
        for b in batches:
            for block, meta, data in zip(*(b.column(c).to_pylist() for c in ("block", "keys", "vals"))):
                meta = np.frombuffer(meta, META)
                tokens, at, lengths = token_ids(texts_of(meta, data))
                train_ = np.bincount(at, np.repeat(1 - meta["held"].astype(np.int64), lengths), len(tokens)).astype(np.int64)
                part = np.fromiter(map(dealing.token_part, tokens), np.int64, len(tokens))
                order = np.argsort(part, kind="stable")
                kinds, starts = np.unique(part[order], return_index=True)
                yield packed_rows([(p, TOKENS, block, len(i), pack_tokens([tokens[k] for k in i]), pack(np.r_[train_[i], i])) for p, i in zip(kinds.tolist(), np.split(order, starts[1:]))])

    return texts.mapInArrow(run, PACKED_DDL)


def grams_of_block(texts: list[bytes]) -> np.ndarray:
    """The different grams of a block, sorted: what it asks for, and the order of the answers."""
    held, size = [], 0
    for part in chunks(texts):
        held.append(distinct(grams(part)[0]))
        size += len(held[-1])
        if size > HELD_GRAMS:
            held = [distinct(np.concatenate(held))]
            size = len(held[0])
    return distinct(np.concatenate(held))


def asked_rows(texts: DataFrame, dealing: Dealing) -> DataFrame:
    """Packed rows of each block's different grams by part."""

    def run(batches):
        for b in batches:
            for block, meta, data in zip(*(b.column(c).to_pylist() for c in ("block", "keys", "vals"))):
                keys = grams_of_block(texts_of(np.frombuffer(meta, META), data))
                yield packed_rows([(part, ASKED, block, len(at), pack_keys(keys[at]), b"") for part, at in dealing.by_part(keys)])

    return texts.mapInArrow(run, PACKED_DDL)


def summed_tokens(rows: list[tuple]) -> dict[bytes, int]:
    """Counts over the corpus of the tokens of one part, from its rows."""
    total: dict[bytes, int] = defaultdict(int)
    for _, n, keys, vals in rows:
        for t, c in zip(unpack_tokens(keys), unpack(vals, 2 * n)[:n].tolist()):
            total[t] += c
    return total


def token_totals(batches):
    """``(total, kinds)`` of the tokens of each part."""
    for _, rows in parts_of(batches):
        c = summed_tokens([r[1:] for r in rows]).values()
        yield pa.RecordBatch.from_arrays([pa.array([sum(c)]), pa.array([sum(x > 0 for x in c)])], names=["total", "kinds"])


def parts_of(batches):
    """``(part, rows)`` of packed rows sorted by part, where ``rows`` runs through ``(kind, block, n, keys, vals)``."""

    def each():
        for b in batches:
            for lo in range(0, b.num_rows, 64):  # a batch may hold much: few rows at a time are copied
                some = b.slice(lo, 64)
                yield from zip(*(some.column(c).to_pylist() for c in PACKED.names))

    for part, rows in groupby(each(), key=lambda r: r[0]):
        yield part, (r[1:] for r in rows)


def answers(batches, dealing: Dealing, shared: Trie):
    """Of packed rows sorted by part and kind: for each block, log10 probabilities of its grams and counts of its tokens.

    A block knows which grams it asked of a part and in which order, so the answer names the part alone (in ``block``).
    """
    for part, rows in parts_of(batches):
        if part >= dealing.parts:
            rows = [r[1:] for r in rows]
            total = summed_tokens(rows)
            for block, n, keys, vals in rows:
                c = np.fromiter(map(total.__getitem__, unpack_tokens(keys)), np.int64, n)
                yield packed_rows([(block, TOKENS, block, n, pack(unpack(vals, 2 * n)[n:]), pack(c))])
            continue
        held, size, trie = [(np.empty(0, np.uint64), np.empty(0, np.int64))], 0, None
        for kind, block, n, keys, vals in rows:
            if kind == COUNTED:
                held.append((unpack_keys(keys, n), unpack(vals, n)))
                size += n
                if size > HELD_GRAMS:
                    held = [merged(held)]
                    size = 0
                continue
            trie = trie or Trie.of(*merged(held), shared)
            held = []
            yield packed_rows([(block, ASKED, part, n, b"", pack_logs(trie.log10(unpack_keys(keys, n))))])


def scored(batches, dealing: Dealing, total: int, floor: float):
    """Of packed rows sorted by block, its texts and its answers: the rows of the result."""
    for _, rows in parts_of(batches):
        answered, tokens, counts = {}, [], []
        for kind, part, n, a, b in rows:
            if kind == TEXTS:
                meta = np.frombuffer(a, META)
                texts = texts_of(meta, b)
            elif kind == ASKED:
                answered[part] = n, b
            else:
                tokens.append(unpack(a, n))
                counts.append(unpack(b, n))
        every = grams_of_block(texts)
        log = np.empty(len(every))
        for part, at in dealing.by_part(every):
            log[at] = unpack_logs(answered[part][1], answered[part][0])
        found = []
        for part in chunks(texts):
            full, starts = grams(part)
            order = np.argsort(full)
            own = np.empty(len(full))
            own[order] = log[np.searchsorted(every, full[order])]
            found.append(np.add.reduceat(own, starts))
        _, at, lengths = token_ids(texts)
        c = np.empty(sum(map(len, counts)), np.int64)
        c[np.concatenate(tokens)] = np.concatenate(counts)
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        base = np.add.reduceat(np.log10(c + 0.1)[at], starts) - lengths * floor
        known = np.add.reduceat((c > 0).astype(np.int64)[at], starts)
        out = [pa.array(meta["id"], mask=meta["null"].astype(bool)), pa.array(meta["held"].astype(bool)), pa.array(lengths), pa.array(known), pa.array(np.full(len(meta), total)), pa.array(base), pa.array(np.concatenate(found))]
        yield pa.RecordBatch.from_arrays(out, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(docs: DataFrame, training: DataFrame | Column, limit: int = LIMIT) -> DataFrame:
    """Model and base scores of each row of ``docs(doc_id, text)`` after learning from ``training(text)``, or from the rows
    of ``docs`` for which the condition ``training`` holds.

    ``score``: log10 probability of the text's bytes (A-Z in lower case) and its end by a trie of all training texts.
    ``base_score``: that of its tokens by training counts plus 0.1, where the training rows are those of ``docs`` whose
    id is not held out. Neither the trie nor the vocabulary is ever in one place: grams are dealt by the two bytes
    before their last one, and by more where those stand in more than ``limit`` bytes of text, so that a part has all
    longer contexts of its grams and scores what blocks of texts ask it for; tokens are dealt by checksum. Only the grams
    of two bytes and those of split contexts, bounded numbers both, come to the driver.
    Null text: empty, which still has its end. Null id: held out, as the checksum of an empty id is 0. An empty table
    gives an empty result; with no training texts every byte has probability 1/256 and every token is new. A very long
    text is worked on whole, in a block of its own. Repeated rows are scored each and count each in training. Columns of
    ``docs`` but these two are not read, whatever their names.
    """
    if isinstance(training, DataFrame):
        rows = training.select("text", F.lit(True).alias("learned")).unionByName(docs.select("text", F.lit(False).alias("learned")))
    else:
        rows = docs.select("text", F.coalesce(training, F.lit(False)).alias("learned"))
        training = docs.where(training)
    dealing, shared = dealt(rows, limit)
    counts = count_grams(training, dealing)
    texts = cut(blocks(docs))
    tokens = cut(token_rows(texts, dealing))
    total, kinds = by_group(tokens, "part", token_totals, "total long, kinds long").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    floor = float(np.log10(total + 0.1 * (kinds + 1)))
    packed = counts.unionByName(tokens).unionByName(asked_rows(texts, dealing)).repartition(partitions(docs.sparkSession), "part").sortWithinPartitions("part", "kind")
    every = packed.mapInArrow(lambda batches: answers(batches, dealing, shared), PACKED_DDL).unionByName(texts)
    # Blocks count up within a task of ``blocks``, so their numbers deal them evenly; by hash, a task gets several while others have none.
    tasks = partitions(docs.sparkSession)
    task = F.pmod(F.shiftright("part", 32) + F.col("part").bitwiseAND((1 << 32) - 1) * 7919, F.lit(tasks)).cast("int")
    rows = every.repartitionById(tasks, task).sortWithinPartitions("part")
    return rows.mapInArrow(lambda batches: scored(batches, dealing, total, floor), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents``, learning from those outside the held-out tenth; edge cases as in ``score``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 != 0)
