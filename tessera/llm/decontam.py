"""Benchmark decontamination by spaced-seed hashing.

A fixed mask selects some positions of a window of tokens and ignores the others, so a window still hashes to the same
value when a token at an ignored position was substituted. The hashes of all windows of the benchmark form an index; every
window of every document is looked up in it. A hit fixes how document and item lie on each other, and the whole
item is compared token by token there: an overlap counts if any stretch has enough agreeing tokens, and a large enough share
of them. A short item needs fewer tokens, and further masks that select less look for it.

Up to BLOCK_TOKENS tokens of a benchmark the join's build side is an index in memory, which is broadcast: one pass over the
documents, without a shuffle. A larger benchmark is joined by Spark: windows of the documents that a bitmap of bounded size lets through
meet the benchmark's by their hashes, and the tokens of the pairs that come out are joined by their places; so it takes two passes
over the documents, whatever the size of the benchmark. Both ways give the same rows.

Items of equal tokens are one class, which is searched once. A window that many items share makes many pairs: they are counted
together, and those that agree at the same places are measured once.

Tokens are runs of letters and digits in lower case. Defined results: null and empty texts, on either side, overlap with
nothing; items of fewer than SHORTEST tokens must be found whole, those of fewer than EXACT tokens are not looked for; an item or document that
comes twice counts as one (by id) for pairs; empty tables give no overlaps; further columns are ignored; long
texts are searched whole; among equally good overlaps of a pair the first is reported.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, bitmap, bound_batches, cut, in_bitmap

#: The masks: 1 selects a position. Each ignores other positions, so that one substitution within a window leaves a hit.
MASKS = ("11011101", "10111011", "11101101", "111111")
#: Masks for items of up to so many tokens, in which a few substitutions may leave no window of the others. With MIN_SHARE of the tokens
#: agreeing there are three in a row, or two pairs with one or two tokens between them.
LIGHT_MASKS = {"111": 32, "11011": 32, "1101011": 8}
#: Tokens that must agree (of short items the share), and the share of agreeing tokens from the first to the last of a stretch. Items under
#: SHORTEST tokens tolerate nothing; under EXACT tokens they are common words rather than passages.
MIN_TOKENS, MIN_SHARE, SHORTEST, EXACT = 13, 0.7, 6, 4
#: Tokens of the benchmark in a broadcast index: about 100 MB in a worker at the most.
BLOCK_TOKENS = 1 << 20
#: Pairs of windows, and tokens of items, that are compared at once.
PAIRS_AT_ONCE, TOKENS_AT_ONCE = 1 << 18, 1 << 21
#: Bits of the filter before the join of a larger benchmark: 128 MB.
FILTER_BITS = 1 << 30

_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_MULT = np.random.default_rng(2).integers(0, 2**63, 8, np.uint64) * np.uint64(2) + np.uint64(1)


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def _windows(ids: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the windows of a mask without unknown tokens at selected positions."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    on = [k for k, c in enumerate(mask) if c == "1"]
    known = ids != 0
    whole = known[:n].copy()
    for k in on[1:]:
        whole &= known[k : k + n]
    at = np.flatnonzero(whole)
    plain = ids.view(np.uint64)
    h = np.zeros(len(at), np.uint64)
    for k in on:
        h += plain[at + k] * _MULT[k]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return at, h


def _need(n: int) -> int:
    """The tokens of an item of ``n`` that have to agree."""
    return n if n < SHORTEST else min(MIN_TOKENS, math.ceil(MIN_SHARE * n - 1e-9))


def _stretch(same: np.ndarray, need: int) -> tuple[int, int, int] | None:
    """(agreeing tokens, first and end place) of the best stretch of places that agree or not."""
    # for each start the last end up to which the share holds, by sums of agreeing tokens less the share of all
    agreed = np.concatenate([[0], np.cumsum(same)])
    level = agreed - MIN_SHARE * np.arange(len(agreed))
    rest = np.maximum.accumulate(level[::-1])
    ends = len(same) - np.searchsorted(rest, level - 1e-9, "left")
    start = int(np.argmax(agreed[ends] - agreed))
    inside = np.flatnonzero(same[start : ends[start]])
    if len(inside) < need:
        return None
    return len(inside), start + int(inside[0]), start + int(inside[-1]) + 1


class Index:
    """Windows of the classes of some benchmark items."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.words: dict[str, int] = {}
        number = self.words.setdefault
        classes: dict[tuple[str, ...], list[int]] = {}
        for k, ws in items:
            classes.setdefault(tuple(ws), []).append(k)
        self.ids = [sorted(set(ks)) for ks in classes.values()]
        self.items = [np.array([number(w, len(self.words) + 1) for w in ws], np.int64) for ws in classes]
        self.sizes = np.array([len(x) for x in self.items], np.int64)
        self.needs = np.array([_need(len(x)) for x in self.items], np.int64)
        self.starts = np.cumsum([0, *self.sizes])
        self.flat = np.concatenate(self.items) if self.items else np.empty(0, np.int64)
        self.tables = []
        for mask in (*MASKS, *LIGHT_MASKS):
            found = [(*_windows(ids, mask), start) for ids, start in zip(self.items, self.starts, strict=False) if len(ids) <= LIGHT_MASKS.get(mask, len(ids))]
            h = np.concatenate([f for _, f, _ in found]) if found else np.empty(0, np.uint64)
            at = np.concatenate([f + start for f, _, start in found]) if found else np.empty(0, np.int64)
            order = np.argsort(h, kind="stable")
            # a first look at 16 bits of a hash spares most searches
            seen = np.zeros(1 << 16, bool)
            seen[(h >> np.uint64(48)).astype(np.int64)] = True
            self.tables.append((mask, h[order], at[order], seen))

    def hits(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(classes, document positions of their first tokens), the positions possibly negative, PAIRS_AT_ONCE and a window's at a time."""
        waiting: list[np.ndarray] = []
        size = 0

        def pairs() -> tuple[np.ndarray, np.ndarray]:
            both = np.unique(np.concatenate(waiting, axis=1), axis=1)
            return both[0], both[1]

        for mask, table, at, seen in self.tables:
            if not len(table):
                continue
            some, h = _windows(ids, mask)
            likely = seen[(h >> np.uint64(48)).astype(np.int64)]
            some, h = some[likely], h[likely]
            if not len(some):
                continue
            lo = np.searchsorted(table, h, "left")
            n = np.searchsorted(table, h, "right") - lo
            keep = np.flatnonzero(n)
            some, lo, n = some[keep], lo[keep], n[keep]
            sums = np.cumsum(n)
            a = 0
            while a < len(n):
                b = max(a + 1, int(np.searchsorted(sums, (sums[a - 1] if a else 0) + PAIRS_AT_ONCE, "right")))
                m = n[a:b]
                where = at[np.repeat(lo[a:b] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))]
                item = np.searchsorted(self.starts, where, "right") - 1
                waiting.append(np.stack([item, np.repeat(some[a:b], m) - (where - self.starts[item])]))
                size += len(item)
                a = b
                if size >= PAIRS_AT_ONCE:
                    yield pairs()
                    waiting, size = [], 0
        if waiting:
            yield pairs()

    def overlaps(self, ids: np.ndarray, items: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(class, agreeing tokens, first and end position in the document) of the classes that overlap where they are laid. All are counted
        together; of those that agree in enough tokens the best stretch is found, once for each pattern of agreement."""
        known: dict[tuple[bytes, int], tuple[int, int, int] | None] = {}
        sums = np.cumsum(self.sizes[items])
        a = 0
        while a < len(items):
            b = max(a + 1, int(np.searchsorted(sums, (sums[a - 1] if a else 0) + TOKENS_AT_ONCE, "right")))
            k, n = items[a:b], self.sizes[items[a:b]]
            begin = np.cumsum(n) - n
            off = np.arange(int(n.sum())) - np.repeat(begin, n)
            place = np.repeat(shifts[a:b], n) + off
            inside = (place >= 0) & (place < len(ids))
            same = inside & (ids[np.where(inside, place, 0)] == self.flat[np.repeat(self.starts[k], n) + off])
            enough = np.flatnonzero(np.add.reduceat(same, begin, dtype=np.int64) >= self.needs[k])
            for j in enough.tolist():
                need = int(self.needs[k[j]])
                part = same[begin[j] : begin[j] + n[j]]
                key = (part.tobytes(), need)
                if key not in known:
                    known[key] = _stretch(part, need)
                if (o := known[key]) is not None:
                    yield int(k[j]), o[0], o[1] + int(shifts[a + j]), o[2] + int(shifts[a + j])
            a = b

    def code(self, text: str | None) -> np.ndarray | None:
        """The tokens of a text as numbers, 0 for those of no item."""
        ws = tokens(text)
        if len(ws) < EXACT or not self.words:
            return None
        return np.fromiter(map(self.words.get, ws, repeat(0)), np.int64, len(ws))

    def search(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        """The best overlap with each item (by its id)."""
        found: dict[int, tuple[int, int, int]] = {}
        if (ids := self.code(text)) is None:
            return found
        for items, shifts in self.hits(ids):
            for c, *o in self.overlaps(ids, items, shifts):
                if c not in found or (o[0], -o[1]) > (found[c][0], -found[c][1]):
                    found[c] = tuple(o)
        out: dict[int, tuple[int, int, int]] = {}
        for c, o in found.items():
            for key in self.ids[c]:
                if key not in out or (o[0], -o[1]) > (out[key][0], -out[key][1]):
                    out[key] = o
        return out

    def holds(self, text: str | None) -> bool:
        """Whether a text overlaps with any item."""
        ids = self.code(text)
        return ids is not None and any(True for items, shifts in self.hits(ids) for _ in self.overlaps(ids, items, shifts))


def _index(benchmark: DataFrame) -> Index | None:
    """The index of a benchmark of up to BLOCK_TOKENS tokens; the driver reads it partition by partition, and no further than that."""
    items: list[tuple[int, list[str]]] = []
    size = 0
    for row in benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").toLocalIterator():
        ws = tokens(row[1])
        size += len(ws)
        if size > BLOCK_TOKENS:
            return None
        if len(ws) >= EXACT:
            items.append((row[0], ws))
    return Index(items)


def _token_hashes(ws: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) >> 1 | 1 for w in ws), np.int64, len(ws))


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64), pa.int64())


def _classes(b: pa.RecordBatch) -> pa.RecordBatch | None:
    """(item_id, class, ids): the hashed tokens of each item, and the digest of its tokens."""
    rows = []
    for k, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
        ws = tokens(text)
        if len(ws) >= EXACT:
            rows.append((k, xxhash.xxh3_128_hexdigest(" ".join(ws)), _token_hashes(ws)))
    if not rows:
        return None
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["item_id", "class", "ids"])


def _item_windows(b: pa.RecordBatch) -> pa.RecordBatch:
    """(h, class, at) of all windows of each class."""
    hashes, names, places = [], [], []
    for name, ids in zip(b.column("class").to_pylist(), b.column("ids").to_pylist(), strict=True):
        ids = np.array(ids, np.int64)
        for mask in (*MASKS, *LIGHT_MASKS):
            if len(ids) <= LIGHT_MASKS.get(mask, len(ids)):
                at, h = _windows(ids, mask)
                hashes.append(h)
                places.append(at)
                names += [name] * len(at)
    return pa.RecordBatch.from_arrays([_long(np.concatenate(hashes)), pa.array(names), pa.array(np.concatenate(places).astype(np.int32))], ["h", "class", "at"])


def _joined(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(k, doc_id, item_id, n_matched, token_start, token_end) for rows (k, doc_id, text), by joins in Spark. ``k`` tells texts apart."""
    spark = docs.sparkSession
    items = cut(arrow_map(benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text"), _classes, "item_id long, class string, ids array<long>"), "items")
    classes = items.groupBy("class").agg(F.first("ids").alias("ids"))
    windows = cut(arrow_map(classes, _item_windows, "h long, class string, at int"), "windows")
    shared = spark.sparkContext.broadcast(bitmap(windows, "h", windows.count(), FILTER_BITS, hashed=True))

    def likely(b: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for k, doc, text in zip(*(b.column(c).to_pylist() for c in ("k", "doc_id", "text")), strict=True):
            if len(ws := tokens(text)) < EXACT:
                continue
            ids = _token_hashes(ws)
            for mask in (*MASKS, *LIGHT_MASKS):
                at, h = _windows(ids, mask)
                on = in_bitmap(shared.value, h.view(np.int64))
                if on.any():
                    rows.append((h[on], np.full(int(on.sum()), k, np.int64), [doc] * int(on.sum()), at[on]))
        if not rows:
            return None
        h, k, _, at = (np.concatenate([r[c] for r in rows]) if c != 2 else None for c in range(4))
        return pa.RecordBatch.from_arrays([_long(h), pa.array(k), pa.array([d for r in rows for d in r[2]], pa.int64()), pa.array(at.astype(np.int32))], ["h", "k", "doc_id", "place"])

    hits = arrow_map(docs.where("text IS NOT NULL"), likely, "h long, k long, doc_id long, place int")
    laid = cut(hits.join(windows, "h").selectExpr("k", "doc_id", "class", "place - at AS shift").distinct(), "laid")

    def spell(b: pa.RecordBatch) -> pa.RecordBatch:
        coded = [(k, _token_hashes(tokens(t))) for k, t in zip(b.column("k").to_pylist(), b.column("text").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(len(c), k, np.int64) for k, c in coded])), pa.array(np.concatenate([np.arange(len(c), dtype=np.int32) for _, c in coded])), _long(np.concatenate([c for _, c in coded]))], ["k", "place", "token"])

    texts = docs.where("text IS NOT NULL").select("k", "text").join(laid.select("k").distinct(), "k", "left_semi").dropDuplicates(["k"])
    said = arrow_map(texts, spell, "k long, place int, token long")
    asked = laid.join(classes, "class").select("k", "doc_id", "class", "shift", F.size("ids").alias("n"), F.posexplode("ids").alias("off", "token")).withColumn("place", F.expr("shift + off"))
    agreed = asked.join(said, ["k", "place", "token"]).groupBy("k", "doc_id", "class", "shift", "n").agg(F.array_sort(F.collect_list("off")).alias("offs"))

    def measure(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for n, shift, offs in zip(*(b.column(c).to_pylist() for c in ("n", "shift", "offs")), strict=True):
            same = np.zeros(n, bool)
            same[offs] = True
            o = _stretch(same, _need(n)) if len(offs) >= _need(n) else None
            out.append(o and (o[0], o[1] + shift, o[2] + shift))
        kept = pa.array([o is not None for o in out])
        table = b.select(["k", "doc_id", "class"]).filter(kept)
        out = [o for o in out if o is not None]
        return pa.RecordBatch.from_arrays([*table.columns, *(pa.array([o[c] for o in out], pa.int64()) for c in range(3))], ["k", "doc_id", "class", "n_matched", "token_start", "token_end"])

    found = arrow_map(agreed, measure, "k long, doc_id long, class string, n_matched long, token_start long, token_end long")
    return found.join(items.select("item_id", "class").distinct(), "class").drop("class")


_FOUND = "doc_id long, item_id long, n_matched long, token_start long, token_end long"


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_matched, token_start, token_end): the best overlap of each document and item that overlap."""
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = _index(benchmark)
    if index is None:
        found = _joined(docs.withColumn("k", _key()), benchmark).drop("k")
    else:
        shared = spark.sparkContext.broadcast(index)

        def run(b: pa.RecordBatch) -> pa.RecordBatch | None:
            rows = []
            for k, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                rows += [(k, item, *o) for item, o in shared.value.search(text).items()]
            if not rows:
                return None
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "item_id", "n_matched", "token_start", "token_end"])

        found = arrow_map(docs, run, _FOUND)
    best = F.max(F.struct("n_matched", (-F.col("token_start")).alias("s"), "token_end")).alias("o")
    return found.groupBy("doc_id", "item_id").agg(best).selectExpr("doc_id", "item_id", "o.n_matched AS n_matched", "-o.s AS token_start", "o.token_end AS token_end")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that overlap with no item. With a benchmark in memory they are judged where they lie."""
    index = _index(benchmark)
    if index is None:
        keyed = docs.select(_key().alias("k"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        found = cut(_joined(keyed, benchmark).select(F.col("k").alias("__k")).distinct(), "contaminated")
        return docs.withColumn("__k", _key()).join(found, "__k", "left_anti").drop("__k")
    fields = docs.schema
    at = fields.fieldNames().index("text")
    shared = docs.sparkSession.sparkContext.broadcast(index)
    return arrow_map(docs, lambda b: b.filter(pa.array([not shared.value.holds(t) for t in b.column(at).to_pylist()], pa.bool_())), fields)
