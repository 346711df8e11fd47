"""Benchmark decontamination by Wu-Manber search for many word windows at once.

Words are runs of digits, ASCII letters (lower-cased) and all characters from U+0080. A window is ten consecutive
words of an item; an item of fewer words, but not none, is one window. Windows of one length are searched together: the
block of the last two words under the window's end gives the shift; at a shift of zero the hash of the words under the
window selects a bucket of test strings, whose words are compared one by one. All texts of a batch are searched in step,
in segments of bounded length.

A null text has no words; null item ids are searched but not listed; items that repeat, by id or text, are listed once;
ids of any type are listed as text, in its order. Rows of documents are handled one by one: repeated rows, ties, null ids
and extra columns stay in the struct `row`. Very long texts and items are cut into overlapping segments. No items: nothing
is hit. Empty documents give an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.llm.common import with_results, written

WINDOW = 10
#: About how much benchmark text, in bytes, is sent to the tasks at once; more is searched in several passes. The tables
#: of so much text take about 110 MB, once in each Python worker.
PASS_BYTES = 16_000_000
#: Words of an item in a row of its own, and of a text searched in one go.
PIECE, SEGMENT = 10_000, 512
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_FOUND = pa.schema([("n_words", pa.int64()), ("hits", _SPANS), ("items", pa.list_(pa.string()))])
_TABLE = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(1000)], np.uint64)
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


class WuManber:
    """Search tables of windows of one length m: windows start at the places `starts` of the word ids `flat`."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, m: int):
        self.m, self.block = m, min(2, m)
        self.flat = flat
        keys, shifts = [], []
        for end in range(self.block, m + 1):
            keys.append(self._keys(flat, starts + end))
            shifts.append(np.full(len(starts), m - end, np.uint8 if m < 256 else np.int64))
        keys, shifts = np.concatenate(keys), np.concatenate(shifts)
        order = np.lexsort((shifts, keys))
        keys, shifts = keys[order], shifts[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        self.keys, self.shifts = keys[first], shifts[first]
        hashes = self._hashes(flat, starts)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.order = hashes[order], starts[order], order

    def _keys(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Key of the block of words before each end."""
        return ids[ends - 1] if self.block == 1 else (ids[ends - 2] << np.int64(32)) | ids[ends - 1]

    def _hashes(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        for k in range(self.m):
            out += (ids[starts + k] + 1).astype(np.uint64) * _POWERS[k]
        return out

    def shift(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        key = self._keys(ids, ends)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.shifts[at], self.m - self.block + 1)

    def search(self, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, number of the window) of each occurrence in texts, whose words are ids[edge:next]."""
        sizes = np.maximum(np.diff(edges) - self.m + 1, 0)  # places where a window can end
        cuts = -(-sizes // SEGMENT)
        at = _ranges(np.zeros(len(cuts), np.int64), cuts) * SEGMENT + np.repeat(edges[:-1] + self.m, cuts)
        last = np.minimum(at + SEGMENT - 1, np.repeat(edges[1:], cuts))
        ends = []
        while len(at):
            step = self.shift(ids, at)
            ends.append(at[step == 0])
            at = at + np.maximum(step, 1)
            on = at <= last
            at, last = at[on], last[on]
        start = np.concatenate([np.empty(0, np.int64), *ends]) - self.m
        h = self._hashes(ids, start)
        lo, hi = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        start, test = np.repeat(start, hi - lo), _ranges(lo, hi - lo)
        same = np.ones(len(start), bool)
        for k in range(self.m):
            same &= ids[start + k] == self.flat[self.starts[test] + k]
        return start[same], self.order[test[same]]


class Benchmark:
    """Search tables of items (id, text), by length of the window."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        found = [(i, w) for i, t in items if (w := words(t))]
        self.place: dict[bytes, int] = {}
        flat = np.fromiter((self.place.setdefault(w, len(self.place)) for _, ws in found for w in ws), np.int64)
        sizes = np.array([len(w) for _, w in found], np.int64)
        begin = np.cumsum(sizes) - sizes
        ids = np.array([i for i, _ in found], object)
        self.by_length = []
        for m in np.unique(np.minimum(sizes, window)):
            own = np.flatnonzero(np.minimum(sizes, window) == m)
            n = sizes[own] - m + 1
            self.by_length.append((WuManber(flat, _ranges(begin[own], n), int(m)), np.repeat(ids[own], n)))

    def scan(self, texts: list[str | None]) -> list:
        """Number of words, hit ranges and listed items of each text."""
        split = list(map(words, texts))
        sizes = np.array([len(w) for w in split], np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        get = self.place.get
        flat = np.fromiter((get(w, -1) for ws in split for w in ws), np.int64, int(edges[-1]))
        change = np.zeros(len(flat) + 1, np.int64)
        listed: list[set] = [set() for _ in texts]
        for table, ids in self.by_length:
            start, window = table.search(flat, edges)
            np.add.at(change, start, 1)
            np.add.at(change, start + table.m, -1)
            for doc, item in zip(np.searchsorted(edges, start, "right") - 1, ids[window]):
                if item is not None:
                    listed[doc].add(item)
        hit = np.cumsum(change)[:-1] > 0
        # Runs of hit words, cut where a text ends.
        doc = np.repeat(np.arange(len(texts)), sizes)
        new = hit & np.concatenate([[True], ~hit[:-1] | (doc[1:] != doc[:-1])])[: len(hit)]
        first, run = np.flatnonzero(new), np.cumsum(new)[hit] - 1
        length = np.bincount(run, minlength=len(first))
        hits: list[list] = [[] for _ in texts]
        for d, a, n in zip(doc[first], first - edges[doc[first]], length):
            hits[d].append({"first": int(a), "last": int(a + n)})
        return [sizes.tolist(), hits, [sorted(x) for x in listed]]


@lru_cache(1)
def _benchmark(sent, window: int) -> Benchmark:
    """Tables of a broadcast, once in each worker (which has one object for it)."""
    return Benchmark(sent.value, window)


def _pass(docs: DataFrame, items: list[tuple], window: int, text: str, keep: list[str] | None = None) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def start():
        table = _benchmark(sent, window)
        return lambda row: table.scan(row.field(text).to_pylist())

    return with_results(docs, start, _FOUND, keep)


def pieces(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id string, text): items cut into overlapping runs of words, so that each is small and every window
    lies in one of them."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.regexp_extract_all(low, F.lit(_WORDS), F.lit(0)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1), F.lit(PIECE))
    cut = rows.select("item_id", "w", F.explode(starts).alias("at"))
    return cut.select("item_id", F.array_join(F.slice("w", F.col("at"), F.lit(PIECE + window - 1)), " ").alias("text")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Columns row, n_words, hits (word ranges, last exclusive, merged), items (sorted ids), n_hit, contaminated.

    The size of the benchmark is summed first; if it is over pass_bytes, hashed parts of it, each about that size, are
    searched one after another. Then the documents are written once with numbers, and the passes return the numbers of
    documents that are hit.
    """
    items = pieces(benchmark, window)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, ceil(size / pass_bytes))
    if passes == 1:
        out = _pass(docs, [tuple(r) for r in items.collect()], window, text)
    else:
        items = written(items, "items")
        numbered = written(docs.select(F.struct("*").alias("row")).withColumn("number", F.monotonically_increasing_id()), "numbered")
        texts = numbered.select("number", F.col("row").getField(text).alias("text"))
        found = None
        for k in range(passes):
            part = items.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == k)
            one = _pass(texts, [tuple(r) for r in part.collect()], window, "text", ["number"]).where(F.size("hits") > 0)
            one = written(one.select("row.number", "hits", "items"), "searched")
            found = one if found is None else found.unionByName(one)
        summed = found.groupBy("number").agg(F.flatten(F.collect_list("hits")).alias("all"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        counted = _pass(texts, [], window, "text", ["number"]).select("row.number", "n_words")
        none = F.array().cast("array<struct<first: bigint, last: bigint>>")
        out = numbered.join(counted, "number").join(summed, "number", "left")
        out = out.select("row", "n_words", F.coalesce(merged_spans(F.array_sort("all")), none).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return out.withColumn("n_hit", n_hit).withColumn("contaminated", F.col("n_hit") > 0)


def merged_spans(spans):
    """Union of sorted spans, as spans that neither touch nor overlap."""
    start = F.array().cast("array<struct<first: bigint, last: bigint>>")

    def add(out, s):
        end = F.element_at(out, -1)
        apart = (F.size(out) == 0) | (F.try_element_at(out, F.lit(-1))["last"] < s["first"])
        joined = F.struct(end["first"].alias("first"), F.greatest(end["last"], s["last"]).alias("last"))
        return F.when(apart, F.array_append(out, s)).otherwise(F.array_append(F.slice(out, 1, F.size(out) - 1), joined))

    return F.aggregate(spans, start, add)
