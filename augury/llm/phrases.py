"""Collocations from a weighted graph of word sequences.

Texts are cut into pieces at punctuation and line ends, pieces into words. Every position of a piece gives one edge of a
de Bruijn graph: the gram of five words that starts there, from the node of its first four words to that of its last
four. At the end of a piece, where fewer words follow, the edge is the shorter rest of the piece: the correction without which flows
would miss the last words. Edges are counted in each task, then by Spark. The flow of a node is the sum of its edges
and of the ends in it, so each shorter gram's count is the sum over the next longer ones that it begins. Unary paths are
compacted: a phrase whose whole flow goes on to one longer phrase, or comes from one, is that phrase's and is dropped.

Edges are cut by two filters, tables of hashed buckets whose size a parameter bounds: the first counts words and pairs,
the second longer grams whose pairs the first has left. An edge ends before the gram whose bucket holds fewer than `least`
occurrences. No phrase that is frequent enough goes beyond, so counts stay exact; the fuller the tables, the less is cut. A
bit for each bucket is all that is broadcast.

A word of a language is a 64-bit number. Words whose texts are kept are compared by number and text, and everything is
counted again with other numbers if two share one. Grams are compared by the numbers of all their words.

Null texts are empty, a null language is `und`. Empty texts have no words; very long texts count whole. Repeated rows
count each time. Ties go to the smallest cut, and in the report to the phrase that comes first in bytes. Other columns are not
read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from augury.llm.common import remove, small_batches, written
from augury.llm.words import changes, mixed

LONGEST, LEAST, FIRST = 5, 100, 2000
UNKNOWN = "und"
#: Characters of text to a bucket of the filter, and the least and largest number of its bits.
CHARS_A_BUCKET, BITS = 64, (16, 26)
#: Buckets of one row of the filter; edges that a task counts before it passes them on; bytes hashed together.
_BLOCK, _HELD, _GROUP = 1 << 16, 1 << 20, 1 << 20
#: Input partitions that one task counts, as long as every core has SPREAD of them: each task passes on a filter and its
#: own distinct edges, which large tasks have fewer of.
_JOINED, _SPREAD = 4, 2
_U = np.uint64
_NEXT = _U(0x9E3779B97F4A7C15)
#: 0 for bytes of words, 1 between words, 2 between pieces: fixed values.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of each word data[start:end], by its bytes and their places."""
    out = np.empty(len(starts), _U)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _GROUP, "right")))
        n = ends[at:to] - starts[at:to]
        first = np.cumsum(n) - n
        inside = np.arange(int(n.sum())) - np.repeat(first, n)
        letters = data[np.repeat(starts[at:to], n) + inside].astype(_U)
        out[at:to] = np.add.reduceat(mixed(letters + (inside.astype(_U) << _U(8)) + _U(seed + 1)), first)
        at = to
    return mixed(out)


class Words:
    """Words of some texts in order: number (by language and word), whether a piece starts with it, bytes and text."""

    def __init__(self, texts: pa.Array, langs: pa.Array, seed: int):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        buffer = texts.buffers()[2] if len(texts) else None
        data = np.frombuffer(buffer, np.uint8)[edges[0] : edges[-1]] if buffer is not None and edges[-1] > edges[0] else np.empty(0, np.uint8)
        edges = edges - edges[0]
        self.data = _LOWER[data]
        kind = _CLASS[data]
        inner = edges[(edges > 0) & (edges < len(data))]
        full = kind == 0
        begins, stops = full.copy(), full.copy()
        begins[1:] &= ~full[:-1]
        stops[:-1] &= ~full[1:]
        begins[inner] = full[inner]  # a word ends where its text does
        stops[inner - 1] = full[inner - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.text = np.searchsorted(edges, self.starts, "right") - 1
        breaks = np.cumsum(kind == 2, dtype=np.int64)[self.starts]
        self.opens = changes(breaks) | changes(self.text)
        names = pc.fill_null(langs.cast(pa.string()), UNKNOWN).dictionary_encode()
        salt = np.array([int.from_bytes(hashlib.blake2b(f"{seed}:{x}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in names.dictionary.to_pylist()], _U)
        self.langs, which = names.dictionary.to_pylist(), names.indices.to_numpy()
        self.lang = which[self.text] if len(which) else np.empty(0, np.int64)
        number = mixed(_hashes(self.data, self.starts, self.ends, seed) + salt[self.lang]) if len(self.text) else np.empty(0, _U)
        self.number = np.where(number == 0, _U(1), number)


def _runs(w: Words, filters: list[np.ndarray], bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For k = 2 to LONGEST: hashes of the grams of k words that start at each word, and which of them may be frequent: they lie
    in a piece, the two grams in them that are a word shorter may be, and so may their bucket (the first filter is for
    pairs, the second for all longer ones; a missing one lets all pass)."""
    size, hashes = len(w.number), w.number
    number = np.concatenate([w.number, np.zeros(LONGEST, _U)])
    alive = np.zeros(size, bool)
    alive[:-1] = ~w.opens[1:]
    for k in range(2, LONGEST + 1):
        hashes = mixed(hashes * _NEXT + number[k - 1 : size + k - 1])
        if k > 2:
            alive = alive & np.append(alive[1:], False)[:size]
        if len(filters) > min(k - 2, 1):
            alive = alive & filters[min(k - 2, 1)][_bucket(hashes, bits)]
        yield k, hashes, alive


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> _U(64 - bits)).astype(np.int64)


def _merged(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of columns with their summed n, equal rows once. Unequal rows that share a sort key may leave repeats."""
    key = np.zeros(len(n), _U)
    for c in columns:
        key = mixed(key + c)
    order = np.argsort(key)
    columns = [c[order] for c in columns]
    at = np.flatnonzero(np.logical_or.reduce([changes(c) for c in columns]))
    return [c[at] for c in columns], np.add.reduceat(n[order], at) if len(at) else n


def _masses(docs: DataFrame, bits: int, least: int, seed: int, first: Broadcast | None = None) -> DataFrame:
    """Rows (block, counts) of each task's filter, counts up to `least`, and rows (lang, n) of its words. The filter holds
    words and pairs, or with the first filter's bits the longer grams that this lets pass."""
    kind = np.min_scalar_type(least)
    out = pa.schema([("block", pa.int32()), ("counts", pa.binary()), ("lang", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = np.zeros(1 << bits, kind), {}
        filters = [] if first is None else [np.unpackbits(first.value).view(bool)]
        for batch in batches:
            w = Words(batch.column("text"), batch.column("lang"), seed)
            for lang, n in zip(w.langs, np.bincount(w.lang, minlength=len(w.langs))):
                total[lang] = total.get(lang, 0) + int(n)
            runs = _runs(w, filters, bits)
            found = [h[alive] for k, h, alive in runs if k > 2] if filters else [mixed(w.number), (pairs := next(runs))[1][pairs[2]]]
            at, n = np.unique(_bucket(np.concatenate(found), bits), return_counts=True)
            table[at] = np.minimum(table[at].astype(np.int64) + n, least)
        for k in range(0, len(table), _BLOCK):
            if (block := table[k : k + _BLOCK]).any():
                yield pa.RecordBatch.from_arrays([pa.array([k // _BLOCK], pa.int32()), pa.array([block.tobytes()]), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64())], schema=out)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(total), pa.int32()), pa.nulls(len(total), pa.binary()), pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], schema=out)

    return docs.mapInArrow(run, "block int, counts binary, lang string, n long")


def _filter(masses: DataFrame, bits: int, least: int) -> np.ndarray:
    """Bits of buckets with at least `least` occurrences. Blocks are summed where they meet; their bits come back."""
    kind = np.min_scalar_type(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                one = np.frombuffer(counts.as_buffer(), kind)
                sums[block] = np.minimum(sums[block].astype(np.int64) + one, least).astype(kind) if block in sums else one.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.packbits(x >= least).tobytes() for x in sums.values()], pa.binary())], ["block", "bits"])

    blocks = masses.where("block is not null").select("block", "counts").repartition("block").mapInArrow(run, "block int, bits binary")
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    for row in blocks.collect():
        one = np.frombuffer(row["bits"], np.uint8)
        out[row["block"] * _BLOCK // 8 :][: len(one)] = one
    return out


GRAM = [f"w{k}" for k in range(1, LONGEST + 1)]


def _grams(docs: DataFrame, sent: list[Broadcast], bits: int, seed: int) -> DataFrame:
    """Edges (w1 to w5, 0 after the end; n), and words as rows with lang and word; counted by task, then by Spark."""
    out = pa.schema([*[(c, pa.int64()) for c in GRAM], ("n", pa.int64()), ("lang", pa.string()), ("word", pa.string())])

    def shown(columns: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(n), 50_000):
            part = [pa.array(c[a : a + 50_000].view(np.int64)) for c in columns]
            size = len(part[0])
            yield pa.RecordBatch.from_arrays([*part, pa.array(n[a : a + 50_000]), pa.nulls(size, pa.string()), pa.nulls(size, pa.string())], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [np.unpackbits(x.value).view(bool) for x in sent]
        held: tuple[list[np.ndarray], np.ndarray] = [np.empty(0, _U)] * LONGEST, np.empty(0, np.int64)
        known, count, label = np.empty(0, _U), np.empty(0, np.int64), []
        for batch in batches:
            w = Words(batch.column("text"), batch.column("lang"), seed)
            number, columns = np.concatenate([w.number, np.zeros(LONGEST, _U)]), []
            for k, _, alive in _runs(w, filters, bits):
                at = np.flatnonzero(alive) if k == 2 else at
                columns = columns or [number[at]]
                columns.append(np.where(alive[at], number[at + k - 1], _U(0)))
            held = _merged([np.concatenate(x) for x in zip(held[0], columns)], np.concatenate([held[1], np.ones(len(at), np.int64)]))
            if len(held[1]) > _HELD:
                yield from shown(*held)
                held = [np.empty(0, _U)] * LONGEST, np.empty(0, np.int64)
            # Words: those of frequent buckets, each with its text the first time.
            full = np.flatnonzero(filters[0][_bucket(mixed(w.number), bits)]) if len(w.number) else np.empty(0, np.int64)
            ids, first, n = np.unique(w.number[full], return_index=True, return_counts=True)
            place = np.minimum(np.searchsorted(known, ids), max(0, len(known) - 1))
            old = known[place] == ids if len(known) else np.zeros(len(ids), bool)
            count[place[old]] += n[old]
            new = full[first[~old]]
            label += [(w.langs[w.lang[i]], w.data[w.starts[i] : w.ends[i]].tobytes().decode("utf-8", "surrogatepass")) for i in new]
            order = np.argsort(np.concatenate([known, ids[~old]]), kind="stable")
            known, count = np.concatenate([known, ids[~old]])[order], np.concatenate([count, n[~old]])[order]
            label = [label[i] for i in order]
            if len(known) > _HELD // 8:
                yield named(known, count, label)
                known, count, label = np.empty(0, _U), np.empty(0, np.int64), []
        yield from shown(*held)
        yield named(known, count, label)

    def named(known: np.ndarray, count: np.ndarray, label: list[tuple[str, str]]) -> pa.RecordBatch:
        rest = [pa.array(np.zeros(len(known), np.int64))] * (LONGEST - 1)
        return pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), *rest, pa.array(count), pa.array([x for x, _ in label], pa.string()), pa.array([x for _, x in label], pa.string())], schema=out)

    found = docs.mapInArrow(run, ", ".join([*[f"{c} long" for c in GRAM], "n long", "lang string", "word string"]))
    return found.groupBy(*GRAM, "lang", "word").agg(F.sum("n").alias("n"))


def counted(docs: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang", bits: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Exact counts: phrases (gram array of word numbers, a) of one to LONGEST words that occur `least` times, words
    (number, lang, word) and totals (lang, n). All three are written tables."""
    docs = small_batches(docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")))
    docs = docs.coalesce(max(1, _SPREAD * docs.sparkSession.sparkContext.defaultParallelism, docs.rdd.getNumPartitions() // _JOINED))
    if bits is None:
        chars = docs.agg(F.sum(F.length("text").cast("decimal(38,0)"))).first()[0] or 0
        bits = min(max((int(chars) // CHARS_A_BUCKET).bit_length(), BITS[0]), BITS[1])
    seed, send = 0, docs.sparkSession.sparkContext.broadcast
    while True:
        masses = written(_masses(docs, bits, least, seed), "masses")
        totals = written(masses.where("lang is not null").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        sent = [send(_filter(masses, bits, least))]
        sent.append(send(_filter(_masses(docs, bits, least, seed, sent[0]), bits, least)))
        grams = written(_grams(docs, sent, bits, seed), "grams")
        remove(masses)
        named = grams.where("word is not null")
        if named.groupBy("w1").agg(F.count("*").alias("x")).where("x > 1").isEmpty():
            break
        remove(grams)
        remove(totals)
        seed += 1
    levels, flow = [], grams.where("word is null")
    for k in range(LONGEST, 1, -1):
        if k < LONGEST:  # a node's flow is that of the longer grams that it begins
            flow = written(flow.groupBy(*GRAM[:k]).agg(F.sum("n").alias("n")), "flow")
        levels.append(flow.where((F.col("n") >= least) & (F.col(GRAM[k - 1]) != 0)).select(F.array(*GRAM[:k]).alias("gram"), F.col("n").alias("a")))
    words = written(named.where(F.col("n") >= least).select(F.col("w1").alias("number"), "lang", "word", "n"), "words")
    found = words.select(F.array("number").alias("gram"), F.col("n").alias("a"))
    for level in levels:
        found = found.unionByName(level)
    phrases = written(found, "phrases")
    remove(grams)
    return phrases, words, totals


def collocations(docs: DataFrame, least: int = LEAST, first: int | None = FIRST, text: str = "text", lang: str = "lang", bits: int | None = None) -> DataFrame:
    """Each language's phrases by falling score: lang, rank, phrase, a, l, r, n, score, cut (words of the first part).

    Only the first ones of each language are ranked, after each task has dropped what cannot be among them; first None
    ranks all phrases of a language in one task.
    """
    phrases, words, totals = counted(docs, least, text, lang, bits)
    several = phrases.where(F.size("gram") > 1)
    size = F.size("gram")
    part = lambda start, n: F.slice("gram", start, n)
    # Unary paths: the flow of a phrase goes wholly to, or comes wholly from, one that is a word longer.
    wider = several.where(size > 2).select(F.explode(F.array(part(F.lit(1), size - 1), part(F.lit(2), size - 1))).alias("inner"), F.col("a").alias("longer"))
    wider = wider.groupBy("inner").agg(F.max("longer").alias("longer"))
    kept = several.join(wider, F.col("gram") == F.col("inner"), "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).select("gram", "a")
    cuts = kept.select("gram", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("gram", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, size - F.col("k")).alias("right"))
    cuts = cuts.join(phrases.select(F.col("gram").alias("left"), F.col("a").alias("l")), "left")
    cuts = cuts.join(phrases.select(F.col("gram").alias("right"), F.col("a").alias("r")), "right")
    cuts = written(cuts.select("gram", "a", "k", "l", "r"), "cuts")
    # Texts: each word of a kept phrase finds its own.
    each = kept.select("gram", F.posexplode("gram").alias("at", "number")).join(words.select("number", "lang", "word"), "number")
    texts = each.groupBy("gram").agg(F.min("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (whole("a") * whole("n")), whole("l") * whole("r"))
    ready = texts.join(totals, "lang").join(cuts, "gram").select("gram", "lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    lowest = ready.groupBy("gram", "lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    listed = lowest.withColumn("rank", rank)
    listed = listed if first is None else listed.where(F.col("rank") <= first)
    return listed.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"), F.col("cut.k").alias("cut"))
