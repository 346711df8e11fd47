"""Language-model scores from an n-gram trie of Elias-Fano sequences in memory-mapped files.

Tokens are the words of the text (A-Z lower-cased) and one end. Spark counts the words of the training texts, then the
pairs of adjacent tokens, then the triples; each shard of counts becomes one file in the shared folder: sorted contexts,
monotone pointers to their successors, the successors themselves made monotone by adding their context's place, and one
byte per entry for its discounted probability. The context of a triple is its pair's place in the level above. Scoring
maps over the documents and searches the files in place: a token's probability is its discounted share after the two
tokens before, plus what the discount left times its share after the one before, and so on down to its smoothed frequency.

A word's shard is the top of its hash, a pair's goes by hash of its context, a triple's is that of its pair; contexts that
are more frequent than a bound are dealt by hash of the entry, so no shard depends on one frequent word or pair. Nothing
is pruned.

A null text is empty: its one token is the end. Rows are scored one by one, whatever repeats; a null id counts as
training. Without training tokens every probability is that of an unknown word. A very long text is one batch of tokens
in one task. Equal texts have equal scores, so there are no ties to break. Extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.llm.common import shared_dir, small_batches
from augury.llm.eliasfano import EliasFano, encode, load, save
from augury.llm.words import Tokens, changes, mixed

DISCOUNT = 0.75
SMOOTH = 0.1
#: Token occurrences a shard holds about, and tokens that a task counts before it hands them out.
SHARD, HELD = 2_000_000, 3_000_000
#: Contexts more frequent than this, or than a 10,000th of all tokens, are dealt by entry.
HOT = 1 << 20
#: In the shard of a triple, codes of pairs from here on stand for the frequent ones in their order.
_SPREAD = 1 << 28
_U = np.uint64
_DEALT = pa.schema([("shard", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_DONE = pa.schema([("shard", pa.int64()), ("entries", pa.int64()), ("tokens", pa.int64()), ("context", pa.int64()), ("successors", pa.int64()), ("total", pa.int64())])
_DEALT_SQL, _DONE_SQL = "shard long, keys binary, counts binary", "shard long, entries long, tokens long, context long, successors long, total long"


def local(folder: str) -> str:
    """The shared folder as a path that tasks can map into memory."""
    found = urlparse(folder)
    if found.scheme not in ("", "file"):
        raise ValueError(f"{folder}: the trie is memory-mapped, so spark.checkpoint.dir must be a mounted folder (file:)")
    return found.path


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and how often each occurs."""
    first = np.flatnonzero(changes(x))
    return x[first], np.diff(np.append(first, len(x)))


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest ones first: high bytes are mostly zero, which compression takes away."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _from_planes(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel()


class _Dealer:
    """Holds keys by shard and hands them out sorted and counted when there are many."""

    def __init__(self):
        self.parts, self.n = [], 0

    def add(self, keys: np.ndarray, shards: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys.astype(_U), shards.astype(np.uint32)))
        self.n += len(keys)
        if self.n >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        keys, shards = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.n = [], 0
        order = np.argsort(shards.astype(np.uint16) if shards.max() < 1 << 16 else shards, kind="stable")
        keys, (names, sizes) = keys[order], _runs(shards[order])
        for name, end, size in zip(names, np.cumsum(sizes), sizes):
            found, counts = _runs(np.sort(keys[end - size : end]))
            yield pa.RecordBatch.from_arrays([pa.array([int(name)]), pa.array([_planes(np.diff(found, prepend=_U(0)))]), pa.array([_planes(counts.astype(np.uint32))])], schema=_DEALT)


def _gathered(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of a shard and their summed counts."""
    keys = np.concatenate([np.cumsum(_from_planes(b, _U), dtype=_U) for b in group.column("keys").to_pylist()])
    counts = np.concatenate([_from_planes(b, np.uint32) for b in group.column("counts").to_pylist()]).astype(np.int64)
    order = np.argsort(keys)
    first = np.flatnonzero(changes(keys[order]))
    return keys[order][first], np.add.reduceat(counts[order], first)


def _done(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_DONE)


def _quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and 256 even steps between the extremes, which bound the error of every value."""
    levels = np.linspace(values.min(), values.max(), 256).astype(np.float32)
    return np.searchsorted((levels[1:] + levels[:-1]) / 2, values).astype(np.uint8), levels


class Vocabulary:
    """Words by hash: ids in the order of hashes, and counts."""

    def __init__(self, folder: str, bits: int, sizes: list[int]):
        self.folder, self.bits = folder, bits
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self._shards: dict[int, tuple] = {}

    def _shard(self, s: int) -> tuple:
        if s not in self._shards:
            arrays = load(f"{self.folder}/words-{s}")
            self._shards[s] = EliasFano(arrays, "words"), arrays["counts"]
        return self._shards[s]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of sorted hashes."""
        shard = (hashes >> _U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        mask = _U((1 << (64 - self.bits)) - 1)
        for s, here in _groups(shard):
            if self.offsets[s + 1] > self.offsets[s]:
                words, n = self._shard(s)
                at = words.find(hashes[here] & mask)
                ok = at >= 0
                ids[here[ok]] = self.offsets[s] + at[ok]
                counts[here[ok]] = n[at[ok]]
        return ids, counts


def _groups(shards: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard with the places that it has, in ascending order."""
    if len(shards):
        order = np.argsort(shards.astype(np.uint16) if shards.max() < 1 << 16 else shards, kind="stable")
        for here in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1):
            yield int(shards[here[0]]), here


class Level:
    """Contexts with their successors in one shard: a context is found, then the successor within its range."""

    def __init__(self, arrays: dict[str, np.ndarray], width: int):
        self.contexts, self.pointers, self.successors = (EliasFano(arrays, k) for k in ("contexts", "pointers", "successors"))
        self.code, self.levels, self.width = arrays["code"], arrays["levels"], width
        self.rest = (arrays["rest"], arrays["rest_levels"]) if "rest" in arrays else None

    def find(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, ...]:
        """For queries sorted by context: place of the entry (-1: not seen), its share, the number of successors of its
        context, and what the discount left to the context, if the level has that."""
        new = changes(context)
        which = np.cumsum(new) - 1
        place = self.contexts.find(context[new])
        seen = place >= 0
        n, rest = np.zeros(len(place), np.int64), np.zeros(len(place))
        lo, hi = self.pointers.ranges(place[seen])
        n[seen] = (hi - lo).astype(np.int64)
        if self.rest:
            rest[seen] = 10.0 ** self.rest[1][self.rest[0][place[seen]]].astype(np.float64)
        place = place[which]
        at, share = np.full(len(context), -1, np.int64), np.zeros(len(context))
        on = np.flatnonzero(place >= 0)
        at[on] = self.successors.find(place[on] * self.width + successor[on])
        hit = at >= 0
        share[hit] = 10.0 ** self.levels[self.code[at[hit]]].astype(np.float64)
        return at, share, n[which], rest[which]


def _level_arrays(keys: np.ndarray, counts: np.ndarray, totals, contexts_under: int, width: int) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Arrays of a level whose sorted keys are context * width + successor, with its contexts, pointers and totals."""
    context, successor = keys // _U(width), keys % _U(width)
    first = np.flatnonzero(changes(context))
    contexts, pointers = context[first].astype(np.int64), np.append(first, len(keys))
    totals = totals(contexts, np.add.reduceat(counts, first))
    place = np.repeat(np.arange(len(contexts), dtype=_U), np.diff(pointers))
    code, levels = _quantised(np.log10((counts - DISCOUNT) / totals[place.astype(np.int64)]))
    arrays = encode("contexts", contexts, contexts_under) | encode("pointers", pointers, len(keys) + 1)
    arrays |= encode("successors", place * _U(width) + successor, len(contexts) * width)
    return arrays | {"code": code, "levels": levels}, contexts, pointers, totals


class Trie:
    """Files of a model, opened as they are asked for."""

    def __init__(self, model: dict):
        self.m, self.words = model, Vocabulary(model["folder"], model["bits"], model["sizes"])
        self.width = model["words"] + 2  # the start and the unknown word have ids too
        self._levels: dict[tuple, Level | None] = {}

    def level(self, name: str, s: int) -> Level | None:
        if (name, s) not in self._levels:
            path = f"{self.m['folder']}/{name}-{s}"
            self._levels[name, s] = Level(load(path), self.width) if os.path.exists(path) else None
        return self._levels[name, s]

    def totals(self, ids: np.ndarray) -> np.ndarray:
        """Occurrences of words as contexts, by id in ascending order; the start counts once a text."""
        out = np.full(len(ids), self.m["documents"], np.int64)
        off = self.words.offsets
        shard = np.searchsorted(off, ids, "right") - 1
        for s, here in _groups(np.where(ids < self.m["words"], shard, -1) + 1):
            if s:
                out[here] = self.words._shard(s - 1)[1][ids[here] - off[s - 1]]
        return out

    def read(self, texts: pa.Array) -> tuple[Tokens, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens with the id and count of each occurrence, and those of the token before it."""
        t = Tokens(texts)
        hashes, back = t.distinct()
        ids, counts = self.words.find(hashes)
        ids, counts = ids[back], counts[back]
        context, before = np.roll(ids, 1), np.roll(counts, 1)
        context[t.starts], before[t.starts] = self.m["words"], self.m["documents"]
        return t, ids, counts, context, before

    def shards(self, context: np.ndarray, word: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        x = np.where(frequent, mixed(context) ^ mixed(word + 1), mixed(context))
        return (mixed(x) % _U(self.m["shards"])).astype(np.int64)

    def pairs(self, context: np.ndarray, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
        """For known contexts: shard and place of the pair (-1: not seen), its share, and the successors of its context.
        Each different pair is searched once."""
        word = np.where(word < 0, self.m["words"] + 1, word)
        order = np.argsort(context * self.width + word)
        c, w, b = context[order], word[order], before[order]
        new = np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])])[: len(c)]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        c, w, b = c[new], w[new], b[new]
        shard = self.shards(c, w, b > self.m["hot"])
        at, share, n = np.full(len(c), -1, np.int64), np.zeros(len(c)), np.zeros(len(c), np.int64)
        for s, here in _groups(shard):
            if level := self.level("pairs", s):
                at[here], share[here], n[here], _ = level.find(c[here], w[here])
        if len(spread := self.m["spread"][0]):
            k = np.minimum(np.searchsorted(spread, c), len(spread) - 1)
            often = spread[k] == c
            n[often] = self.m["spread"][1][k[often]]
        return shard[which], at[which], share[which], n[which]

    def codes(self, shard: np.ndarray, at: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shard and code of the context of triples whose pair is at a place of a shard, and the number of the context
        among the frequent ones or -1."""
        names = self.m["hot_pairs"][0]
        if not len(names):
            return shard, at, np.full(len(at), -1, np.int64)
        name = (shard << 32) | at
        k = np.minimum(np.searchsorted(names, name), len(names) - 1)
        often = names[k] == name
        dealt = (mixed(mixed(name) ^ mixed(word + 1)) % _U(self.m["shards"])).astype(np.int64)
        return np.where(often, dealt, shard), np.where(often, _SPREAD + k, at), np.where(often, k, -1)

    def triples(self, shard: np.ndarray, at: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For seen pairs and the word after them: its share and what the discount left to the pair."""
        word = np.where(word < 0, self.m["words"] + 1, word)
        shard, code, often = self.codes(shard, at, word)
        share, rest = np.zeros(len(code)), np.ones(len(code))
        for s, here in _groups(shard):
            here = here[np.argsort(code[here] * self.width + word[here])]
            if level := self.level("triples", s):
                _, share[here], n, left = level.find(code[here], word[here])
                rest[here] = np.where(n > 0, left, 1.0)
        hot = np.flatnonzero(often >= 0)
        rest[hot] = self.m["hot_pairs"][1][often[hot]]
        return share, rest


@lru_cache(1)
def _trie(folder: str, stage: str, model) -> Trie:
    return Trie(model.value)


def fit(texts: DataFrame, folder: str | None = None) -> dict:
    """Train on the column text; returns the description of the files: a number per shard and frequent context."""
    folder = local(folder or f"{shared_dir(texts.sparkSession)}/trie-{uuid.uuid4().hex}")
    os.makedirs(folder, exist_ok=True)
    texts = small_batches(texts).select("text")
    context = texts.sparkSession.sparkContext
    total = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) / 6 + 1), F.count("*")).first()
    size = int(total[0] or 1)
    bits = max(0, int(size / (4 * SHARD)).bit_length())  # some words repeat: fewer shards than of pairs
    model: dict = {"folder": folder, "bits": bits, "shards": 1 + int(size / SHARD), "documents": total[1], "sizes": [0] * (1 << bits)}

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer()
        for batch in batches:
            h = Tokens(batch.column("text")).flat
            yield from dealer.add(h, h >> _U(64 - bits) if bits else np.zeros(len(h), _U))
        yield from dealer.flush()

    def build_words(key: tuple, group: pa.Table) -> pa.Table:
        hashes, counts = _gathered(group)
        universe = 1 << (64 - bits)
        kind = np.uint32 if counts.max(initial=0) < 1 << 32 else np.uint64
        save(f"{folder}/words-{key[0].as_py()}", encode("words", hashes & _U(universe - 1), universe) | {"counts": counts.astype(kind)})
        return _done([(key[0].as_py(), len(hashes), counts.sum(), None, None, None)])

    rows = texts.mapInArrow(count_words, _DEALT_SQL).groupBy("shard").applyInArrow(build_words, _DONE_SQL).collect()  # one row per shard
    for r in rows:
        model["sizes"][r["shard"]] = r["entries"]
    model["tokens"], model["words"] = sum(r["tokens"] for r in rows), sum(model["sizes"])
    model["hot"] = max(HOT, model["tokens"] // 10_000)
    none = np.empty(0, np.int64)
    model["spread"], model["hot_pairs"] = (none, none), (none, none)
    first, width = context.broadcast(dict(model)), model["words"] + 2

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, dealer = _trie(folder, "words", first), _Dealer()
        for batch in batches:
            _, ids, _, before, n = trie.read(batch.column("text"))
            yield from dealer.add(before.astype(_U) * _U(width) + ids.astype(_U), trie.shards(before, ids, n > trie.m["hot"]))
        yield from dealer.flush()

    def build_pairs(key: tuple, group: pa.Table) -> pa.Table:
        trie, s = _trie(folder, "words", first), key[0].as_py()
        keys, counts = _gathered(group)
        arrays, contexts, pointers, totals = _level_arrays(keys, counts, lambda c, _: trie.totals(c), width, width)
        save(f"{folder}/pairs-{s}", arrays)
        spread = [(None, None, None, int(contexts[i]), int(pointers[i + 1] - pointers[i]), None) for i in np.flatnonzero(totals > trie.m["hot"])]
        often = [(s, None, None, int(i), None, int(counts[i])) for i in np.flatnonzero(counts > trie.m["hot"])]
        return _done([(s, len(keys), counts.sum(), None, None, None), *spread, *often])

    def built(counted: DataFrame, build) -> list:
        """One row for each shard, and for each of the few contexts that all shards share."""
        found = counted.groupBy("shard").applyInArrow(build, _DONE_SQL).where("context is not null")
        return found.groupBy("shard", "context").agg(F.sum("successors").alias("successors"), F.max("total").alias("total")).collect()

    rows = built(texts.mapInArrow(count_pairs, _DEALT_SQL), build_pairs)
    spread = sorted((r["context"], r["successors"]) for r in rows if r["total"] is None)
    often = sorted(((r["shard"] << 32) | r["context"], r["total"]) for r in rows if r["total"] is not None)
    model["spread"] = tuple(np.array([r[k] for r in spread], np.int64) for k in (0, 1))
    model["hot_pairs"] = tuple(np.array([r[k] for r in often], np.int64) for k in (0, 1))
    second = context.broadcast(dict(model))

    def count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, dealer = _trie(folder, "pairs", second), _Dealer()
        for batch in batches:
            t, ids, _, before, n = trie.read(batch.column("text"))
            shard, at, _, _ = trie.pairs(before, ids, n)
            after = np.ones(len(ids), bool)
            after[t.starts] = False
            after = np.flatnonzero(after)
            shard, code, _ = trie.codes(shard[after - 1], at[after - 1], ids[after])
            yield from dealer.add(code.astype(_U) * _U(width) + ids[after].astype(_U), shard)
        yield from dealer.flush()

    def build_triples(key: tuple, group: pa.Table) -> pa.Table:
        trie, s = _trie(folder, "pairs", second), key[0].as_py()
        keys, counts = _gathered(group)
        known = trie.m["hot_pairs"][1]
        totals = lambda c, own: np.where(c < _SPREAD, own, known[np.clip(c - _SPREAD, 0, len(known) - 1)]) if len(known) else own
        arrays, contexts, pointers, all_ = _level_arrays(keys, counts, totals, int(keys[-1]) // width + 1, width)
        n = np.diff(pointers)
        code, levels = _quantised(np.log10(DISCOUNT * n / all_))
        save(f"{folder}/triples-{s}", arrays | {"rest": code, "rest_levels": levels})
        often = [(None, None, None, int(contexts[i]) - _SPREAD, int(n[i]), None) for i in np.flatnonzero(contexts >= _SPREAD)]
        return _done([(s, len(keys), counts.sum(), None, None, None), *often])

    rows = built(texts.mapInArrow(count_triples, _DEALT_SQL), build_triples)
    names, totals = model["hot_pairs"]
    left = np.ones(len(names))
    for r in rows:
        left[r["context"]] = DISCOUNT * r["successors"] / totals[r["context"]]
    model["hot_pairs"] = names, left
    return model


def score(docs: DataFrame, model: dict) -> DataFrame:
    """Rows doc_id, n_tokens, n_known, base_score, score (log10) for doc_id and text."""
    sent = small_batches(docs).sparkSession.sparkContext.broadcast(model)
    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        trie = _trie(m["folder"], "score", sent)
        for batch in batches:
            if not batch.num_rows:
                continue
            t, ids, counts, context, before = trie.read(batch.column("text"))
            base = (counts + SMOOTH) / (m["tokens"] + SMOOTH * (m["words"] + 1))
            p = base.copy()
            after = np.flatnonzero((context >= 0) & (before > 0))
            shard, at = np.zeros(len(ids), np.int64), np.full(len(ids), -1, np.int64)
            shard[after], at[after], share, n = trie.pairs(context[after], ids[after], before[after])
            p[after] = share + DISCOUNT * n / before[after] * base[after]
            pair, first = np.roll(at, 1), np.roll(shard, 1)
            pair[t.starts] = -1
            after = np.flatnonzero(pair >= 0)
            share, rest = trie.triples(first[after], pair[after], ids[after])
            p[after] = share + rest * p[after]
            sums = [np.add.reduceat(x, t.starts) for x in (np.log10(base), np.log10(p))]
            known = np.add.reduceat((counts > 0).astype(np.int64), t.starts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (t.lengths, known, *sums))], schema=out)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
