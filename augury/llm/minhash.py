"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning, exact confirmation, components.

Words are maximal runs of bytes other than space and \\t..\\r after lower-casing A-Z; a document's set holds its
distinct five-word shingles (fewer words: the whole sequence as one; none: empty). Two documents are linked when
100 * |A & B| >= 75 * |A | B|.

Every row is a document. Null or blank text has an empty set and no link. Repeated rows and ties are equal documents
and share a component; a null doc_id takes part, but cannot name a component unless all its ids are null. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.llm.common import components, ranked, remove, small_batches, written
from augury.llm.words import Tokens, changes

SHINGLE, SIMILARITY = 5, 0.75
BANDS, ROWS, BATCH = 32, 4, 16
#: Probability with which one look at a batch of signature values may drop a linked pair.
MISS = 1e-6
_STEP = 2048
#: Most sets, and most shingles about, of a block of nodes that are compared with each other.
_BLOCK, _BLOCK_ITEMS = 256, 1 << 21
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of hashed words."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ words[k : k + n]) * _M[0]
        out ^= out >> np.uint64(29)
    out = (out ^ (out >> np.uint64(32))) * _M[1]
    out = np.sort(out ^ (out >> np.uint64(31)))
    return out[changes(out)]


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The set of each text."""
    t = Tokens(texts)
    return (shingle_set(t.flat[a : a + n - 1], size) for a, n in zip(t.starts, t.lengths))  # without the end


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.random.Generator(np.random.PCG64(20240601)).integers(0, 2**64, (2, n, 1), np.uint64)
    return made[0] | np.uint64(1), made[1]


def signature(hashes: np.ndarray, permutations: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Smallest permuted value of each permutation, its upper 32 bits."""
    a, b = permutations
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _STEP):
        np.minimum(least, (a * hashes[at : at + _STEP] + b).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def least_matches(looks: list[int], similarity: float = SIMILARITY, miss: float = MISS) -> list[int]:
    """For each number of compared values, the fewest matches with which a pair stays.

    With a uniform prior the similarity's posterior after m matches of k is Beta(m+1, k-m+1), whose mass at or above
    s is P(Bin(k+1, s) <= m); a pair goes once that is under the miss probability.
    """
    out = []
    for k in looks:
        mass, m = 0.0, -1
        while mass < miss:
            m += 1
            mass += comb(k + 1, m) * similarity**m * (1 - similarity) ** (k + 1 - m)
        out.append(m)
    return out


def _table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def _signed(texts: DataFrame, size: int, n_perms: int) -> DataFrame:
    out = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perms = _permutations(n_perms)
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for s in shingle_sets(batch.column("text"), size):
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s) if len(s) else None)
                sigs.append(signature(s, perms).tobytes() if len(s) else None)
            yield _table(out, batch.column("doc_id"), batch.column("text_hash"), sizes, keys, sigs)

    return small_batches(texts).select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, "doc_id long, text_hash long, n_shingles long, key binary, sig binary")


def _banded(nodes: DataFrame, bands: int, rows: int) -> DataFrame:
    out = pa.schema([("bucket", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(batch.num_rows, bands, rows).astype(np.uint64)
            h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _M[2], sig.shape[:2]).copy()
            for k in range(rows):
                h = (h ^ sig[:, :, k]) * _M[0]
                h ^= h >> np.uint64(32)
            take = [np.repeat(batch.column(c).to_numpy(), bands) for c in ("node", "n")]
            yield _table(out, h.view(np.int64).ravel(), *take)

    return nodes.select("node", "n", "sig").mapInArrow(run, "bucket long, node long, n long")


def _likely(pairs: DataFrame, nodes: DataFrame, n_perms: int, similarity: float, miss: float) -> DataFrame:
    """Pairs (a, b) that the Bayesian look at one signature batch after another leaves."""
    looks = list(range(BATCH, n_perms + 1, BATCH))
    needed = least_matches(looks, similarity, miss)
    percent = round(100 * similarity)
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, n_perms) for c in ("sig_a", "sig_b"))
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for k, least in zip(looks, needed):
                matches[alive] += (x[alive, k - BATCH : k] == y[alive, k - BATCH : k]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield _table(out, *(batch.column(c).to_numpy()[alive] for c in ("a", "b")))

    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    # Sizes alone rule a pair out if the smaller set is under the similarity's share of the larger one.
    both = both.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Rows (node, members): the full shingle sets of the wanted nodes, as sorted 64-bit hashes."""
    wanted = wanted.select("node").distinct().join(nodes.select("node", "key", F.col("rep").alias("doc_id")), "node")
    texts = docs.select(F.col("doc_id").alias("__id"), "text").join(wanted, F.col("__id").eqNullSafe(F.col("doc_id"))).select("node", "key", "text")
    out = pa.schema([("node", pa.int64()), ("members", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, members = [], []
            for node, key, s in zip(batch.column("node"), batch.column("key"), shingle_sets(batch.column("text"), size)):
                if len(s) and xxhash.xxh3_128_digest(s) == key.as_py():  # not another text under the same id
                    found.append(node.as_py())
                    members.append(s.tobytes())
            yield _table(out, found, members)

    return texts.mapInArrow(sets, "node long, members binary").groupBy("node").agg(F.first("members").alias("members"))


def _confirmed(pairs: DataFrame, full: DataFrame, similarity: float) -> DataFrame:
    """The pairs that full sets confirm."""
    percent = round(100 * similarity)
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield _table(out, *(batch.column(c).to_numpy()[np.array(keep, bool)] for c in ("a", "b")))

    side = lambda c: full.select(F.col("node").alias(c), F.col("members").alias(f"set_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(confirm, "a long, b long")


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of a with each of b."""
    both = [*a, *b]
    values, place, times = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1  # values of one set only are shared with nobody
    column[times == 1] = -1
    column = column[place]
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(a), len(b)), np.float64)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, _STEP):
        at = slice(*np.searchsorted(column, (lo, lo + _STEP)))
        has = np.zeros((len(both), _STEP), np.float32)
        has[row[at], column[at] - lo] = 1
        out += has[: len(a)] @ has[len(a) :].T
    return out


def _spanning(edges: np.ndarray, roots_a: np.ndarray, roots_b: np.ndarray) -> list[int]:
    """Places of edges that suffice to join what all of them join."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    out = []
    for k, (i, j) in enumerate(edges):
        x, y = top(int(roots_a[i])), top(int(roots_b[j]))
        if x != y:
            up[x] = y
            out.append(k)
    return out


def _across(star: DataFrame, first: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, n_perms: int, similarity: float, miss: float) -> DataFrame:
    """Links (a, b) between nodes that share a lead but are still in different components.

    Nodes under a lead are cut by size class (linked sets are in the same or the next class) and then into blocks of
    bounded size; each pair of blocks that holds more than one component is compared in one small group: signature
    batches first, then full sets of what is left. Only links that join components leave the group, so that a lead
    with many nodes makes no pairs.
    """
    looks = list(range(BATCH, n_perms + 1, BATCH))
    needed = least_matches(looks, similarity, miss)
    percent = round(100 * similarity)
    under = star.select(F.col("a").alias("lead"), F.col("b").alias("node")).unionByName(star.select(F.col("a").alias("lead"), F.col("a").alias("node")).distinct())
    under = under.join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Most leads have one component only. Written, so that the join below is dealt by itself and Spark can split a lead.
    mixed = written(under.groupBy("lead").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c")).where("lo < hi and c > 2").select("lead"), "mixed")
    under = written(under.join(mixed, "lead"), "under").join(nodes.select("node", "n"), "node")
    under = under.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / -np.log(similarity)).cast("long"))
    placed = ranked(under, ["lead", "class", "root", "node"])
    begin = placed.groupBy("lead", "class").agg(F.min("rank").alias("begin"))
    per_block = F.greatest(F.lit(1), F.least(F.lit(_BLOCK), F.floor(_BLOCK_ITEMS * F.pow(F.lit(similarity), F.col("class") + 1)).cast("long")))
    placed = written(placed.join(begin, ["lead", "class"]).withColumn("block", F.floor((F.col("rank") - F.col("begin")) / per_block)).select("lead", "class", "block", "node", "root", "n"), "placed")

    blocks = placed.groupBy("lead", "class", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    x, y = (blocks.select("lead", *[F.col(c).alias(f"{c}_{s}") for c in ("class", "block", "lo", "hi")]) for s in "xy")
    ordered = ((F.col("class_x") == F.col("class_y")) & (F.col("block_x") <= F.col("block_y"))) | (F.col("class_y") == F.col("class_x") + 1)
    pairs = x.join(y, "lead").where(ordered & ((F.col("lo_x") != F.col("hi_y")) | (F.col("lo_y") != F.col("hi_x"))))
    pairs = written(pairs.select("lead", "class_x", "block_x", "class_y", "block_y"), "blocks")
    keys = ["lead", "class_x", "block_x", "class_y", "block_y"]
    same = (F.col("class_x") == F.col("class_y")) & (F.col("block_x") == F.col("block_y"))
    sides = pairs.select(*keys, F.col("class_x").alias("class"), F.col("block_x").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.where(~same).select(*keys, F.col("class_y").alias("class"), F.col("block_y").alias("block"), F.lit(1).alias("side"))
    )
    full = _sets(placed, nodes, docs, size).join(nodes.select("node", "sig"), "node")
    members = sides.join(placed, ["lead", "class", "block"]).join(full, "node").select(*keys, "side", "node", "root", "n", "sig", "members")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(group: pa.Table) -> pa.Table:
        side, node, root, n = (group.column(c).to_numpy() for c in ("side", "node", "root", "n"))
        at = [np.flatnonzero(side == 0), np.flatnonzero(side == 1)]
        if not len(at[1]):
            at[1] = at[0]
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(-1, n_perms)
        (a, b), (na, nb), (ra, rb), (sa, sb) = ([v[k] for k in at] for v in (node, n, root, sig))
        na, nb = na[:, None], nb[None, :]
        alive = (ra[:, None] != rb[None, :]) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
        matches = np.zeros(alive.shape, np.int64)
        for k, least in zip(looks, needed):
            if not alive.any():
                break
            for v in range(k - BATCH, k):
                matches += sa[:, v, None] == sb[None, :, v]
            alive &= matches >= least
        edges = np.empty((0, 2), np.int64)
        if alive.any():
            sets = [np.frombuffer(m, np.uint64) for m in group.column("members").to_pylist()]
            both = shared_counts(*([sets[i] for i in k] for k in at))
            edges = np.argwhere(alive & (100 * both >= percent * (na + nb - both)))
            edges = edges[_spanning(edges, ra, rb)]
        return pa.table([pa.array(a[edges[:, 0]]), pa.array(b[edges[:, 1]])], schema=out)

    return members.groupBy(*keys).applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, miss: float = MISS, roots: bool = False) -> DataFrame:
    """One row per row of docs (doc_id long, text string): doc_id, n_shingles, component_id, kept, text_hash; with roots
    also root, which names the component even if none of its ids is set (null: a text without words, its own component).

    Texts with equal sets are one node from the start, so copies never form pairs. In each band bucket every node is
    first held against the bucket's least node, its lead: that is linear in the bucket and joins most groups. Nodes
    that share a lead and are then still in different components are held against each other in small blocks.
    """
    n_perms = bands * rows
    signed = written(_signed(docs, size, n_perms), "signed")
    nodes = written(
        signed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    banded = _banded(nodes, bands, rows)

    leads = banded.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("c")).where("c > 1").select("bucket", "a")
    star = written(banded.join(leads, "bucket").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "star")
    likely = written(_likely(star, nodes, n_perms, similarity, miss), "likely")
    # Written, so that the joins with the leads of many pairs are dealt by themselves and Spark can split a lead.
    full = written(_sets(likely.select(F.explode(F.array("a", "b")).alias("node")), nodes, docs, size), "sets")
    links = written(_confirmed(likely, full, similarity), "links")
    first = written(components(links), "roots")

    links2 = written(_across(star, first, nodes, docs, size, n_perms, similarity, miss), "links")
    final = written(components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links2)), "roots")

    named = nodes.select("key", "node", "rep").join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # In each component the least id; a node without links is its own.
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_key = written(named.join(least, "root").select("key", "component_id", *["root"] * roots), "named")
    for table in (star, likely, full, links, first, links2, final, nodes):
        remove(table)
    out = signed.select("doc_id", "n_shingles", "key", "text_hash").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash", *["root"] * roots)
