"""Exact nearest vectors by inner product, by a three-phase uniform threshold over lists of partial scores.

The dimensions are cut into `lists` slices. A slice's table is a list of its own: for a query it orders all candidates by
their partial scores, and a task sees one slice of some candidates only. A score is the sum of a candidate's entries in all lists.

1. Each list gives its k best entries of each query; the scores of what is on any of these lists are looked up, and the
   k-th best of them is a bound: a safe cutoff, as the answer's k-th score cannot be less.
2. The cutoff goes to every list with its query, and a list gives all entries of at least cutoff / lists. A candidate that
   no list gives has a sum below the cutoff. Entries in all lists are scores, whose k-th best raises the bound; the others
   are dropped if cutoff / lists for each missing entry does not lift them to it.
3. The missing scores of those that are left are looked up.

Queries meet candidates in blocks: packed groups of queries of bounded size, each with every packed chunk of candidates,
spread over tasks. The work is their product, as that of any exact search is. Equal vectors are one candidate, of which
the k + 1 least rows are kept, and one query.

Entries become whole numbers; scores are exact, in doubles where sums stay below 2**53, else in integers. Vectors that are null or
empty, or hold a null, NaN or infinite entry, or one beyond RANGE, take no part. Vectors of different lengths do not
meet. A query's own row is no candidate, but other rows with its id or its vector are. Ties go to the smaller id, null ids
first, then to any row. A query with fewer candidates than k gets all; without one it has no rows. Other columns are not
read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from augury.llm.common import small_batches, written

NEAREST, SCALE, LISTS = 10, 1024, 2
#: Entries at or beyond it count as not finite.
RANGE = 2.0**42
#: Queries of a packed group, on average, and tasks to each core.
GROUP, SPREAD = 1024, 2


def whole(vector: Column) -> Column:
    """floor(SCALE * c) of each entry; null for a vector that takes no part."""
    wide = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall(wide, lambda c: F.coalesce(F.abs(c) < RANGE, F.lit(False)))  # NaN is larger than any number
    return F.when((F.size(vector) > 0) & fine, F.transform(wide, lambda c: F.floor(c * SCALE)))


def _nodes(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors (node, h, g, x, size, members, asked) of rows (at, id, x, asks): members are the k + 1 least rows."""
    key = ["h", "g", "x"]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("id").asc_nulls_first(), "at"))
    least = rows.select(*key, "id", "at", place.alias("place")).where(F.col("place") <= k + 1)
    once = least.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("place", "id", "at"))).alias("members"))
    asked = rows.where("asks").select(*key).distinct().withColumn("asked", F.lit(True))
    return once.join(asked, key, "left").select(F.monotonically_increasing_id().alias("node"), *key, F.size("x").alias("size"), "members", F.coalesce("asked", F.lit(False)).alias("asked"))


def _slices(size: int, lists: int) -> list[tuple[int, int]]:
    return [(size * b // lists, size * (b + 1) // lists) for b in range(lists)]


def _chunks(nodes: DataFrame, lists: int, groups: int, buckets: int) -> DataFrame:
    """Candidates packed in the tasks that read them: one row for a list, chunk and group of queries."""
    out = pa.schema([("size", pa.int32()), ("list", pa.int32()), ("nodes", pa.binary()), ("parts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids = batch.column("size").to_numpy(), batch.column("node").to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = batch.column("x").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
                for b, (lo, hi) in enumerate(_slices(int(size), lists)):
                    yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([b], pa.int32()), pa.array([ids[at].tobytes()]), pa.array([np.ascontiguousarray(x[:, lo:hi]).tobytes()])], schema=out)

    packed = small_batches(nodes.select("node", "size", "x")).mapInArrow(run, "size int, list int, nodes binary, parts binary")
    packed = packed.withColumn("bucket", F.pmod(F.xxhash64("nodes"), F.lit(buckets)))
    return packed.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")))


def _asking(nodes: DataFrame, cutoffs: DataFrame | None, lists: int, groups: int, buckets: int) -> DataFrame:
    """Queries packed by group and list, with their cutoffs, once for each bucket of candidates."""
    asked = nodes.where("asked").select("node", "x", "size")
    asked = asked.withColumn("cutoff", F.lit(None).cast("long")) if cutoffs is None else asked.join(cutoffs, "node", "left")
    edge = lambda b: F.floor(F.col("size") * b / lists).cast("int")
    parts = F.array(*[F.struct(F.lit(b).alias("list"), F.slice("x", edge(b) + 1, edge(b + 1) - edge(b)).alias("part")) for b in range(lists)])
    each = asked.select("node", "size", "cutoff", F.pmod(F.xxhash64("node"), F.lit(groups)).alias("group"), F.inline(parts))
    packed = each.groupBy("size", "list", "group").agg(F.collect_list(F.struct("node", "cutoff", "part")).alias("asks"))
    return packed.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<bigint>")))


def _partial(asks: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Exact partial scores, queries x candidates."""
    most = int(np.abs(asks).max(initial=0)) * int(np.abs(parts).max(initial=0)) * max(1, asks.shape[1])
    if most < 2**53:
        return (asks.astype(np.float64) @ parts.astype(np.float64).T).astype(np.int64)
    return asks @ parts.T


def _lists(asking: DataFrame, chunks: DataFrame, give: Callable) -> DataFrame:
    """Entries (node, list, other, s) that `give` takes from each meeting of a group with a chunk.

    give(key, nodes, cutoffs, others, partial scores) yields (row numbers of nodes, others, scores), and with None as key what it holds.
    """
    out = pa.schema([("node", pa.int64()), ("list", pa.int32()), ("other", pa.int64()), ("s", pa.int64())])

    def shown(key: tuple, nodes: np.ndarray, others: np.ndarray, s: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(s), 100_000):
            part = [pa.array(c[a : a + 100_000]) for c in (nodes, others, s)]
            yield pa.RecordBatch.from_arrays([part[0], pa.array(np.full(len(part[0]), key[1], np.int32)), part[1], part[2]], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for i in range(batch.num_rows):
                key = tuple(batch.column(c)[i].as_py() for c in ("size", "list", "group"))
                asks = batch.column("asks")[i].values
                nodes, width = asks.field("node").to_numpy(), len(asks.field("part").flatten()) // len(asks)
                x = asks.field("part").flatten().to_numpy(zero_copy_only=False).reshape(len(asks), width)
                others = np.frombuffer(batch.column("nodes")[i].as_buffer(), np.int64)
                parts = np.frombuffer(batch.column("parts")[i].as_buffer(), np.int64).reshape(len(others), width) if width else np.zeros((len(others), 0), np.int64)
                for found in give(held, key, nodes, asks.field("cutoff"), others, _partial(x, parts)):
                    yield from shown(*found)
        for found in give(held, None, None, None, None, None):
            yield from shown(*found)

    joined = chunks.join(asking, ["size", "list", "group", "bucket"]).select("size", "list", "group", "asks", "nodes", "parts")
    return small_batches(joined).mapInArrow(run, "node long, list int, other long, s long")


def _best(k: int, most_held: int = 32):
    """Phase 1: the k best entries of each query, kept over the chunks that a task sees."""

    def give(held: dict, key, nodes, _, others, s):
        if key is not None:
            if s.shape[1] > k:
                at = np.argpartition(s, s.shape[1] - k, axis=1)[:, -k:]
                others, s = others[at], np.take_along_axis(s, at, axis=1)
            else:
                others = np.broadcast_to(others, s.shape)
            if key in held:
                _, before, scores = held[key]
                others, s = np.hstack([before, others]), np.hstack([scores, s])
                if s.shape[1] > k:
                    at = np.argpartition(s, s.shape[1] - k, axis=1)[:, -k:]
                    others, s = np.take_along_axis(others, at, axis=1), np.take_along_axis(s, at, axis=1)
            held[key] = nodes, others, s
        if key is None or len(held) > most_held:
            for done, (n, o, s) in held.items():
                yield done, np.repeat(n, s.shape[1]), o.ravel(), s.ravel()
            held.clear()

    return give


def _over(lists: int):
    """Phase 2: every entry of at least cutoff / lists."""

    def give(held: dict, key, nodes, cutoffs, others, s):
        if key is not None:
            least = -(-cutoffs.fill_null(0).to_numpy() // lists)  # rounded up: entries are whole
            least[cutoffs.is_null().to_numpy(zero_copy_only=False)] = np.iinfo(np.int64).min
            i, j = np.nonzero(s >= least[:, None])
            yield key, nodes[i], others[j], s[i, j]

    return give


def _looked_up(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """pairs (node, other) with their scores."""
    x = nodes.select("node", "x")
    both = pairs.join(x, "node").join(x.select(F.col("node").alias("other"), F.col("x").alias("y")), "other")
    score = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, p: s + p)
    return both.select("node", "other", score.alias("score"))


def _kth(scored: DataFrame, k: int, name: str) -> DataFrame:
    """The k-th best score by node; nodes with fewer have no row."""
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score")))
    return scored.select("node", "score", place.alias("place")).where(F.col("place") <= k).where(F.col("place") == k).select("node", F.col("score").alias(name))


def nearest(rows: DataFrame, queries: Column, k: int = NEAREST, lists: int = LISTS, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Columns query_id, rank, vec_id, score: the k best rows of each row for which `queries` holds.

    Scores are 64-bit: a table in which a sum of products could pass them is refused with an error.
    """
    spark = rows.sparkSession
    x = whole(F.col(f"`{vector}`"))
    base = rows.select(F.col(f"`{id}`").alias("id"), F.coalesce(queries, F.lit(False)).alias("asks"), x.alias("x")).where("x is not null")
    base = written(base.select(F.monotonically_increasing_id().alias("at"), "id", "asks", "x", F.xxhash64("x").alias("h"), F.hash("x").alias("g")), "vectors")
    nodes = written(_nodes(base, k), "nodes")
    top = nodes.agg(F.max(F.aggregate("x", F.lit(0).cast("long"), lambda m, c: F.greatest(m, F.abs(c)))), F.max("size"), F.count_if("asked")).first()
    if top[0] is not None and top[0] ** 2 * top[1] >= 2**63:
        raise ValueError(f"scores of entries up to {top[0]} in {top[1]} dimensions may pass 64 bits")
    wanted = k + 1  # vectors: a query's own may have no row but the query
    groups = max(1, -(-top[2] // GROUP))
    buckets = max(1, -(-SPREAD * spark.sparkContext.defaultParallelism // (groups * lists)))
    chunks = _chunks(nodes, lists, groups, buckets)
    # Phase 1
    entries = _lists(_asking(nodes, None, lists, groups, buckets), chunks, _best(wanted))
    place = F.row_number().over(Window.partitionBy("node", "list").orderBy(F.desc("s"), "other"))
    seen = entries.withColumn("place", place).where(F.col("place") <= wanted).select("node", "other").distinct()
    cutoffs = written(_kth(_looked_up(seen, nodes), wanted, "cutoff"), "cutoffs")
    # Phase 2
    over = _lists(_asking(nodes, cutoffs, lists, groups, buckets), chunks, _over(lists))
    sums = written(over.groupBy("node", "other").agg(F.sum("s").alias("known"), F.count("*").alias("n")), "sums")
    whole_sums = sums.where(F.col("n") == lists).select("node", "other", F.col("known").alias("score"))
    raised = cutoffs.join(_kth(whole_sums, wanted, "kth"), "node", "left").select("node", "cutoff", F.greatest("cutoff", "kth").alias("bound"))
    raised = written(raised, "bounds")
    # Phase 3
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    reach = (wide("known") * lists + (lists - F.col("n")) * wide("cutoff")) > wide("bound") * lists
    open_pairs = sums.where(F.col("n") < lists).join(raised, "node").where(reach).select("node", "other")
    scored = whole_sums.unionByName(_looked_up(open_pairs, nodes)).join(raised, "node", "left").where(F.col("bound").isNull() | (F.col("score") >= F.col("bound")))
    # From vectors to rows: of vectors with equal scores those with the least ids come first.
    members = nodes.select(F.col("node").alias("other"), "members")
    first = [F.desc("score"), F.get("members", F.lit(0))["id"].asc_nulls_first()]
    order = Window.partitionBy("node").orderBy(*first)
    best = scored.join(members, "other").withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted).select("node", "score", "members")
    asking = base.where("asks").select(F.col("id").alias("query_id"), F.col("at").alias("own"), "h", "g", "x").join(nodes.select("h", "g", "x", "node"), ["h", "g", "x"]).select("query_id", "own", "node")
    pairs = asking.join(best, "node").select("query_id", "own", "score", F.explode("members").alias("m")).where(F.col("m.at") != F.col("own"))
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("score"), F.col("m.id").asc_nulls_first(), F.col("m.at")))
    out = pairs.withColumn("rank", rank).where(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("m.id").alias("vec_id"), "score")
