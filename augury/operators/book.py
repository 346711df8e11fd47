"""Order books: a book at a cut is the last write of each price since the newest reset that covers its asset.

Events have pos (total order), market, asset (null where the scope is the market), kind (RESET: whole market, SNAPSHOT:
one asset, CHANGE, GAP: the market's books are no longer ready) and levels, an array of (asset, side, price, size).
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from augury.operators import tables
from augury.sources.shared import written

TOP_PRICE = 100
#: Level rows that a task of cut_hashes() is given; a market is never divided.
TASK_ROWS = 100_000


def book_levels(events: DataFrame, top_price: int = TOP_PRICE) -> tuple[DataFrame, DataFrame]:
    """(level rows, rejected events): one bad level rejects its whole event, as does a price that a snapshot repeats."""
    bad = F.exists("levels", lambda x: F.coalesce(~x["side"].isin("BUY", "SELL") | ~x["price"].between(0, top_price) | (x["size"] < 0), F.lit(True)))
    keys = F.transform("levels", lambda x: F.concat_ws(":", x["asset"].cast("string"), x["side"], x["price"].cast("string")))
    twice = F.col("kind").isin("RESET", "SNAPSHOT") & (F.size(F.array_distinct(keys)) < F.size("levels"))
    reason = F.when(bad, "invalid level").when(twice, "duplicate snapshot price").when((F.col("kind") == "CHANGE") & (F.size("levels") == 0), "empty change")
    good, rejected = tables.split(events.withColumn("reason", reason))
    # A reset with an empty ladder is legal, so every control event keeps a header row (idx -1).
    headers = good.where("kind <> 'CHANGE'").select("pos", F.lit(-1).alias("idx"), "market", "asset", "kind", F.lit(None).cast("string").alias("side"), F.lit(None).cast("long").alias("price"), F.lit(None).cast("long").alias("size"))
    rows = good.where("kind <> 'GAP'").select("pos", F.posexplode("levels").alias("idx", "x"), "market", "kind")
    rows = rows.select("pos", "idx", "market", F.col("x.asset").alias("asset"), "kind", F.col("x.side").alias("side"), F.col("x.price").cast("long").alias("price"), F.col("x.size").cast("long").alias("size"))
    return headers.unionByName(rows), rejected


def applied(levels: DataFrame) -> DataFrame:
    """Level rows that take effect, with `base` (position of the reset they build on) and the control rows of each
    asset (idx -1, ready or not). A change group that touches an asset without a ready book has no effect."""
    levels = levels.repartition("market")  # serves every join, window and sum of a market below, and those of the callers
    assets = levels.where("asset is not null").select("market", "asset").distinct()
    control = levels.where("idx = -1").select("pos", "idx", "market", F.col("asset").alias("__scope"), "kind")
    control = control.join(assets, "market").where("__scope is null or __scope = asset").select("pos", "idx", "market", "asset", "kind", *[F.lit(None).cast(t).alias(c) for c, t in (("side", "string"), ("price", "long"), ("size", "long"))])
    rows = control.unionByName(levels.where("idx >= 0"))
    w = Window.partitionBy("market", "asset").orderBy("pos", "idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("base", F.last(F.when((F.col("idx") == -1) & F.col("kind").isin("RESET", "SNAPSHOT"), F.col("pos")), ignorenulls=True).over(w))
    rows = rows.withColumn("ready", F.coalesce(F.last(F.when(F.col("idx") == -1, F.col("kind") != "GAP"), ignorenulls=True).over(w), F.lit(False)))
    group = Window.partitionBy("market", "pos")
    rows = rows.withColumn("__all", F.min(F.when(F.col("idx") >= 0, F.col("ready"))).over(group))
    return rows.where("idx = -1 or __all").drop("__all")


def book_at_cut(rows: DataFrame, cut: int) -> DataFrame:
    """Full ladders (market, asset, side, price, size, ready) from applied() rows up to the cut."""
    upto = rows.where(F.col("pos") <= cut)
    state = upto.groupBy("market", "asset").agg(F.max("base").alias("base"), F.max_by("ready", F.struct("pos", "idx")).alias("ready"))
    live = upto.where("idx >= 0").drop("ready").join(state, ["market", "asset", "base"])
    last = live.groupBy("market", "asset", "side", "price").agg(F.max_by("size", F.struct("pos", "idx")).alias("size"), F.first("ready").alias("ready"))
    return last.where("size > 0").select("market", "asset", "side", "price", "size", "ready")


def bbo(book: DataFrame, keys: tuple[str, ...] = ("market", "asset")) -> DataFrame:
    """Best bid and ask, numbers of levels, and whether they cross."""
    bid, ask = F.col("side") == "BUY", F.col("side") == "SELL"
    out = book.groupBy(*keys).agg(
        F.max(F.when(bid, F.col("price"))).alias("best_bid"), F.min(F.when(ask, F.col("price"))).alias("best_ask"), F.count_if(bid).alias("bid_levels"), F.count_if(ask).alias("ask_levels"),
    )
    return out.withColumn("crossed", F.coalesce(F.col("best_bid") >= F.col("best_ask"), F.lit(False)))


def depth_view(book: DataFrame, k: int = 12) -> DataFrame:
    """The best k levels of each side in order, with best prices first."""
    order = F.when(F.col("side") == "BUY", -F.col("price")).otherwise(F.col("price"))
    return tables.top_per(book, ["market", "asset", "side"], [order], k)


def book_digest(book: DataFrame) -> DataFrame:
    """One digest of the whole book of each market, the same for equal books."""
    level = F.concat_ws(":", F.col("asset").cast("string"), "side", F.col("price").cast("string"), F.col("size").cast("string"))
    return book.groupBy("market").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(level)), ","), 256).alias("digest"))


def level_intervals(rows: DataFrame) -> DataFrame:
    """Level rows with the positions [pos, until) in which their size stands, within the reset they build on."""
    level = Window.partitionBy("market", "asset", "side", "price", "base").orderBy("pos", "idx")
    # The next reset of the asset, from a walk backwards: no join of resets, so rows stay where their market is.
    later = Window.partitionBy("market", "asset").orderBy(F.desc("pos"), F.desc("idx")).rowsBetween(Window.unboundedPreceding, -1)
    ends = F.last(F.when((F.col("idx") == -1) & (F.col("kind") != "GAP"), F.col("pos")), ignorenulls=True).over(later)
    out = rows.withColumn("__end", ends).where("idx >= 0").withColumn("__next", F.lead("pos").over(level))
    out = out.withColumn("until", F.coalesce("__next", "__end", F.lit(2**62)))
    return out.where("size > 0 and pos < until").select("market", "asset", "side", "price", "size", "base", "pos", "until")


def bbo_by_intervals(rows: DataFrame) -> DataFrame:
    """Best prices after each event that touched an asset, by joining positions with level intervals of one reset: every
    moment of a reset meets every interval of it. For checks of bbo_timeline()."""
    moments = rows.where("base is not null").select("market", "asset", "base", F.col("pos").alias("moment")).distinct()
    spans = level_intervals(rows)
    found = moments.join(spans, ["market", "asset", "base"], "left").where("pos is null or (pos <= moment and moment < until)")
    best = found.groupBy("market", "asset", "moment").agg(F.max(F.when(F.col("side") == "BUY", F.col("price"))).alias("best_bid"), F.min(F.when(F.col("side") == "SELL", F.col("price"))).alias("best_ask"))
    # A moment at which no level stands has an empty book.
    return moments.select("market", "asset", "moment").join(best, ["market", "asset", "moment"], "left")


class Ladder:
    """One side of a book with its best price. Prices wait in a heap; those without size are dropped as they come up."""

    def __init__(self, best: int):
        self.sizes: dict[int, int] = {}
        self._heap: list[int] = []
        self._sign = -best

    def put(self, price: int, size: int) -> None:
        if size <= 0:
            self.sizes.pop(price, None)
            return
        if price not in self.sizes:
            heappush(self._heap, self._sign * price)
        self.sizes[price] = size

    def best(self) -> int | None:
        while self._heap and self._sign * self._heap[0] not in self.sizes:
            heappop(self._heap)
        return self._sign * self._heap[0] if self._heap else None


def _standing(own: np.ndarray, price: np.ndarray, size: np.ndarray, group: np.ndarray, carried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """After each row, by price: whether a level stands there, from the last write of the price within the row's group.

    own: rows that write this side; group: row number at which each row's group starts, -1 for the group that goes on
    from the rows before, whose sizes are `carried`. Returns also the sizes to carry on.
    """
    last = np.full((len(own), len(carried)), -1, np.int32)
    at = np.flatnonzero(own)
    last[at, price[at]] = at
    np.maximum.accumulate(last, axis=0, out=last)
    inside = last >= np.maximum(group, 0)[:, None]
    sizes = np.where(inside, size[last], np.where(group[:, None] < 0, carried, 0))
    return sizes > 0, sizes[-1]


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best prices at the end of each position, over rows sorted by (market, asset, base, pos, idx): whole batches at a time
    over the slots of all prices. Only the sizes of the reset at hand are kept between batches."""
    names = ["market", "asset", "base", "pos"]
    carried = {s: np.zeros(TOP_PRICE + 1, np.int64) for s in ("BUY", "SELL")}
    before, waiting = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in names])
        side = batch.column("side").to_numpy(zero_copy_only=False)
        level = batch.column("idx").to_numpy() >= 0
        price, size = (np.where(level, pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False), 0).astype(np.int64) for c in ("price", "size"))
        opens = np.ones(keys.shape[1], bool)
        opens[1:] = (keys[:3, 1:] != keys[:3, :-1]).any(axis=0)
        opens[0] = before is None or (keys[:3, 0] != before[:3]).any()
        group = np.maximum.accumulate(np.where(opens, np.arange(len(opens)), -1))
        best = {}
        for name, pick in (("BUY", lambda up: TOP_PRICE - np.argmax(up[:, ::-1], axis=1)), ("SELL", lambda up: np.argmax(up, axis=1))):
            up, carried[name] = _standing(level & (side == name), price, size, group, carried[name])
            best[name] = np.where(up.any(axis=1), pick(up), -1)
        ends = np.append((keys[:, 1:] != keys[:, :-1]).any(axis=0), True)
        found = np.stack([keys[0], keys[1], keys[3], best["BUY"], best["SELL"]])[:, ends]
        if waiting is not None and (keys[:, 0] != before).any():  # the last position of the batch before was complete
            found = np.column_stack([waiting, found])
        before, waiting = keys[:, -1], found[:, -1]
        yield _moments(found[:, :-1])
    if waiting is not None:
        yield _moments(waiting[:, None])


def _moments(rows: np.ndarray) -> pa.RecordBatch:
    best = [pa.array(c, mask=c < 0) for c in rows[3:]]
    return pa.RecordBatch.from_arrays([*map(pa.array, rows[:3]), *best], ["market", "asset", "moment", "best_bid", "best_ask"])


def bbo_timeline(rows: DataFrame) -> DataFrame:
    """Best prices after each event that touched an asset: one sweep over the sorted rows of each reset, a batch at a
    time. Resets of a market are dealt to different tasks, so its history is cut at them."""
    sorted_ = rows.where("base is not null").select("market", "asset", "base", "pos", "idx", "side", "price", "size").repartition("market", "asset", "base").sortWithinPartitions("market", "asset", "base", "pos", "idx")
    return sorted_.mapInArrow(_swept, "market long, asset long, moment long, best_bid long, best_ask long")


def compare_cuts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per market: moments of two timelines, and those at which their best prices differ or one of them is missing."""
    tag = lambda df, n: df.select("market", "asset", "moment", F.struct("best_bid", "best_ask").alias(n))
    both = tag(a, "__a").join(tag(b, "__b"), ["market", "asset", "moment"], "full_outer")
    return both.groupBy("market").agg(F.count("*").alias("moments"), F.count_if(~F.col("__a").eqNullSafe(F.col("__b"))).alias("differing"))


def native_check(claims: DataFrame, timeline: DataFrame) -> DataFrame:
    """Best prices that messages declare (market, asset, pos, idx, best_bid, best_ask) against the rebuilt ones: the last
    claim of an asset in a message counts, after the whole message."""
    last = tables.latest_by(claims, ["market", "asset", "pos"], ["idx"])
    t = timeline.select("market", "asset", F.col("moment").alias("pos"), F.col("best_bid").alias("__bid"), F.col("best_ask").alias("__ask"), F.lit(True).alias("__there"))
    both = last.join(t, ["market", "asset", "pos"], "left")
    same = F.col("best_bid").eqNullSafe(F.col("__bid")) & F.col("best_ask").eqNullSafe(F.col("__ask"))
    return both.select("market", "asset", "pos", F.when(F.col("__there").isNull(), "NO_BOOK").when(same, "MATCH").otherwise("MISMATCH").alias("result"))


def sequence_tape(events: DataFrame) -> DataFrame:
    """Adds market_seq, prev_market_seq and book_epoch (number of resets so far) of each market."""
    w = Window.partitionBy("market").orderBy("pos")
    out = events.withColumn("market_seq", F.row_number().over(w)).withColumn("prev_market_seq", F.col("market_seq") - 1)
    return out.withColumn("book_epoch", F.sum((F.col("kind") == "RESET").cast("int")).over(w))


def checkpoint(rows: DataFrame, cut: int) -> tuple[DataFrame, DataFrame]:
    """(levels at the cut, markets without any baseline by then)."""
    state = rows.where(F.col("pos") <= cut).groupBy("market").agg(F.max("base").alias("base"))
    return book_at_cut(rows, cut), state.where("base is null").select("market")


def resume(rows: DataFrame, saved: DataFrame, cut: int, end: int) -> DataFrame:
    """The book at `end` from levels saved at the cut and later rows only: what saved holds counts as a reset there."""
    later = rows.where((F.col("pos") > cut) & (F.col("pos") <= end))
    replaced = later.where("idx = -1 and kind <> 'GAP'").groupBy("market", "asset").agg(F.max("pos").alias("__new"))
    old = saved.select("market", "asset", "side", "price", "size", F.lit(cut).cast("long").alias("pos"), F.lit(0).alias("idx"))
    both = old.unionByName(later.where("idx >= 0").select(*old.columns)).join(replaced, ["market", "asset"], "left").where("__new is null or pos >= __new")
    last = both.groupBy("market", "asset", "side", "price").agg(F.max_by("size", F.struct("pos", "idx")).alias("size"))
    return last.where("size > 0")


def compare_depth(before: DataFrame, after: DataFrame, actual: DataFrame) -> DataFrame:
    """Label of each (market, asset): the actual ladder against reference ladders taken before and after it."""
    ladder = lambda df, name: df.groupBy("market", "asset").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "side", F.col("price").cast("string"), F.col("size").cast("string")))), ",").alias(name))
    all_ = ladder(before, "b").join(ladder(after, "a"), ["market", "asset"], "full_outer").join(ladder(actual, "x"), ["market", "asset"], "full_outer")
    label = (
        F.when(F.col("x").isNull(), "NO_BASELINE").when(F.col("b").isNull() | F.col("a").isNull(), "NO_REFERENCE")
        .when((F.col("b") == F.col("a")) & (F.col("x") == F.col("b")), "EXACT_STABLE_BRACKET_MATCH").when(F.col("b") == F.col("a"), "STABLE_MISMATCH")
        .when((F.col("x") == F.col("b")) | (F.col("x") == F.col("a")), "MATCHES_ONE_SIDE").otherwise("REFERENCE_MOVED")
    )
    return all_.select("market", "asset", label.alias("label"))


def _element(text: Column) -> Column:
    """60 bits of a hash of one element of a state, as a number that sums hold exactly."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def cut_hashes(rows: DataFrame) -> DataFrame:
    """The whole state of each market after each of its events, as a hash: market, moment, elements, hash.

    A state is the set of its levels (with sizes) and of the assets that are ready. Its hash is the sum of its elements'
    hashes, so an element is added where its interval begins and taken off where it ends, and a running sum gives every
    cut in one pass over the changes, however deep the books are. Rows are computed once and dealt by market to tasks of
    about TASK_ROWS: by bytes, which compress well, tasks would hold more and more of them.
    """
    rows = written(rows, "rows")
    tasks = rows.count() // TASK_ROWS + 1
    rows = rows.repartition(tasks, "market")
    level = F.concat_ws(":", F.col("asset").cast("string"), "side", F.col("price").cast("string"), F.col("size").cast("string"))
    spans = level_intervals(rows).select("market", level.alias("element"), "pos", "until")
    w = Window.partitionBy("market", "asset").orderBy("pos")
    control = rows.where("idx = -1").select("market", "asset", "pos", "ready").withColumn("until", F.coalesce(F.lead("pos").over(w), F.lit(2**62)))
    ready = control.where("ready").select("market", F.concat(F.col("asset").cast("string"), F.lit(":READY")).alias("element"), "pos", "until")
    both = spans.unionByName(ready).withColumn("h", _element(F.col("element")))
    begins = both.groupBy("market", "pos").agg(F.count("*").alias("n"), F.sum("h").alias("h"))
    ends = both.where(F.col("until") < 2**62).groupBy("market", F.col("until").alias("pos")).agg((-F.count("*")).alias("n"), (-F.sum("h")).alias("h"))
    moments = rows.select("market", "pos", F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("h")).distinct()
    steps = moments.unionByName(begins).unionByName(ends).repartition(tasks, "market").groupBy("market", "pos").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    run = Window.partitionBy("market").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return steps.select("market", F.col("pos").alias("moment"), F.sum("n").over(run).alias("elements"), F.sum("h").over(run).cast("string").alias("hash"))


def side_payloads(tokens: DataFrame, book: DataFrame, evidence: DataFrame, observed_ms: int, k: int = 12, fresh_ms: int = 15_000, lasts_ms: int = 20_000) -> DataFrame:
    """What a reader gets of each token (market, asset): best k levels of each side as text, best prices, spread, and a
    status. A book is live if its source is ready, its transport proven healthy by the fresh-pong policy, and its last
    source time at most fresh_ms before the observation and not after it; else stale, or unavailable if there is none.

    evidence: market, asset, ready, transport_healthy, transport_policy, source_ms.
    """
    best = depth_view(book, k)
    entry = F.struct("place", F.concat_ws(":", F.col("price").cast("string"), F.col("size").cast("string")).alias("x"))
    shown = lambda side, name: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == side, entry))), lambda e: e["x"]), ",").alias(name)
    first = lambda side, name: F.max(F.when((F.col("side") == side) & (F.col("place") == 1), F.col("price"))).alias(name)
    ladders = best.groupBy("market", "asset").agg(shown("BUY", "bids"), shown("SELL", "asks"), first("BUY", "best_bid"), first("SELL", "best_ask"))
    rows = tokens.select("market", "asset").join(ladders, ["market", "asset"], "left").join(evidence.withColumn("__there", F.lit(True)), ["market", "asset"], "left")
    age = F.lit(observed_ms) - F.col("source_ms")
    live = F.coalesce(F.col("ready") & F.col("transport_healthy") & (F.col("transport_policy") == "fresh_pong_rtt_v1") & age.between(0, fresh_ms), F.lit(False))
    status = F.when(live, "live").when(F.col("__there"), "stale").otherwise("unavailable")
    return rows.select(
        "market", "asset", F.coalesce("bids", F.lit("")).alias("bids"), F.coalesce("asks", F.lit("")).alias("asks"), "best_bid", "best_ask", (F.col("best_ask") - F.col("best_bid")).alias("spread"), status.alias("status"),
        "source_ms", F.when(live, F.col("source_ms") + lasts_ms).alias("stale_after_ms"),
    )
