"""Readiness and coverage over time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from augury.operators import tables


def merged(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Union of the intervals (from, to) of each key: islands of what touches or overlaps."""
    order = Window.partitionBy(*keys).orderBy("from", "to")
    before = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("__new", F.coalesce(F.col("from") > before, F.lit(True)).cast("int")).withColumn("__island", F.sum("__new").over(order))
    return marked.groupBy(*keys, "__island").agg(F.min("from").alias("from"), F.max("to").alias("to")).drop("__island")


def interval_coverage(changes: DataFrame, start: int, end: int, plants: int = 2) -> DataFrame:
    """Time of each token within [start, end) with any plant ready and with all plants ready, from readiness changes
    (plant, lane, token, ms, ready, id). A plant is ready where any of its lanes is."""
    spans = tables.intervals(changes, ["plant", "lane", "token"], "ms", "id", "ready", start, end)
    by_plant = merged(spans, ["plant", "token"])
    one = tables.covered(by_plant, ["token"]).withColumnRenamed("covered", "one_plant")
    both = tables.covered(by_plant, ["token"], plants).withColumnRenamed("covered", "all_plants")
    tokens = changes.select("token").distinct()
    return tokens.join(one, "token", "left").join(both, "token", "left").select("token", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("one_plant", "all_plants")])


def select_sources(changes: DataFrame) -> DataFrame:
    """After each change of a token's sources, the one to use: of the ready ones the lowest lane, then the highest
    plant; null for none. Only moments at which the choice changes are returned."""
    points = changes.select("token", "ms", "id").distinct()
    sources = changes.select("token", "plant", "lane").distinct()
    grid = points.join(sources, "token")
    state = grid.join(changes.select("token", "plant", "lane", "id", "ready"), ["token", "plant", "lane", "id"], "left")
    w = Window.partitionBy("token", "plant", "lane").orderBy("ms", "id").rowsBetween(Window.unboundedPreceding, 0)
    state = state.withColumn("ready", F.coalesce(F.last("ready", ignorenulls=True).over(w), F.lit(False)))
    best = state.groupBy("token", "ms", "id").agg(F.min(F.when(F.col("ready"), F.struct("lane", (-F.col("plant")).alias("p")))).alias("s"))
    best = best.select("token", "ms", "id", F.col("s.lane").alias("lane"), (-F.col("s.p")).alias("plant"))
    order = Window.partitionBy("token").orderBy("ms", "id")
    changed = ~(F.lag("lane").over(order).eqNullSafe(F.col("lane")) & F.lag("plant").over(order).eqNullSafe(F.col("plant")))
    return best.withColumn("__c", changed | (F.row_number().over(order) == 1)).where("__c").drop("__c")


def token_lanes(tokens: DataFrame, lanes: DataFrame, states: DataFrame) -> DataFrame:
    """Every desired token on every lane, with all reasons why it does not qualify and the first of them. lanes is a
    table of the few lanes there are."""
    grid = tokens.crossJoin(F.broadcast(lanes))
    rows = grid.join(states, ["token", "lane"], "left")
    ok = lambda c: F.coalesce(F.col(c), F.lit(False))
    why = tables.reasons((ok("assigned"), "NOT_ASSIGNED"), (ok("written"), "NOT_WRITTEN"), (ok("seen"), "NO_BOOK"), (ok("durable"), "NOT_DURABLE"), (ok("ready"), "NOT_READY"))
    rows = rows.withColumn("reasons", why)
    return rows.withColumn("qualified", F.size("reasons") == 0).withColumn("primary_reason", F.get("reasons", 0))


def stage_counters(rows: DataFrame) -> DataFrame:
    """Per lane: how many tokens reached each stage, and how many qualify."""
    return rows.groupBy("lane").agg(F.count("*").alias("tokens"), *[F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in ("assigned", "written", "seen", "durable", "ready", "qualified")])


def market_pairs(rows: DataFrame) -> DataFrame:
    """Per market: lanes on which both its tokens qualify, and whether any or all lanes do."""
    lanes = rows.groupBy("market", "lane").agg((F.count("*") == 2).alias("two"), F.min("qualified").alias("both"))
    return lanes.groupBy("market").agg(F.count_if(F.col("two") & F.col("both")).alias("pairs"), F.max(F.col("two") & F.col("both")).alias("any_lane"), F.min(F.col("two") & F.col("both")).alias("all_lanes"))


def membership(desired: DataFrame, assigned: DataFrame, census: DataFrame, excluded: DataFrame) -> DataFrame:
    """Reason of each id for being in or out, from four id sets (column id)."""
    flag = lambda df, name: df.select("id").distinct().withColumn(name, F.lit(True))
    rows = flag(desired, "d")
    for df, name in ((assigned, "a"), (census, "c"), (excluded, "x")):
        rows = rows.join(flag(df, name), "id", "full_outer")
    d, a, c, x = (F.coalesce(F.col(n), F.lit(False)) for n in "dacx")
    reason = (
        F.when(x & a, "EXCLUDED_BUT_ASSIGNED").when(x, "EXCLUDED").when(d & a, "MATCHED").when(d & c, "NOT_ASSIGNED").when(d, "NOT_IN_CENSUS").when(a, "ASSIGNED_NOT_DESIRED").otherwise("CENSUS_ONLY")
    )
    return rows.select("id", reason.alias("reason"))


def soak_windows(samples: DataFrame, gap: int) -> DataFrame:
    """Unbroken observation windows of each key: a new one starts when the fingerprint changes or after a gap."""
    w = Window.partitionBy("key").orderBy("at", "id")
    new = F.coalesce((F.col("at") - F.lag("at").over(w) > gap) | (F.col("fingerprint") != F.lag("fingerprint").over(w)), F.lit(True))
    marked = samples.withColumn("session", F.sum(new.cast("int")).over(w))
    return marked.groupBy("key", "session").agg(F.min("at").alias("from"), F.max("at").alias("to"), F.count("*").alias("samples"))


def gateway_checks(markets: DataFrame, gateway: DataFrame, plants: DataFrame) -> DataFrame:
    """Each market with all reasons against its gateway: books not ready, no committed source at the same number, a
    session or stream of another plant, or a source beyond what that plant has committed and applied.

    markets: market; gateway: market, ready, crossed, market_seq, source_seq, plant, session, stream, parent_seq,
    parent_offset; plants: plant, market, session, stream, committed_seq, applied_offset.
    """
    p = plants.select("plant", "market", *[F.col(c).alias(f"p_{c}") for c in ("session", "stream", "committed_seq", "applied_offset")])
    rows = markets.select("market").join(gateway, "market", "left").join(p, ["plant", "market"], "left")
    ready = F.coalesce(F.col("ready") & ~F.col("crossed"), F.lit(False))
    source = F.col("source_seq").isNotNull()
    why = tables.reasons(
        (ready, "GATEWAY_PAIR_NOT_READY"), (~ready | (source & (F.col("source_seq") == F.col("market_seq"))), "COMMITTED_SOURCE_EVIDENCE_MISSING"),
        (~source | F.col("session").eqNullSafe(F.col("p_session")), "GATEWAY_SOURCE_SESSION_MISMATCH"),
        (~source | ((F.col("stream") == F.col("p_stream")) & (F.col("parent_seq") <= F.col("p_committed_seq")) & (F.col("parent_offset") <= F.col("p_applied_offset"))), "GATEWAY_PARENT_OUTSIDE_CAPTURED_PLANT_PREFIX"),
    )
    return rows.select("market", ready.alias("ready"), why.alias("reasons"), (F.size(why) == 0).alias("qualified"))


def fleet_health(status: DataFrame) -> DataFrame:
    """Nodes by role: how many, sums of counters, maxima of delays. status: role, node, records, errors, p99_ms, lag."""
    return status.groupBy("role").agg(
        F.count("*").alias("nodes"), F.sum("records").alias("records"), F.sum("errors").alias("errors"), F.max("p99_ms").alias("max_p99_ms"), F.min("p99_ms").alias("min_p99_ms"),
        F.count_if(F.col("p99_ms") > 50).alias("slow_nodes"), F.max("lag").alias("max_lag"),
    )


def storage_rollup(segments: DataFrame) -> DataFrame:
    """Bytes of segments by stream and state, oldest uncommitted time. segments: stream, state, bytes, at."""
    total = lambda s: F.coalesce(F.sum(F.when(F.col("state") == s, F.col("bytes"))), F.lit(0)).alias(s)
    return segments.groupBy("stream").agg(*map(total, ("pending", "committed", "evicted")), F.min(F.when(F.col("state") == "pending", F.col("at"))).alias("oldest_pending"))


def market_coverage(changes: DataFrame, scope: DataFrame, start: int, end: int, plants: int = 2) -> DataFrame:
    """Time within [start, end) by market: of its tokens with any plant and with all plants ready (summed over tokens), and of
    the market with all its tokens ready at once on one lane of any plant, and on one lane of each plant.

    scope has every expected (market, token), which are the denominator whether they were ever seen or not; changes are readiness
    changes (plant, lane, token, ms, ready, id). Tokens that are ready on different lanes or plants make no complete market.
    """
    spans = tables.intervals(changes.join(scope.select("token").distinct(), "token", "left_semi"), ["plant", "lane", "token"], "ms", "id", "ready", start, end)
    by_plant = merged(spans, ["plant", "token"])
    one, all_ = tables.covered(by_plant, ["token"]), tables.covered(by_plant, ["token"], plants)
    tokens = scope.join(one.withColumnRenamed("covered", "one"), "token", "left").join(all_.withColumnRenamed("covered", "all"), "token", "left")
    sums = tokens.groupBy("market").agg(F.count("*").alias("tokens"), F.coalesce(F.sum("one"), F.lit(0)).alias("token_one_plant"), F.coalesce(F.sum("all"), F.lit(0)).alias("token_all_plants"))
    # A lane holds a market while as many of its tokens' intervals are open as the market has tokens.
    sized = spans.join(scope, "token").join(sums.select("market", "tokens"), "market")
    ends = sized.select("market", "plant", "lane", "tokens", F.explode(F.array(F.struct(F.col("from").alias("at"), F.lit(1).alias("d")), F.struct(F.col("to").alias("at"), F.lit(-1).alias("d")))).alias("e"))
    steps = ends.groupBy("market", "plant", "lane", "tokens", "e.at").agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy("market", "plant", "lane").orderBy("at")
    lanes = steps.select("market", "plant", "tokens", F.col("at").alias("from"), F.lead("at").over(w).alias("to"), F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("open")).where("open = tokens")
    complete = merged(lanes.select("market", "plant", "from", "to"), ["market", "plant"])
    pairs = [tables.covered(complete, ["market"], n).withColumnRenamed("covered", c) for n, c in ((1, "market_one_plant"), (plants, "market_all_plants"))]
    out = sums.join(pairs[0], "market", "left").join(pairs[1], "market", "left")
    return out.withColumn("window", F.lit(end - start).cast("long")).fillna(0, ["market_one_plant", "market_all_plants"])


def coverage_summary(by_market: DataFrame) -> DataFrame:
    """One row: expected tokens and markets, the fixed denominators, and the four coverages as shares of them."""
    out = by_market.agg(F.sum("tokens").alias("expected_tokens"), F.count("*").alias("expected_markets"), F.max("window").alias("window"), *[F.sum(c).alias(c) for c in ("token_one_plant", "token_all_plants", "market_one_plant", "market_all_plants")])
    share = lambda c, n: F.when(F.col(n) * F.col("window") > 0, F.col(c) / (F.col(n) * F.col("window"))).alias(f"{c}_share")
    return out.select("expected_tokens", "expected_markets", "window", share("token_one_plant", "expected_tokens"), share("token_all_plants", "expected_tokens"), share("market_one_plant", "expected_markets"), share("market_all_plants", "expected_markets"))


def _chosen(prefer: bool):
    """Sweeps changes sorted by (market, ms, id); of a market only its usable sources and the chosen one are kept."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, usable, now = None, set(), None
        for frame in frames:
            out = []
            for market, ms, id_, lane, shard, good in zip(*(frame[c] for c in ("market", "ms", "id", "lane", "shard", "usable"))):
                if market != at:
                    at, usable, now = market, set(), None
                source = int(lane), -int(shard)
                (usable.add if good else usable.discard)(source)
                if now == source and not good:
                    now = min(usable, default=None)
                    out.append((market, id_, ms, "GAP" if now is None else "RESET", now, "TRANSPORT_UNQUALIFIED"))
                elif good and (now is None or (prefer and lane == 0 and now[0] != 0)):
                    now = min(usable)
                    out.append((market, id_, ms, "RESET", now, "HEALTHY_PRIMARY_READY" if lane == 0 else "HEALTHY_SOURCE_READY"))
            rows = [(m, i, t, k, *((s[0], -s[1]) if s else (None, None)), why) for m, i, t, k, s, why in out]
            yield pd.DataFrame(rows, columns=["market", "id", "ms", "kind", "lane", "shard", "reason"]).astype({"lane": "Int64", "shard": "Int64"})

    return run


def source_events(changes: DataFrame, prefer_primary: bool = True) -> DataFrame:
    """RESET and GAP rows of the source that each market uses, from changes (market, ms, id, lane, shard, usable).

    A source stays until it is no longer usable; then the usable one of the lowest lane and newest shard follows, or a GAP if there
    is none. A market without a source takes the best one as soon as one becomes usable, and with prefer_primary a source
    of lane 0 replaces one of another lane. Sources of a market are few; its changes are one sequence, markets are dealt to tasks.
    """
    dealt = changes.select("market", "ms", "id", "lane", "shard", "usable").repartition("market").sortWithinPartitions("market", "ms", "id")
    return dealt.mapInPandas(_chosen(prefer_primary), "market long, id long, ms long, kind string, lane long, shard long, reason string")
