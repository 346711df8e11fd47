"""Queries over books, coverage, prices, oracle events and registry, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augury.operators import book, coverage, oracle, prices, tables
from augury.sources import fixtures as fx
from augury.sources import sinks
from augury.streaming import jobs


def whole(df: DataFrame) -> DataFrame:
    """Numbers without nulls, which both engines show alike: -1 stands for none."""
    return df.fillna(-1)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.frame(spark, sf_dir, fx.book_events)
    level = F.struct("asset", "side", F.col("price_c").alias("price"), "size")
    return e.select("pos", "market", F.when(F.col("kind").isin("RESET", "GAP"), F.lit(None)).otherwise(F.col("asset")).alias("asset"), "kind", F.when(F.col("kind") != "GAP", F.array(level)).otherwise(F.array().cast("array<struct<asset: bigint, side: string, price: bigint, size: bigint>>")).alias("levels"))


def _rows(spark, sf_dir):
    return book.applied(book.book_levels(_events(spark, sf_dir))[0])


def _cut(spark, sf_dir, tenths: int) -> int:
    return (spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("event_id")).first()[0] or 0) * tenths // 10


def book_cut(spark, sf_dir):
    return book.book_at_cut(_rows(spark, sf_dir), _cut(spark, sf_dir, 6))


def book_bbo(spark, sf_dir):
    return whole(book.bbo(book_cut(spark, sf_dir)))


def book_depth(spark, sf_dir):
    return book.depth_view(book_cut(spark, sf_dir), 3).select("market", "asset", "side", "place", "price", "size")


def book_payloads(spark, sf_dir):
    """All twelve levels of both assets of every market at the cut; a source is fresh for half a day here."""
    cut = _cut(spark, sf_dir, 6)
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("event_id") <= cut).select(F.col("user_id").alias("market"), (F.col("event_id") % 2).alias("asset"), "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    tokens = e.select("market").distinct().select("market", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("asset"))
    last = e.groupBy("market", "asset").agg(F.max("ms").alias("source_ms"), F.max("event_id").alias("last")).where("last % 9 <> 4")
    observed = e.agg(F.max("ms")).first()[0] or 0
    evidence = last.select("market", "asset", (F.col("last") % 11 != 3).alias("ready"), (F.col("last") % 7 != 2).alias("transport_healthy"), F.when(F.col("last") % 13 == 5, "old").otherwise("fresh_pong_rtt_v1").alias("transport_policy"), "source_ms")
    return whole(book.side_payloads(tokens, book.book_at_cut(_rows(spark, sf_dir), cut), evidence, observed, fresh_ms=43_200_000))


def book_digests(spark, sf_dir):
    return book.book_digest(book_cut(spark, sf_dir))


def bbo_history(spark, sf_dir):
    return whole(book.bbo_timeline(_rows(spark, sf_dir)))


def every_cut(spark, sf_dir):
    """The sweep against the join of intervals, at every moment."""
    rows = _rows(spark, sf_dir)
    return book.compare_cuts(book.bbo_timeline(rows), book.bbo_by_intervals(rows))


def native_best(spark, sf_dir):
    """Declared best prices, some off by one and some of books that are not there."""
    t = book.bbo_timeline(_rows(spark, sf_dir))
    claims = t.select("market", (F.col("asset") + F.when(F.col("moment") % 23 == 7, 9).otherwise(0)).alias("asset"), F.col("moment").alias("pos"), F.lit(1).alias("idx"), (F.col("best_bid") + F.when(F.col("moment") % 17 == 3, 1).otherwise(0)).alias("best_bid"), "best_ask")
    early = claims.withColumns({"idx": F.lit(0), "best_bid": F.lit(-5).cast("long")})
    return book.native_check(claims.unionByName(early), t)


def live_book(spark, sf_dir):
    """Changes of best prices from a stream of the level rows, in four micro-batches of several files."""
    folder = jobs.work_dir(spark)
    files = jobs.write_in_order(_rows(spark, sf_dir).select("market", "asset", "base", "pos", "idx", "side", "price", "size"), "pos", f"{folder}/rows", 4)
    jobs.drain(jobs.live_book_stream(jobs.file_stream(spark, f"{folder}/rows", files)), folder, states=4 * spark.sparkContext.defaultParallelism)
    return whole(spark.read.schema("market long, asset long, pos long, best_bid long, best_ask long").parquet(f"{folder}/out"))


def checkpoint_files(spark, sf_dir):
    return sinks.write_checkpoint(_rows(spark, sf_dir), _cut(spark, sf_dir, 6), f"{jobs.work_dir(spark)}/checkpoint").select("table", "n")


def tape(spark, sf_dir):
    return book.sequence_tape(fx.frame(spark, sf_dir, fx.book_events)).select("pos", "market", "market_seq", "prev_market_seq", "book_epoch")


def tape_gaps(spark, sf_dir):
    """Gaps that a tape shows when every 29th event is lost."""
    whole = book.sequence_tape(fx.frame(spark, sf_dir, fx.book_events))
    return tables.sequence_gaps(whole.where("pos % 29 <> 4"), ["market"], "pos", "market_seq", "prev_market_seq").select("pos", "market", "market_seq", "expected")


def resumed(spark, sf_dir):
    """Book at the end from a checkpoint and the tail."""
    rows, cut, end = _rows(spark, sf_dir), _cut(spark, sf_dir, 6), _cut(spark, sf_dir, 10)
    return book.resume(rows, book.checkpoint(rows, cut)[0], cut, end)


def no_baseline(spark, sf_dir):
    return book.checkpoint(_rows(spark, sf_dir), _cut(spark, sf_dir, 1))[1]


def depth_labels(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    at = lambda t: book.book_at_cut(rows, _cut(spark, sf_dir, t))
    return book.compare_depth(at(8), at(9), at(10))


def _edges(spark, sf_dir):
    r = fx.frame(spark, sf_dir, fx.readiness).agg(F.min("ms"), F.max("ms")).first()
    lo, hi = (r[0] or 0), (r[1] or 0)
    return lo + (hi - lo) // 4, hi


def time_coverage(spark, sf_dir):
    changes = fx.frame(spark, sf_dir, fx.readiness)
    start, end = _edges(spark, sf_dir)
    return coverage.interval_coverage(changes, start, end)


def chosen_sources(spark, sf_dir):
    return whole(coverage.select_sources(fx.frame(spark, sf_dir, fx.readiness)))


def _lane_rows(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    tokens = c.select(F.col("c_custkey").alias("token"), F.floor(F.col("c_custkey") / 2).alias("market"))
    states = c.select(F.col("c_custkey").alias("token"), F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("lane"))
    states = states.where((F.col("token") + F.col("lane")) % 9 != 2)
    mark = lambda n, k: (F.col("token") * 7 + F.col("lane") * 3) % n != k
    states = states.select("token", "lane", mark(11, 1).alias("assigned"), mark(13, 2).alias("written"), mark(7, 3).alias("seen"), mark(17, 4).alias("durable"), mark(5, 1).alias("ready"))
    return coverage.token_lanes(tokens, spark.range(4).select(F.col("id").cast("int").alias("lane")), states)


def lane_reasons(spark, sf_dir):
    return _lane_rows(spark, sf_dir).select("token", "lane", "qualified", F.array_join("reasons", ",").alias("reasons"), F.coalesce("primary_reason", F.lit("")).alias("primary_reason"))


def lane_counters(spark, sf_dir):
    return coverage.stage_counters(_lane_rows(spark, sf_dir))


def pair_coverage(spark, sf_dir):
    return coverage.market_pairs(_lane_rows(spark, sf_dir))


def id_membership(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id"), "c_nationkey")
    return coverage.membership(c.where("id % 5 <> 0"), c.where("id % 7 <> 1"), c.where("id % 3 <> 2"), c.where("c_nationkey = 3"))


def soak(spark, sf_dir):
    samples = fx.frame(spark, sf_dir, fx.lifecycle).select(F.col("market").alias("key"), F.col("block").alias("at"), "id", (F.col("value") % 2).alias("fingerprint"))
    return coverage.soak_windows(samples, 2_000)


def ranges_prefix(spark, sf_dir):
    """Committed prefix, holes and overlaps of ranges, by supplier."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_suppkey").alias("stream"), F.col("l_partkey").alias("first"), (F.col("l_partkey") + F.col("l_quantity").cast("long") % 3).alias("last"))
    return tables.contiguous_prefix(lines.distinct(), ["stream"], "first", "last")


def price_rejects(spark, sf_dir):
    return prices.valid_prices(fx.frame(spark, sf_dir, fx.prices))[1].select("id", "reason")


def _agreed(spark, sf_dir):
    return prices.agreed(prices.valid_prices(fx.frame(spark, sf_dir, fx.prices))[0])


def recent_prices(spark, sf_dir):
    found = _agreed(spark, sf_dir)
    now = found.agg(F.max("observed_ms")).first()[0] or 0
    return prices.price_window(found, now, 200 * 86_400_000, 30)


def price_rounds(spark, sf_dir):
    return whole(prices.rounds(_agreed(spark, sf_dir), 7 * 86_400_000))


def price_asof(spark, sf_dir):
    """Each record with the latest agreed price of its asset a day or more before."""
    left = fx.frame(spark, sf_dir, fx.prices).select("id", "asset", (F.col("observed_ms") - 86_400_000).alias("at"))
    return tables.asof_join(left, _agreed(spark, sf_dir), ["asset"], "at", "observed_ms", ["observed_ms", "price"], 90 * 86_400_000).select("id", "asset", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("observed_ms", "price")])


def latency_quantiles(spark, sf_dir):
    rows = fx.frame(spark, sf_dir, fx.prices).select("asset", F.col("price").alias("v"))
    return tables.exact_quantiles(rows, ["asset"], "v", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def latency_histogram(spark, sf_dir):
    rows = fx.frame(spark, sf_dir, fx.prices).select("asset", F.col("price").alias("v"))
    return tables.histogram_quantiles(rows, ["asset"], "v", [10**i for i in range(3, 8)] + [2 * 10**7], {"p50": 0.5, "p95": 0.95})


def adjudications(spark, sf_dir):
    return whole(oracle.readiness(oracle.adjudication(fx.frame(spark, sf_dir, fx.lifecycle))))


def _bridge_markets(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    return p.select(F.col("p_partkey").alias("market_id"), F.floor(F.col("p_partkey") / F.when(F.col("p_partkey") % 10 < 2, 10).otherwise(1)).alias("gamma"), (F.col("p_partkey") * 3).alias("condition"), F.when(F.col("p_partkey") % 4 != 1, F.col("p_partkey") + 5).alias("question"))


def bridged(spark, sf_dir):
    e = fx.frame(spark, sf_dir, fx.lifecycle)
    rows = e.select("id", (F.col("value") + F.when(F.col("id") % 9 == 0, 1).otherwise(0)).alias("gamma"), F.when(F.col("id") % 5 != 2, F.col("value") * 3).alias("condition"), F.when(F.col("id") % 3 != 1, F.col("value") + 5).alias("question"))
    return oracle.bridge_markets(rows, _bridge_markets(spark, sf_dir), ("gamma", "condition", "question")).select("id", F.coalesce("market_id", F.lit(-1)).alias("market_id"), F.coalesce("matched_by", F.lit("none")).alias("matched_by"))


def combos(spark, sf_dir):
    """Payout factors of all legs of each market, in limbs."""
    legs = fx.frame(spark, sf_dir, fx.lifecycle).groupBy("market").agg(F.array_sort(F.collect_list(F.struct("id", ((F.col("value") * 9973) % 1_000_001).alias("n")))).alias("x"))
    paid = legs.select("market", F.size("x").cast("long").alias("legs"), oracle.combo_payout(F.transform("x", lambda s: s["n"])).alias("p"))
    return paid.select("market", "legs", *[F.col(f"p.{side}.{limb}").cast("long").alias(f"{side}_{limb}") for side in ("down", "up") for limb in ("hi", "lo")])


def payload_reuse(spark, sf_dir):
    """Payloads stored once by content: occurrences, bytes, unique bytes, saved bytes, by source."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("source", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("bytes"))
    each = d.groupBy("source", "sha").agg(F.count("*").alias("n"), F.max("bytes").alias("bytes"))
    return each.groupBy("source").agg(F.sum("n").alias("occurrences"), F.count("*").alias("payloads"), F.sum(F.col("n") * F.col("bytes")).alias("raw_bytes"), F.sum("bytes").alias("unique_bytes"), F.sum((F.col("n") - 1) * F.col("bytes")).alias("saved_bytes"))


def identity_classes(spark, sf_dir):
    """Markets by the first marker that applies; each market has one class."""
    m = fx.frame(spark, sf_dir, fx.markets)
    label = (
        F.when(F.col("slug").startswith("ghost-market-") | F.lower("category").isin("ghost", "[ghost]"), "ghost").when(F.col("identity_kind") == "legacy_placeholder", "placeholder")
        .when(F.col("identity_kind") == "invalid_shell", "shell").when(F.col("identity_kind") == "official_combo", "combo").otherwise("standard")
    )
    return m.groupBy(label.alias("label")).agg(F.count("*").alias("markets"), F.min("market_id").alias("first"))


def _line_claims(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_partkey").alias("token"), F.floor(F.col("l_orderkey") / 50).alias("condition"))


def _conflicts(claims):
    return claims.groupBy("token").agg(F.count_distinct("condition").alias("conditions"), F.min("condition").alias("lowest"), F.count("*").alias("claims")).where("conditions > 1")


def ownership_conflicts(spark, sf_dir):
    """Tokens that more than one condition claims, from all order lines as claims."""
    return _conflicts(_line_claims(spark, sf_dir))


def shard_plan(spark, sf_dir):
    """Markets packed in the order of their hash into shards of bounded size; the order is cut by hash range, so that
    no task sorts all markets."""
    m = fx.frame(spark, sf_dir, fx.markets).select("market_id", F.sha2(F.col("market_id").cast("string"), 256).alias("h"))
    m = m.withColumn("cell", F.conv(F.substring("h", 1, 2), 16, 10).cast("int"))
    w = F.row_number().over(tables.Window.partitionBy("cell").orderBy("h"))
    sizes = m.groupBy("cell").count()
    before = sizes.withColumn("before", F.coalesce(F.sum("count").over(tables.Window.orderBy("cell").rowsBetween(tables.Window.unboundedPreceding, -1)), F.lit(0)))
    return m.withColumn("n", w).join(F.broadcast(before), "cell").select("market_id", F.floor((F.col("before") + F.col("n") - 1) / 16).alias("shard"))


QUERIES = {
    "book_at_cut": book_cut, "book_bbo": book_bbo, "book_depth": book_depth, "book_payloads": book_payloads, "book_digest": book_digests, "bbo_timeline": bbo_history, "every_cut": every_cut, "native_best": native_best, "live_book": live_book, "checkpoint_files": checkpoint_files, "tape_sequence": tape, "tape_gaps": tape_gaps,
    "checkpoint_resume": resumed, "checkpoint_no_baseline": no_baseline, "depth_labels": depth_labels, "interval_coverage": time_coverage, "source_selection": chosen_sources,
    "token_lanes": lane_reasons, "lane_counters": lane_counters, "market_pairs": pair_coverage, "catalog_membership": id_membership, "soak_windows": soak, "contiguous_prefix": ranges_prefix,
    "price_rejects": price_rejects, "price_window": recent_prices, "price_rounds": price_rounds, "price_asof": price_asof, "exact_quantiles": latency_quantiles, "histogram_quantiles": latency_histogram,
    "adjudication_readiness": adjudications, "market_bridge": bridged, "combo_payout": combos, "payload_reuse": payload_reuse, "identity_classes": identity_classes,
    "ownership_conflicts": ownership_conflicts, "ownership_conflicts_all": ownership_conflicts, "shard_plan": shard_plan,
}

_BOOK = fx.cte(ev=fx.book_events) + """
    , assets AS (SELECT DISTINCT market, asset FROM ev WHERE kind <> 'GAP'), control AS (
        SELECT e.market, a.asset, e.pos, e.kind FROM ev e JOIN assets a ON a.market = e.market AND (e.kind IN ('RESET', 'GAP') OR a.asset = e.asset) WHERE e.kind <> 'CHANGE'
    ), resets AS (SELECT market, asset, pos AS base FROM control WHERE kind <> 'GAP'),
    lev AS (
        SELECT e.pos, e.market, e.asset, e.side, e.price_c AS price, e.size, r.base
        FROM (SELECT * FROM ev WHERE kind <> 'GAP') e ASOF JOIN control c ON c.market = e.market AND c.asset = e.asset AND e.pos >= c.pos
        ASOF JOIN resets r ON r.market = e.market AND r.asset = e.asset AND e.pos >= r.base WHERE c.kind <> 'GAP'
    )
"""


def _at(cut: str, name: str) -> str:
    return f"""
    , base_{name} AS (SELECT market, asset, max(base) AS base FROM resets WHERE base <= {cut} GROUP BY ALL),
    ready_{name} AS (SELECT market, asset, arg_max(kind <> 'GAP', pos) AS ready FROM control WHERE pos <= {cut} GROUP BY ALL),
    {name} AS (
        SELECT market, asset, side, price, arg_max(size, pos) AS size, any_value(ready) AS ready FROM lev JOIN base_{name} USING (market, asset, base) JOIN ready_{name} USING (market, asset)
        WHERE pos <= {cut} GROUP BY market, asset, side, price HAVING arg_max(size, pos) > 0
    )"""


def _tenth(n: int) -> str:
    return f"(SELECT max(event_id) * {n} // 10 FROM events)"


_CUT = _BOOK + _at(_tenth(6), "b")
_READY = fx.cte(r=fx.readiness)
_LANES = """
    WITH grid AS (SELECT c_custkey AS token, c_custkey // 2 AS market, unnest([0, 1, 2, 3]) AS lane FROM customer),
    s AS (
        SELECT *, (token + lane) % 9 <> 2 AS there, there AND (token * 7 + lane * 3) % 11 <> 1 AS assigned, there AND (token * 7 + lane * 3) % 13 <> 2 AS written, there AND (token * 7 + lane * 3) % 7 <> 3 AS seen,
            there AND (token * 7 + lane * 3) % 17 <> 4 AS durable, there AND (token * 7 + lane * 3) % 5 <> 1 AS ready FROM grid
    ), q AS (SELECT *, assigned AND written AND seen AND durable AND ready AS qualified,
        list_filter([CASE WHEN NOT assigned THEN 'NOT_ASSIGNED' END, CASE WHEN NOT written THEN 'NOT_WRITTEN' END, CASE WHEN NOT seen THEN 'NO_BOOK' END, CASE WHEN NOT durable THEN 'NOT_DURABLE' END, CASE WHEN NOT ready THEN 'NOT_READY' END], lambda x: x IS NOT NULL) AS why FROM s)
"""
_PRICES = fx.cte(p=fx.prices) + """
    , v AS (SELECT *, CASE WHEN observed_ms > published_ms THEN 'published before observed' WHEN published_ms > received_ms THEN 'received before published' WHEN price <> exact THEN 'inexact' WHEN feed <> 'feed' THEN 'other feed' END AS reason FROM p),
    agreed AS (SELECT asset, observed_ms, min(price) AS price FROM v WHERE reason IS NULL GROUP BY ALL HAVING min(price) = max(price))
"""

ORACLE_SQL = {
    "book_at_cut": _CUT + "SELECT * FROM b",
    "book_bbo": _CUT + "SELECT market, asset, coalesce(max(price) FILTER (side = 'BUY'), -1) AS best_bid, coalesce(min(price) FILTER (side = 'SELL'), -1) AS best_ask, count(*) FILTER (side = 'BUY') AS bid_levels, count(*) FILTER (side = 'SELL') AS ask_levels, coalesce(max(price) FILTER (side = 'BUY') >= min(price) FILTER (side = 'SELL'), false) AS crossed FROM b GROUP BY ALL",
    "book_depth": _CUT + "SELECT market, asset, side, row_number() OVER (PARTITION BY market, asset, side ORDER BY CASE side WHEN 'BUY' THEN -price ELSE price END) AS place, price, size FROM b QUALIFY place <= 3",
    "book_digest": _CUT + "SELECT market, sha256(string_agg(x, ',' ORDER BY x)) AS digest FROM (SELECT market, concat_ws(':', asset, side, price, size) AS x FROM b) GROUP BY market",
    "bbo_timeline": _BOOK + """
        , moments AS (SELECT DISTINCT market, asset, base, pos AS moment FROM lev UNION SELECT c.market, c.asset, r.base, c.pos FROM control c ASOF JOIN resets r ON r.market = c.market AND r.asset = c.asset AND c.pos >= r.base),
        last AS (SELECT m.market, m.asset, m.moment, l.side, l.price, arg_max(l.size, l.pos) AS size FROM moments m JOIN lev l ON l.market = m.market AND l.asset = m.asset AND l.base = m.base AND l.pos <= m.moment GROUP BY ALL)
        SELECT market, asset, moment, coalesce(max(price) FILTER (side = 'BUY' AND size > 0), -1) AS best_bid, coalesce(min(price) FILTER (side = 'SELL' AND size > 0), -1) AS best_ask FROM moments LEFT JOIN last USING (market, asset, moment) GROUP BY ALL""",
    "tape_sequence": fx.cte(ev=fx.book_events) + "SELECT pos, market, row_number() OVER w AS market_seq, row_number() OVER w - 1 AS prev_market_seq, cast(sum(CASE kind WHEN 'RESET' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS book_epoch FROM ev WINDOW w AS (PARTITION BY market ORDER BY pos)",
    "tape_gaps": fx.cte(ev=fx.book_events) + """
        , t AS (SELECT pos, market, row_number() OVER (PARTITION BY market ORDER BY pos) AS market_seq FROM ev), k AS (SELECT *, lag(market_seq) OVER (PARTITION BY market ORDER BY pos) + 1 AS expected FROM t WHERE pos % 29 <> 4)
        SELECT pos, market, market_seq, expected FROM k WHERE expected <> market_seq""",
    "checkpoint_resume": _BOOK + _at(_tenth(10), "b") + "SELECT market, asset, side, price, size FROM b",
    "checkpoint_no_baseline": _BOOK + f"SELECT DISTINCT market FROM ev WHERE pos <= {_tenth(1)} AND kind IN ('GAP') AND market NOT IN (SELECT market FROM resets WHERE base <= {_tenth(1)}) AND market IN (SELECT market FROM assets)",
    "depth_labels": _BOOK + _at(_tenth(8), "b") + _at(_tenth(9), "a") + _at(_tenth(10), "x") + "".join(
        f", l{n} AS (SELECT market, asset, string_agg(s, ',' ORDER BY s) AS {n} FROM (SELECT market, asset, concat_ws(':', side, price, size) AS s FROM {n}) GROUP BY ALL)" for n in "bax"
    ) + """
        SELECT market, asset, CASE WHEN x IS NULL THEN 'NO_BASELINE' WHEN b IS NULL OR a IS NULL THEN 'NO_REFERENCE' WHEN a = b AND x = b THEN 'EXACT_STABLE_BRACKET_MATCH' WHEN a = b THEN 'STABLE_MISMATCH'
            WHEN x = b OR x = a THEN 'MATCHES_ONE_SIDE' ELSE 'REFERENCE_MOVED' END AS label FROM lb FULL JOIN la USING (market, asset) FULL JOIN lx USING (market, asset)""",
    "interval_coverage": _READY + """
        , e AS (SELECT min(ms) + (max(ms) - min(ms)) // 4 AS a, max(ms) AS z FROM r), c AS (SELECT plant, lane, token, ms, arg_max(ready, id) AS ready FROM r GROUP BY ALL),
        src AS (SELECT DISTINCT plant, lane, token FROM c), cutp AS (SELECT token, greatest(a, least(z, ms)) AS t FROM c, e UNION SELECT token, a FROM src, e UNION SELECT token, z FROM src, e),
        seg AS (SELECT token, t, lead(t) OVER (PARTITION BY token ORDER BY t) - t AS len FROM cutp),
        st AS (SELECT s.token, s.t, s.len, x.plant, coalesce(c.ready, false) AS ready FROM seg s JOIN src x USING (token) ASOF LEFT JOIN c ON c.token = s.token AND c.plant = x.plant AND c.lane = x.lane AND s.t >= c.ms WHERE s.len > 0),
        pl AS (SELECT token, t, len, plant, bool_or(ready) AS ready FROM st GROUP BY ALL), k AS (SELECT token, t, len, count(*) FILTER (ready) AS n FROM pl GROUP BY ALL)
        SELECT token, coalesce(sum(len) FILTER (n >= 1), 0)::BIGINT AS one_plant, coalesce(sum(len) FILTER (n >= 2), 0)::BIGINT AS all_plants FROM (SELECT DISTINCT token FROM r) LEFT JOIN k USING (token) GROUP BY token""",
    "source_selection": _READY + """
        , src AS (SELECT DISTINCT token, plant, lane FROM r), g AS (
            SELECT p.token, p.ms, p.id, s.plant, s.lane, (SELECT arg_max(q.ready, q.id) FROM r q WHERE q.token = p.token AND q.plant = s.plant AND q.lane = s.lane AND q.id <= p.id) AS ready FROM r p JOIN src s ON s.token = p.token
        ), best AS (SELECT token, ms, id, min(CASE WHEN ready THEN lane * 10 + (9 - plant) END) AS k FROM g GROUP BY ALL),
        d AS (SELECT token, ms, id, coalesce(k // 10, -1) AS lane, coalesce(9 - k % 10, -1) AS plant, lag(k) OVER w AS before, row_number() OVER w AS n, k FROM best WINDOW w AS (PARTITION BY token ORDER BY ms, id))
        SELECT token, ms, id, lane, plant FROM d WHERE n = 1 OR before IS DISTINCT FROM k""",
    "token_lanes": _LANES + "SELECT token, lane, qualified, array_to_string(why, ',') AS reasons, coalesce(why[1], '') AS primary_reason FROM q",
    "lane_counters": _LANES + "SELECT lane, count(*) AS tokens, " + ", ".join(f"count(*) FILTER ({c}) AS {c}" for c in ("assigned", "written", "seen", "durable", "ready", "qualified")) + " FROM q GROUP BY lane",
    "market_pairs": _LANES + ", l AS (SELECT market, lane, count(*) = 2 AND bool_and(qualified) AS ok FROM q GROUP BY ALL) SELECT market, count(*) FILTER (ok) AS pairs, bool_or(ok) AS any_lane, bool_and(ok) AS all_lanes FROM l GROUP BY market",
    "catalog_membership": """
        WITH c AS (SELECT c_custkey AS id, c_custkey % 5 <> 0 AS d, c_custkey % 7 <> 1 AS a, c_custkey % 3 <> 2 AS c, c_nationkey = 3 AS x FROM customer)
        SELECT id, CASE WHEN x AND a THEN 'EXCLUDED_BUT_ASSIGNED' WHEN x THEN 'EXCLUDED' WHEN d AND a THEN 'MATCHED' WHEN d AND c THEN 'NOT_ASSIGNED' WHEN d THEN 'NOT_IN_CENSUS' WHEN a THEN 'ASSIGNED_NOT_DESIRED' ELSE 'CENSUS_ONLY' END AS reason FROM c WHERE d OR a OR c OR x""",
    "soak_windows": fx.cte(e=fx.lifecycle) + """
        , s AS (SELECT market AS key, block AS t, id, value % 2 AS f, lag(block) OVER w AS pa, lag(value % 2) OVER w AS pf FROM e WINDOW w AS (PARTITION BY market ORDER BY block, id)),
        n AS (SELECT *, sum(CASE WHEN pa IS NULL OR t - pa > 2000 OR f <> pf THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY t, id) AS session FROM s)
        SELECT key, session::BIGINT AS session, min(t) AS "from", max(t) AS "to", count(*) AS samples FROM n GROUP BY key, session""",
    "contiguous_prefix": """
        WITH r AS (SELECT DISTINCT l_suppkey AS stream, l_partkey AS a, l_partkey + l_quantity::BIGINT % 3 AS z FROM lineitem), m AS (SELECT *, max(z) OVER (PARTITION BY stream ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM r),
        i AS (SELECT *, sum(CASE WHEN b IS NULL OR a > b + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY stream ORDER BY a, z) AS k FROM m),
        g AS (SELECT stream, k, min(a) AS lo, max(z) AS hi, count(*) FILTER (a <= b) AS over FROM i GROUP BY ALL), h AS (SELECT *, lo - lag(hi) OVER (PARTITION BY stream ORDER BY k) - 1 AS hole FROM g)
        SELECT stream, max(hi) FILTER (k = 1) AS committed, count(*) AS islands, coalesce(sum(hole), 0)::BIGINT AS holes, sum(over)::BIGINT AS overlaps, coalesce(sum(hi - lo + 1) FILTER (k > 1), 0)::BIGINT AS tail FROM h GROUP BY stream""",
    "price_rejects": _PRICES + "SELECT id, reason FROM v WHERE reason IS NOT NULL",
    "price_window": _PRICES + ", k AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY observed_ms DESC) AS place, (SELECT max(observed_ms) FROM agreed) AS now FROM agreed) SELECT asset, observed_ms, price, place FROM k WHERE place <= 30 AND (observed_ms > now - 17280000000 OR place = 1)",
    "price_rounds": _PRICES + "SELECT asset, observed_ms - observed_ms % 604800000 AS round, arg_min(price, observed_ms) AS first, arg_max(price, observed_ms) AS last, min(price) AS low, max(price) AS high, count(*) AS n, coalesce(max(price) FILTER (observed_ms % 604800000 = 0), -1) AS opening FROM agreed GROUP BY ALL",
    "price_asof": _PRICES + "SELECT p.id, p.asset, coalesce(a.observed_ms, -1) AS observed_ms, coalesce(a.price, -1) AS price FROM (SELECT id, asset, observed_ms - 86400000 AS ms FROM p) p ASOF LEFT JOIN agreed a ON a.asset = p.asset AND p.ms >= a.observed_ms",
    "exact_quantiles": fx.cte(p=fx.prices) + ", k AS (SELECT asset, price, row_number() OVER (PARTITION BY asset ORDER BY price) - 1 AS i, count(*) OVER (PARTITION BY asset) AS n FROM p) SELECT asset, max(n) AS n, " + ", ".join(f"max(price) FILTER (i = floor((n - 1) * {q}::DOUBLE)) AS {c}" for c, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))) + ", max(price) AS max FROM k GROUP BY asset",
    "histogram_quantiles": fx.cte(p=fx.prices) + """
        , b AS (SELECT asset, list_count(list_filter([1000, 10000, 100000, 1000000, 10000000, 20000000], lambda x: x < price)) AS b FROM p), c AS (SELECT asset, b, count(*) AS n FROM b GROUP BY ALL),
        u AS (SELECT asset, b, sum(n) OVER (PARTITION BY asset ORDER BY b) AS upto, sum(n) OVER (PARTITION BY asset) AS total FROM c)
        SELECT asset, max(total)::BIGINT AS n, [1000, 10000, 100000, 1000000, 10000000, 20000000, -1][min(b) FILTER (upto >= total * 0.5::DOUBLE) + 1]::BIGINT AS p50, [1000, 10000, 100000, 1000000, 10000000, 20000000, -1][min(b) FILTER (upto >= total * 0.95::DOUBLE) + 1]::BIGINT AS p95 FROM u GROUP BY asset""",
    "adjudication_readiness": fx.cte(e=fx.lifecycle) + """
        , a AS (SELECT market, count(*) FILTER (status = 'request') AS requests, count(*) FILTER (status = 'propose') AS proposes, count(*) FILTER (status = 'dispute') AS disputes, count(*) FILTER (status = 'settle') AS settles,
            last(id ORDER BY block, log_index, id) FILTER (status = 'settle') AS last_settle, last(value ORDER BY block, log_index, id) FILTER (status = 'settle') AS last_value FROM e GROUP BY market)
        SELECT * EXCLUDE (last_settle, last_value), coalesce(last_settle, -1) AS last_settle, coalesce(last_value, -1) AS last_value, CASE WHEN settles = 0 THEN CASE WHEN proposes > 0 THEN 'PROPOSED' WHEN requests > 0 THEN 'REQUESTED' ELSE 'NO_EVIDENCE' END WHEN requests = 0 THEN 'SETTLED_WITHOUT_REQUEST' WHEN disputes > settles THEN 'DISPUTED' WHEN last_value IS NULL THEN 'INVALID_PAYOUT' ELSE 'READY' END AS state FROM a""",
    "market_bridge": fx.cte(e=fx.lifecycle) + """
        , m AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 10 < 2 THEN p_partkey // 10 ELSE p_partkey END AS g, p_partkey * 3 AS c, CASE WHEN p_partkey % 4 <> 1 THEN p_partkey + 5 END AS q FROM part),
        g AS (SELECT g AS k, min(id) AS g FROM m GROUP BY m.g HAVING count(*) = 1), c AS (SELECT c AS k, min(id) AS c FROM m GROUP BY m.c HAVING count(*) = 1), q AS (SELECT q AS k, min(id) AS q FROM m WHERE q IS NOT NULL GROUP BY m.q HAVING count(*) = 1),
        r AS (SELECT id, value + CASE WHEN id % 9 = 0 THEN 1 ELSE 0 END AS kg, CASE WHEN id % 5 <> 2 THEN value * 3 END AS kc, CASE WHEN id % 3 <> 1 THEN value + 5 END AS kq FROM e),
        j AS (SELECT r.id, g.g, c.c, q.q, coalesce(g.g, c.c, q.q) AS x FROM r LEFT JOIN g ON g.k = kg LEFT JOIN c ON c.k = kc LEFT JOIN q ON q.k = kq),
        o AS (SELECT *, x IS NOT NULL AND coalesce(g, x) = x AND coalesce(c, x) = x AND coalesce(q, x) = x AS ok FROM j)
        SELECT id, CASE WHEN ok THEN x ELSE -1 END AS market_id, CASE WHEN ok THEN CASE WHEN g IS NOT NULL THEN 'gamma' WHEN c IS NOT NULL THEN 'condition' ELSE 'question' END ELSE 'none' END AS matched_by FROM o""",
    "payload_reuse": "WITH e AS (SELECT source, text, count(*) AS n, max(strlen(text)) AS b FROM documents GROUP BY ALL) SELECT source, sum(n)::BIGINT AS occurrences, count(*) AS payloads, sum(n * b)::BIGINT AS raw_bytes, sum(b)::BIGINT AS unique_bytes, sum((n - 1) * b)::BIGINT AS saved_bytes FROM e GROUP BY source",
    "identity_classes": fx.cte(m=fx.markets) + "SELECT CASE WHEN slug LIKE 'ghost-market-%' OR lower(category) IN ('ghost', '[ghost]') THEN 'ghost' WHEN identity_kind = 'legacy_placeholder' THEN 'placeholder' WHEN identity_kind = 'invalid_shell' THEN 'shell' WHEN identity_kind = 'official_combo' THEN 'combo' ELSE 'standard' END AS label, count(*) AS markets, min(market_id) AS first FROM m GROUP BY 1",
    "combo_payout": fx.cte(e=fx.lifecycle).replace("WITH ", "WITH RECURSIVE ", 1) + """
        , l AS (SELECT market, value * 9973 % 1000001 AS n, row_number() OVER (PARTITION BY market ORDER BY id) AS i FROM e), c AS (SELECT market, count(*) AS legs FROM l GROUP BY 1),
        f AS (
            SELECT market, 0::BIGINT AS i, side, 1000000000000000000::HUGEINT AS hi, 0::HUGEINT AS lo FROM c, (VALUES (0), (1)) AS sides(side)
            UNION ALL
            SELECT market, i, side, hi * n // 1000000 + (low + up) // 1000000000000000000, (low + up) % 1000000000000000000
            FROM (SELECT *, wide // 1000000 AS low, CASE WHEN side = 1 AND wide % 1000000 > 0 THEN 1 ELSE 0 END AS up FROM (SELECT f.market, l.i, side, hi, n, hi * n % 1000000 * 1000000000000000000 + lo * n AS wide FROM f JOIN l ON l.market = f.market AND l.i = f.i + 1))
        )
        SELECT c.market, legs, d.hi::BIGINT AS down_hi, d.lo::BIGINT AS down_lo, u.hi::BIGINT AS up_hi, u.lo::BIGINT AS up_lo FROM c JOIN f d ON d.market = c.market AND d.i = legs AND d.side = 0 JOIN f u ON u.market = c.market AND u.i = legs AND u.side = 1""",
    "ownership_conflicts": "SELECT l_partkey AS token, count(DISTINCT l_orderkey // 50) AS conditions, min(l_orderkey // 50) AS lowest, count(*) AS claims FROM lineitem GROUP BY 1 HAVING conditions > 1",
    "ownership_conflicts_all": "SELECT l_partkey AS token, count(DISTINCT l_orderkey // 50) AS conditions, min(l_orderkey // 50) AS lowest, count(*) AS claims FROM lineitem GROUP BY 1 HAVING conditions > 1",
    "shard_plan": fx.cte(m=fx.markets) + "SELECT market_id, (row_number() OVER (ORDER BY sha256(market_id::VARCHAR)) - 1) // 16 AS shard FROM m",
}

ORACLE_SQL |= {
    "every_cut": f"SELECT market, count(*) AS moments, 0::BIGINT AS differing FROM ({ORACLE_SQL['bbo_timeline']}) GROUP BY market",
    "native_best": f"""
        SELECT market, asset + CASE WHEN moment % 23 = 7 THEN 9 ELSE 0 END AS asset, moment AS pos, CASE WHEN moment % 23 = 7 THEN 'NO_BOOK' WHEN moment % 17 = 3 AND best_bid >= 0 THEN 'MISMATCH' ELSE 'MATCH' END AS result FROM ({ORACLE_SQL['bbo_timeline']})""",
    "live_book": f"""
        WITH t AS ({ORACLE_SQL['bbo_timeline']}), l AS (SELECT *, lag(best_bid, 1, -1) OVER w AS b, lag(best_ask, 1, -1) OVER w AS a FROM t WINDOW w AS (PARTITION BY market, asset ORDER BY moment))
        SELECT market, asset, moment AS pos, best_bid, best_ask FROM l WHERE best_bid <> b OR best_ask <> a""",
    "checkpoint_files": f"SELECT 'levels' AS \"table\", count(*) AS n FROM ({ORACLE_SQL['book_at_cut']}) UNION ALL SELECT 'without_baseline', (SELECT count(*) FROM (SELECT user_id FROM events WHERE event_id <= (SELECT max(event_id) * 6 // 10 FROM events) GROUP BY user_id HAVING count(*) FILTER (event_type = 'signup') = 0))",
}

ORACLE_SQL["book_payloads"] = _CUT + f"""
    , x AS (SELECT user_id AS market, event_id % 2 AS asset, max(epoch_us(ts) // 1000) AS source_ms, max(event_id) AS last FROM events WHERE event_id <= {_tenth(6)} GROUP BY ALL),
    m AS (SELECT DISTINCT market FROM x), now AS (SELECT max(source_ms) AS t FROM x), tk AS (SELECT market, unnest([0, 1])::BIGINT AS asset FROM m),
    pl AS (SELECT *, row_number() OVER (PARTITION BY market, asset, side ORDER BY CASE side WHEN 'BUY' THEN -price ELSE price END) AS place FROM b),
    la AS (SELECT market, asset, coalesce(string_agg(price || ':' || size, ',' ORDER BY place) FILTER (side = 'BUY' AND place <= 12), '') AS bids, coalesce(string_agg(price || ':' || size, ',' ORDER BY place) FILTER (side = 'SELL' AND place <= 12), '') AS asks,
        max(price) FILTER (side = 'BUY') AS best_bid, min(price) FILTER (side = 'SELL') AS best_ask FROM pl GROUP BY ALL),
    j AS (SELECT tk.*, bids, asks, best_bid, best_ask, source_ms, last, last % 11 <> 3 AND last % 7 <> 2 AND last % 13 <> 5 AND t - source_ms <= 43200000 AS live FROM tk LEFT JOIN la USING (market, asset) LEFT JOIN (SELECT * FROM x WHERE last % 9 <> 4) USING (market, asset), now)
    SELECT market, asset, coalesce(bids, '') AS bids, coalesce(asks, '') AS asks, coalesce(best_bid, -1) AS best_bid, coalesce(best_ask, -1) AS best_ask, coalesce(best_ask - best_bid, -1) AS spread, CASE WHEN live THEN 'live' WHEN last IS NOT NULL THEN 'stale' ELSE 'unavailable' END AS status,
        coalesce(source_ms, -1) AS source_ms, CASE WHEN live THEN source_ms + 20000 ELSE -1 END AS stale_after_ms FROM j
"""
