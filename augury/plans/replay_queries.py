"""Audits of captured frames by a second builder, with DuckDB SQL from the raw frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from augury.operators import audits, book, coverage, replay
from augury.plans import market_queries as mq
from augury.sources import fixtures as fx


def _inputs(spark, sf_dir):
    records, scope = fx.frame(spark, sf_dir, fx.capture), fx.frame(spark, sf_dir, fx.capture_scope)
    return records, scope, records.agg(F.max("pos")).first()[0] or 0


def replayed_books(spark, sf_dir):
    books, _ = replay.rebuilt(*_inputs(spark, sf_dir))
    return books.select(*replay.SOURCE, "asset", "side", replay.plain(F.col("price")).alias("price"), replay.plain(F.col("size")).alias("size"))


def replay_counts(spark, sf_dir):
    return replay.rebuilt(*_inputs(spark, sf_dir))[1]


def raw_accounting(spark, sf_dir):
    records, scope, _ = _inputs(spark, sf_dir)
    return replay.raw_accounting(records, replay.messages(replay.live_records(records), scope)[1])


def _declared(records, scope):
    """What the sources declare: digests of the library's own books, some of them altered, left out or of no source."""
    live = replay.live_records(records)
    found = replay.messages(live, scope)[0]
    number = lambda c: F.regexp_extract(c, r"-(\d)$", 1).cast("long")
    key = F.col("market").cast("long") * 10 + F.col("shard") * 2 + F.col("lane")
    levels = F.transform("rows", lambda r: F.struct(number(r["asset"]).alias("asset"), r["side"].alias("side"), (r["price"] * 100).cast("bigint").alias("price"), r["size"].cast("bigint").alias("size")))
    events = found.select((F.col("pos") * 10 + F.col("idx")).alias("pos"), key.alias("market"), number(F.col("asset")).alias("asset"), F.when(F.col("kind") == "book", "SNAPSHOT").otherwise("CHANGE").alias("kind"), levels.alias("levels"))
    ends = replay._barriers(live, found.select(*replay.SOURCE).distinct()).select((F.col("pos") * 10 - 1).alias("pos"), key.alias("market"), F.lit(None).cast("long").alias("asset"), F.lit("GAP").alias("kind"), F.lit(None).cast("array<struct<asset: bigint, side: string, price: bigint, size: bigint>>").alias("levels"))
    ends = ends.withColumn("levels", F.array().cast("array<struct<asset: bigint, side: string, price: bigint, size: bigint>>"))
    rows = book.applied(book.book_levels(events.unionByName(ends))[0])
    now = book.book_at_cut(rows, 2**62).where("ready")
    source = [F.floor(F.col("market") / 10).cast("string").alias("market"), (F.floor(F.col("market") % 10 / 2)).cast("long").alias("shard"), (F.col("market") % 2).alias("lane")]
    books = now.select(*source, F.concat(F.lit("t"), F.floor(F.col("market") / 10).cast("string"), F.lit("-"), F.col("asset").cast("string")).alias("asset"), "side", (F.col("price").cast("decimal(20,2)") / 100).alias("price"), "size")
    digests = replay.source_digests(books)
    mark = F.col("market").cast("long") * 2 + F.col("lane")
    altered = digests.where(mark % 11 != 5).withColumn("digest", F.when(mark % 7 == 3, F.lit("altered")).otherwise(F.col("digest")))
    return altered.unionByName(scope.select(F.concat(F.lit("gone-"), "market").alias("market")).distinct().withColumns({"shard": F.lit(0).cast("long"), "lane": F.lit(0).cast("long"), "digest": F.lit("none")}))


def source_audit(spark, sf_dir):
    records, scope, cutoff = _inputs(spark, sf_dir)
    found = replay.audit(replay.source_digests(replay.rebuilt(records, scope, cutoff)[0]), _declared(records, scope))
    return found.select(*replay.SOURCE, F.coalesce("digest", F.lit("")).alias("digest"), F.coalesce("declared", F.lit("")).alias("declared"), "result")


def every_state(spark, sf_dir):
    return book.cut_hashes(mq._rows(spark, sf_dir))


def stream_digests(spark, sf_dir):
    f = fx.frame(spark, sf_dir, fx.frames)
    return audits.stream_digests(f.select((F.col("pos") % 3).alias("stream"), F.floor(F.col("pos") / 3).alias("offset"), F.col("raw").alias("frame")))


def _market_scope(spark, sf_dir):
    """Two tokens each; the last market's tokens are never seen."""
    tokens = fx.frame(spark, sf_dir, fx.readiness).select("token").distinct()
    seen = tokens.select(F.floor(F.col("token") / 2).alias("market")).distinct()
    both = seen.select("market", F.explode(F.array(F.col("market") * 2, F.col("market") * 2 + 1)).alias("token"))
    return both.unionByName(spark.createDataFrame([(10**9, 2 * 10**9), (10**9, 2 * 10**9 + 1)], "market long, token long"))


def market_seconds(spark, sf_dir):
    return coverage.market_coverage(fx.frame(spark, sf_dir, fx.readiness), _market_scope(spark, sf_dir), *mq._edges(spark, sf_dir))


def coverage_shares(spark, sf_dir):
    found = coverage.coverage_summary(market_seconds(spark, sf_dir))
    return found.select("expected_tokens", "expected_markets", "window", *[F.floor(F.col(c) * 10**9).alias(c) for c in found.columns[3:]])


def source_events(spark, sf_dir):
    r = fx.frame(spark, sf_dir, fx.readiness)
    changes = r.select(F.col("token").alias("market"), "ms", "id", "lane", F.col("plant").alias("shard"), F.col("ready").alias("usable"))
    return coverage.source_events(changes).fillna(-1)


QUERIES = {"cut_hashes": every_state, "stream_digests": stream_digests, "market_seconds": market_seconds, "coverage_shares": coverage_shares, "source_events": source_events, "replayed_books": replayed_books, "replay_counts": replay_counts, "raw_accounting": raw_accounting, "source_audit": source_audit}

#: Frames, messages and books from the raw texts; last records by as-of joins.
_REPLAY = fx.cte(c=fx.capture, scope=fx.capture_scope) + """
    , con AS (SELECT shard, lane, pos, connection FROM c WHERE kind = 'CONNECT'),
    l AS (SELECT c.*, coalesce(con.connection = c.connection, false) AS live FROM c ASOF LEFT JOIN con ON con.shard = c.shard AND con.lane = c.lane AND c.pos >= con.pos),
    f AS (SELECT pos, shard, lane, try_cast(raw AS JSON) AS j FROM l WHERE kind = 'RAW' AND live AND raw <> 'PONG'),
    a AS (SELECT pos, shard, lane, CASE json_type(j) WHEN 'ARRAY' THEN j::JSON[] WHEN 'OBJECT' THEN [j] END AS ms FROM f),
    u AS (SELECT pos, shard, lane, unnest(ms) AS m, unnest(range(len(ms))) AS idx FROM a),
    s AS (SELECT pos, shard, lane, idx, m, m->>'market' AS market, m->>'event_type' AS kind, m->>'asset_id' AS asset FROM u WHERE (m->>'market') IN (SELECT market FROM scope)),
    stop AS (SELECT pos, min(idx) AS stop FROM s WHERE kind = 'book' AND (asset IS NULL OR (m->'bids') IS NULL OR (m->'asks') IS NULL) GROUP BY pos),
    g AS (SELECT s.*, s.pos * 10 + idx AS ord FROM s LEFT JOIN stop USING (pos) WHERE stop IS NULL OR idx < stop),
    r AS (
        SELECT market, shard, lane, ord, kind, asset, 'BUY' AS side, unnest((m->'bids')::JSON[]) AS x, unnest(range(len((m->'bids')::JSON[]))) AS k FROM g WHERE kind = 'book'
        UNION ALL SELECT market, shard, lane, ord, kind, asset, 'SELL', unnest((m->'asks')::JSON[]), 100 + unnest(range(len((m->'asks')::JSON[]))) FROM g WHERE kind = 'book'
        UNION ALL SELECT market, shard, lane, ord, kind, x->>'asset_id', x->>'side', x, k FROM (SELECT market, shard, lane, ord, kind, unnest((m->'price_changes')::JSON[]) AS x, unnest(range(len((m->'price_changes')::JSON[]))) AS k FROM g WHERE kind = 'price_change')
    ), src AS (SELECT DISTINCT market, shard, lane FROM g),
    ends AS (
        SELECT src.market, shard, lane, pos * 10 - 1 AS ord FROM src JOIN l USING (shard, lane) WHERE l.kind = 'CONNECT' OR (l.kind = 'DISCONNECT' AND live)
        UNION SELECT market, shard, lane, pos * 10 - 1 FROM l WHERE kind = 'SOURCE_STATE_RELEASED' OR (kind = 'SOURCE_ASSIGNED' AND live)
    ), shots AS (SELECT market, shard, lane, asset, ord FROM g WHERE kind = 'book'),
    t AS (SELECT DISTINCT market, shard, lane, asset, ord FROM r WHERE kind = 'price_change'),
    tr AS (
        SELECT t.*, coalesce(sh.ord > e.ord, false) AS ready FROM t ASOF LEFT JOIN shots sh ON sh.market = t.market AND sh.shard = t.shard AND sh.lane = t.lane AND sh.asset = t.asset AND t.ord >= sh.ord
        ASOF LEFT JOIN ends e ON e.market = t.market AND e.shard = t.shard AND e.lane = t.lane AND t.ord >= e.ord
    ), gr AS (SELECT market, shard, lane, ord, bool_and(ready) AS applies FROM tr GROUP BY ALL),
    fin AS (
        SELECT market, shard, lane, asset, base FROM (SELECT market, shard, lane, asset, max(ord) AS base FROM shots GROUP BY ALL) JOIN (SELECT market, shard, lane, max(ord) AS ended FROM ends GROUP BY ALL) USING (market, shard, lane) WHERE base > ended
    ), books AS (
        SELECT market, shard, lane, asset, side, (x->>'price')::DECIMAL(28,10) AS price, arg_max((x->>'size')::DECIMAL(28,10), ord * 1000 + k) AS size
        FROM r JOIN fin USING (market, shard, lane, asset) LEFT JOIN gr USING (market, shard, lane, ord) WHERE ord >= base AND (kind = 'book' OR applies) GROUP BY ALL HAVING size > 0
    ), shown AS (SELECT market, shard, lane, asset, side, rtrim(rtrim(price::VARCHAR, '0'), '.') AS price, rtrim(rtrim(size::VARCHAR, '0'), '.') AS size FROM books),
    digests AS (SELECT market, shard, lane, sha256(string_agg(x, ',' ORDER BY x)) AS digest FROM (SELECT market, shard, lane, concat_ws(':', asset, side, price, size) AS x FROM shown) GROUP BY ALL)
"""

ORACLE_SQL = {
    "replayed_books": _REPLAY + "SELECT * FROM shown",
    "replay_counts": _REPLAY + """
        SELECT market, shard, lane, (SELECT count(*) FROM shots s WHERE s.market = src.market AND s.shard = src.shard AND s.lane = src.lane) AS snapshots, count(gr.ord) FILTER (applies) AS groups, count(gr.ord) FILTER (NOT applies) AS before_snapshot,
            (SELECT count(*) FROM fin WHERE fin.market = src.market AND fin.shard = src.shard AND fin.lane = src.lane) AS ready_books FROM src LEFT JOIN gr USING (market, shard, lane) GROUP BY ALL""",
    "raw_accounting": _REPLAY + """
        , n AS (SELECT shard, lane, count(*) AS frames, sum(length(raw))::BIGINT AS characters, count(*) FILTER (live AND raw = 'PONG') AS keepalives, count(*) FILTER (NOT live) AS stale, count(*) - count(DISTINCT (connection, pos)) AS repeated FROM l WHERE kind = 'RAW' GROUP BY ALL),
        b AS (SELECT f.shard, f.lane, count(*) FILTER (j IS NOT NULL AND stop IS NULL) AS interpreted, count(*) FILTER (j IS NULL OR stop IS NOT NULL) AS uninterpreted FROM f LEFT JOIN stop USING (pos) GROUP BY ALL)
        SELECT n.*, coalesce(interpreted, 0) AS interpreted, coalesce(uninterpreted, 0) AS uninterpreted FROM n LEFT JOIN b USING (shard, lane)""",
    "source_audit": _REPLAY + """
        SELECT market, shard, lane, digest, CASE WHEN mark % 11 = 5 THEN '' WHEN mark % 7 = 3 THEN 'altered' ELSE digest END AS declared, CASE WHEN mark % 11 = 5 THEN 'MISSING' WHEN mark % 7 = 3 THEN 'MISMATCH' ELSE 'MATCH' END AS result
        FROM (SELECT *, market::BIGINT * 2 + lane AS mark FROM digests) UNION ALL SELECT DISTINCT 'gone-' || market, 0, 0, '', 'none', 'EXTRA' FROM scope""",
}

_LEVEL = "sha256(string_agg(lpad(up::VARCHAR, 20, '0') || ':' || d, ',' ORDER BY lpad(up::VARCHAR, 20, '0') || ':' || d)) AS d, min(lo) AS lo, max(hi) AS hi, sum(n)::BIGINT AS n"
_WINDOW = "(SELECT max(ms) - (min(ms) + (max(ms) - min(ms)) // 4) FROM r)"
#: Time cut at every change of any of a market's tokens; each stretch asks for the last change before it.
_SECONDS = fx.cte(r=fx.readiness) + """
    , e AS (SELECT min(ms) + (max(ms) - min(ms)) // 4 AS a, max(ms) AS z FROM r), c AS (SELECT plant, lane, token, ms, arg_max(ready, id) AS ready FROM r GROUP BY ALL),
    m AS (SELECT DISTINCT token // 2 AS market FROM r), scope AS (SELECT market, market * 2 AS token FROM m UNION ALL SELECT market, market * 2 + 1 FROM m),
    src AS (SELECT DISTINCT plant, lane, token FROM c), cutp AS (SELECT token // 2 AS market, greatest(a, least(z, ms)) AS t FROM c, e UNION SELECT market, a FROM m, e UNION SELECT market, z FROM m, e),
    seg AS (SELECT market, t, lead(t) OVER (PARTITION BY market ORDER BY t) - t AS len FROM cutp),
    st AS (SELECT s.market, s.t, s.len, x.token, x.plant, x.lane, coalesce(c.ready, false) AS ready FROM seg s JOIN src x ON x.token // 2 = s.market ASOF LEFT JOIN c ON c.token = x.token AND c.plant = x.plant AND c.lane = x.lane AND s.t >= c.ms WHERE s.len > 0),
    tp AS (SELECT market, t, len, token, count(DISTINCT plant) FILTER (ready) AS k FROM st GROUP BY ALL),
    tk AS (SELECT market, coalesce(sum(len) FILTER (k >= 1), 0)::BIGINT AS one, coalesce(sum(len) FILTER (k >= 2), 0)::BIGINT AS both FROM tp GROUP BY market),
    lp AS (SELECT market, t, len, plant, lane, count(*) FILTER (ready) = 2 AS ok FROM st GROUP BY ALL), mp AS (SELECT market, t, len, count(DISTINCT plant) FILTER (ok) AS k FROM lp GROUP BY ALL),
    mk AS (SELECT market, coalesce(sum(len) FILTER (k >= 1), 0)::BIGINT AS one, coalesce(sum(len) FILTER (k >= 2), 0)::BIGINT AS both FROM mp GROUP BY market),
    f AS (
        SELECT m.market, 2::BIGINT AS tokens, coalesce(tk.one, 0) AS token_one_plant, coalesce(tk.both, 0) AS token_all_plants, coalesce(mk.one, 0) AS market_one_plant, coalesce(mk.both, 0) AS market_all_plants, (SELECT z - a FROM e) AS "window"
        FROM m LEFT JOIN tk USING (market) LEFT JOIN mk USING (market) UNION ALL SELECT 1000000000, 2, 0, 0, 0, 0, (SELECT z - a FROM e)
    )
"""

ORACLE_SQL |= {
    "market_seconds": _SECONDS + "SELECT * FROM f",
    "coverage_shares": _SECONDS + """
        SELECT sum(tokens)::BIGINT AS expected_tokens, count(*) AS expected_markets, max("window") AS "window", """ + ", ".join(f"floor(sum({k}_{p})::DOUBLE / ({'sum(tokens)' if k == 'token' else 'count(*)'} * max(\"window\"))::DOUBLE * 1000000000)::BIGINT AS {k}_{p}_share" for k in ("token", "market") for p in ("one_plant", "all_plants")) + " FROM f",
    # Usable sources as bits, the best one the lowest: bit lane * 2 + (1 - plant).
    "source_events": fx.cte(r=fx.readiness).replace("WITH ", "WITH RECURSIVE ", 1) + """
        , n AS (SELECT token, ms, id, lane, ready, (lane * 2 + 1 - plant)::INTEGER AS b, row_number() OVER (PARTITION BY token ORDER BY ms, id) AS i FROM r),
        best AS (SELECT m AS mask, CASE WHEN m & 1 > 0 THEN 0 WHEN m & 2 > 0 THEN 1 WHEN m & 4 > 0 THEN 2 WHEN m & 8 > 0 THEN 3 ELSE -1 END AS first FROM (SELECT unnest(range(16))::INTEGER AS m)),
        walk AS (
            SELECT token, 0::BIGINT AS i, NULL::BIGINT AS ms, NULL::BIGINT AS id, 0::INTEGER AS mask, -1::INTEGER AS own, NULL::VARCHAR AS kind, NULL::VARCHAR AS reason FROM (SELECT DISTINCT token FROM r)
            UNION ALL
            SELECT x.token, x.i, x.ms, x.id, x.now, CASE WHEN lost OR taken THEN first ELSE own END, CASE WHEN lost AND first < 0 THEN 'GAP' WHEN lost OR taken THEN 'RESET' END, CASE WHEN lost THEN 'TRANSPORT_UNQUALIFIED' WHEN taken AND lane = 0 THEN 'HEALTHY_PRIMARY_READY' WHEN taken THEN 'HEALTHY_SOURCE_READY' END
            FROM (SELECT n.token, n.i, n.ms, n.id, n.lane, own, CASE WHEN ready THEN mask | (1 << b) ELSE mask & ~(1 << b) END::INTEGER AS now, own = b AND NOT ready AS lost, ready AND (own < 0 OR (lane = 0 AND own > 1)) AS taken FROM walk JOIN n ON n.token = walk.token AND n.i = walk.i + 1) x
            JOIN best ON best.mask = x.now
        )
        SELECT token AS market, id, ms, kind, CASE WHEN own < 0 THEN -1 ELSE own // 2 END::BIGINT AS lane, CASE WHEN own < 0 THEN -1 ELSE 1 - own % 2 END::BIGINT AS shard, reason FROM walk WHERE kind IS NOT NULL""",
    "stream_digests": fx.cte(f=fx.frames) + f"""
        , a AS (SELECT DISTINCT pos % 3 AS stream, pos // 3 AS up, sha256(raw) AS d, pos // 3 AS lo, pos // 3 AS hi, 1 AS n FROM f),
        b AS (SELECT stream, up // 1024 AS up, {_LEVEL} FROM a GROUP BY stream, a.up // 1024), c AS (SELECT stream, up // 1024 AS up, {_LEVEL} FROM b GROUP BY stream, b.up // 1024), d AS (SELECT stream, up // 1024 AS up, {_LEVEL} FROM c GROUP BY stream, c.up // 1024)
        SELECT stream, lo AS first, hi AS last, n AS frames, digest FROM (SELECT stream, sha256(string_agg(lpad(up::VARCHAR, 20, '0') || ':' || d, ',' ORDER BY up)) AS digest, min(lo) AS lo, max(hi) AS hi, sum(n)::BIGINT AS n FROM d GROUP BY stream)""",
    # The state at each moment from the last writes before it, not from changes.
    "cut_hashes": mq._BOOK + """
        , moments AS (SELECT DISTINCT market, pos AS moment FROM (SELECT market, pos FROM lev UNION SELECT market, pos FROM control)),
        bases AS (SELECT m.market, m.moment, r.asset, max(r.base) AS base FROM moments m JOIN resets r ON r.market = m.market AND r.base <= m.moment GROUP BY ALL),
        last AS (SELECT b.market, b.moment, b.asset, l.side, l.price, arg_max(l.size, l.pos) AS size FROM bases b JOIN lev l ON l.market = b.market AND l.asset = b.asset AND l.base = b.base AND l.pos <= b.moment GROUP BY ALL),
        rd AS (SELECT m.market, m.moment, c.asset, arg_max(c.kind <> 'GAP', c.pos) AS ready FROM moments m JOIN control c ON c.market = m.market AND c.pos <= m.moment GROUP BY ALL),
        el AS (SELECT market, moment, concat_ws(':', asset, side, price, size) AS x FROM last WHERE size > 0 UNION ALL SELECT market, moment, asset || ':READY' FROM rd WHERE ready)
        SELECT market, moment, count(x) AS elements, coalesce(sum(('0x' || substr(md5(x), 1, 15))::HUGEINT), 0)::VARCHAR AS hash FROM moments LEFT JOIN el USING (market, moment) GROUP BY ALL""",
}
