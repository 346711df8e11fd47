"""Queries of reconciliation, rollups and registry changes, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from augury.operators import book, coverage, fills, reconcile, registry
from augury.sources import fixtures as fx
from augury.streaming import jobs


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def recent(spark, sf_dir):
    """Rows of the last day and the one before, read from a table by day; the window reaches an hour into yesterday."""
    path = f"{jobs.work_dir(spark)}/days"
    e = _read(spark, sf_dir, "events").withColumn("day", F.floor(F.unix_millis(F.col("ts").cast("timestamp")) / 86_400_000))
    e.select("day", "event_type", "event_id").write.partitionBy("day").parquet(path)
    today = e.agg(F.max("day")).first()[0] or 0
    return reconcile.recent_days(spark, path, "day", today, 1_800, 3_600).groupBy("day", "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))


def received(spark, sf_dir):
    e = fx.frame(spark, sf_dir, fx.book_events)
    return reconcile.receive_order(e.where("pos % 31 <> 5").select((F.col("market") % 7).alias("connection"), F.col("pos").alias("recv_seq"), F.floor(F.col("pos") / F.when(F.col("pos") % 50 < 2, 2).otherwise(1)).alias("id")))


def sample(spark, sf_dir):
    """A report of twenty order lines."""
    return reconcile.sampled(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").distinct(), ["l_orderkey", "l_partkey", "l_suppkey"], 42, 20)


def merged_streams(spark, sf_dir):
    e = fx.frame(spark, sf_dir, fx.prices)
    rows = e.select(F.col("asset").alias("stream"), F.col("id").alias("offset"), F.col("received_ms").alias("created"))
    return reconcile.merged_order(rows).select("stream", "offset", "at")


def pairs(spark, sf_dir):
    tokens = fx.frame(spark, sf_dir, fx.tokens)
    markets = tokens.groupBy("market_id").agg(F.max(F.when(F.col("outcome") == "Yes", F.col("token_id"))).alias("yes_token"), F.max(F.when(F.col("outcome") == "No", F.col("token_id"))).alias("no_token"))
    return reconcile.token_pairs(markets, tokens)


def _segments(spark, sf_dir):
    """Archive segments of a hundred offsets of a stream; those of some cells are lost."""
    t = fx.frame(spark, sf_dir, fx.book_events).select((F.col("market") % 5).alias("stream"), F.col("pos").alias("offset"), F.floor(F.col("pos") / 100).alias("segment"))
    return t.groupBy("stream", "segment").agg(F.min("offset").alias("first"), F.max("offset").alias("last")).where("(segment + stream) % 6 <> 2")


def segments(spark, sf_dir):
    t = fx.frame(spark, sf_dir, fx.book_events).select((F.col("market") % 5).alias("stream"), F.col("pos").alias("offset"))
    return reconcile.in_segments(t, _segments(spark, sf_dir)).select("stream", "offset", F.coalesce("segment", F.lit(-1)).alias("segment"))


def gaps(spark, sf_dir):
    e = fx.frame(spark, sf_dir, fx.book_events).where("kind = 'GAP'")
    states = fx.frame(spark, sf_dir, fx.readiness).select(F.col("token"), F.col("id").alias("at"), "ready", F.when(F.col("lane") == 0, "SNAPSHOT_MISSING").otherwise("STALE").alias("reason"))
    found = reconcile.gap_attribution(e.select((F.col("market") % 5).alias("stream"), F.col("pos").alias("offset"), F.col("market").alias("token"), F.col("pos").alias("at")), _segments(spark, sf_dir), states)
    return found.select("stream", "offset", "token", F.coalesce("segment", F.lit(-1)).alias("segment"), "cause")


def undisposed(spark, sf_dir):
    e = fx.frame(spark, sf_dir, fx.book_events).select((F.col("market") % 5).alias("stream"), F.col("pos").alias("offset"), "kind")
    return reconcile.without_disposition(e, e.where("offset % 9 <> 4"), ["stream", "offset"])


def _owners(spark, sf_dir):
    l = _read(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 7 + F.col("l_suppkey")).alias("key"), (F.col("l_suppkey") % 3).alias("owner"), F.col("l_orderkey").alias("o"))  # noqa: E741
    existing = l.where("o % 2 = 0").groupBy("key").agg(F.min("owner").alias("owner"))
    return reconcile.merge_owners(existing, l.where("o % 2 = 1").select("key", "owner"))


def owners(spark, sf_dir):
    return _owners(spark, sf_dir)[0]


def owner_conflicts(spark, sf_dir):
    return _owners(spark, sf_dir)[1].select("key", F.coalesce("owner", F.lit(-1)).alias("owner"), "first", "last")


def _ledger(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("c"), F.col("o_custkey")).alias("source"), F.col("o_orderkey").cast("string").alias("failure_key"), F.when(F.col("o_orderstatus") == "F", "normalize_error").otherwise("other").alias("kind"),
        F.when(F.col("o_orderkey") % 3 == 1, "closed").otherwise("open").alias("status"), (F.col("o_orderkey") % 5 + 1).alias("occurrences"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderkey") * 2).alias("checked_at"), F.col("o_orderkey").alias("first_seen"),
    )


def versions(spark, sf_dir):
    """A report of the ten oldest sources."""
    found = reconcile.failure_versions(_ledger(spark, sf_dir), 10)
    shown = F.array_join(F.transform(F.map_entries("versions"), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))), ",")
    return found.select("source", "oldest", shown.alias("versions"))


def _lanes(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    flag = lambda k, m: F.max((F.col("event_id") % k != m))
    return e.groupBy(F.col("user_id").alias("token"), (F.col("event_id") % 4).alias("lane")).agg(flag(11, 3).alias("expected"), F.min(F.col("event_id") % 17 != 2).alias("written"), F.min(F.col("event_id") % 13 != 5).alias("seen"), F.min(F.col("event_id") % 7 != 1).alias("ready"))


def stages(spark, sf_dir):
    return reconcile.stage_sets(_lanes(spark, sf_dir))


def _states(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    states = e.select(F.col("user_id").alias("token"), (F.col("event_id") % 3).alias("shard"), (F.col("event_id") % 2).alias("connection"), F.col("event_id").alias("id"))
    routes = e.groupBy(F.col("user_id").alias("token")).agg((F.max("event_id") % 3).alias("shard"), (F.max("event_id") % 2).alias("connection")).where("token % 10 <> 4")
    return reconcile.active_states(states, routes)


def active(spark, sf_dir):
    return _states(spark, sf_dir)[0]


def candidates(spark, sf_dir):
    return _states(spark, sf_dir)[1]


def lanes(spark, sf_dir):
    o = _read(spark, sf_dir, "orders").select((F.col("o_orderkey") % 3).cast("int").alias("lane"), F.col("o_custkey").alias("key"), F.unix_date(F.col("o_orderdate").cast("date")).alias("at"), F.col("o_orderkey").alias("id"))
    newest = o.groupBy("lane", "key", "at").agg(F.max("id").alias("id"))
    out = reconcile.merged_lanes(*[newest.where(F.col("lane") == k) for k in range(3)])
    return out.select("key", "at", "id", F.array_join(F.col("lanes").cast("array<string>"), ",").alias("lanes"))


def windows(spark, sf_dir):
    """Orders against a stored copy that lacks some, has some more and has some other totals."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    stored = o.where("o_orderkey % 101 <> 7 or o_orderkey % 2000 < 1000").withColumn("cents", F.when((F.col("o_orderkey") % 211 == 9) & (F.col("o_orderkey") % 2000 >= 1000), F.col("cents") + 1).otherwise(F.col("cents")))
    return reconcile.compare_windows(o.where("o_orderkey % 307 <> 11"), stored, ["o_orderkey"], "o_orderkey", 1000).drop("digest")


def pending(spark, sf_dir):
    rows = fx.frame(spark, sf_dir, fx.catalog_rows)
    p = F.col("id").cast("long")
    waiting = rows.where(p % 2 == 0).select(F.when(p % 16 == 6, F.concat(F.lit("0xno"), "id")).otherwise(F.col("conditionId")).alias("market"), F.when(p % 6 == 0, F.array((p * 10 + 2).cast("string"), (p * 10 + 1).cast("string"))).when(p % 6 == 2, F.array(F.lit("9"))).alias("assets")).where("market <> ''")
    found = reconcile.validate_pending(waiting, rows, 1_000, 60)
    return found.select("market", "action", F.coalesce("error", F.lit("")).alias("error"), F.coalesce("next_retry", F.lit(-1)).alias("next_retry"))


def shells(spark, sf_dir):
    m = fx.frame(spark, sf_dir, fx.unnamed_markets)
    ok = reconcile.strict_row(F.col("gamma_market_id"), F.col("condition_id"), tokens=(F.col("slug"), F.col("category")))
    return m.select("market_id", F.coalesce(reconcile.replaceable_shell(F.col("identity_kind"), F.col("gamma_market_id"), F.col("category"), F.col("slug")), F.lit(False)).alias("replaceable"), F.coalesce(ok, F.lit(False)).alias("strict"))


def promotions(spark, sf_dir):
    """A ledger of odd orders' customers after a scan of the even ones'."""
    o = _read(spark, sf_dir, "orders")
    side = lambda odd: o.where(F.col("o_orderkey") % 2 == odd).groupBy(F.col("o_custkey").cast("string").alias("condition_id")).agg(F.max("o_orderkey").cast("string").alias("payload"), F.min("o_orderkey").alias("first_seen"), F.max("o_orderkey").alias("last_seen"), F.count("*").alias("occurrences")).withColumn("status", F.lit("old" if odd else "new"))
    return reconcile.merge_promotions(side(1), side(0))


def fleet(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    nodes = e.groupBy(F.col("event_type").alias("role"), (F.col("user_id") % 20).alias("node")).agg(F.count("*").alias("records"), F.count_if(F.col("event_id") % 9 == 1).alias("errors"), (F.max("event_id") % 97).alias("p99_ms"), (F.min("event_id") % 11).alias("lag"))
    return coverage.fleet_health(nodes)


def storage(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    state = F.when(F.col("event_id") % 5 == 0, "pending").when(F.col("event_id") % 5 < 4, "committed").otherwise("evicted")
    return coverage.storage_rollup(e.select((F.col("user_id") % 9).alias("stream"), state.alias("state"), (F.col("event_id") % 1000).alias("bytes"), F.col("event_id").alias("at"))).fillna(-1)


def soak(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    return coverage.soak_windows(e.select((F.col("user_id") % 30).alias("key"), (F.col("event_id") * 3).alias("at"), F.col("event_id").alias("id"), F.floor(F.col("event_id") / 900).alias("fingerprint")), 120)


def gateway(spark, sf_dir):
    e = _read(spark, sf_dir, "events")
    m = e.groupBy(F.col("user_id").alias("market")).agg(F.max("event_id").alias("x"))
    plant = F.when(F.col("x") % 2 == 0, "P").otherwise("Q")
    g = m.where("market % 11 <> 3").select(
        "market", (F.col("x") % 7 != 1).alias("ready"), (F.col("x") % 13 == 2).alias("crossed"), F.col("x").alias("market_seq"), F.when(F.col("x") % 5 != 3, F.col("x") - F.when(F.col("x") % 6 == 0, 1).otherwise(0)).alias("source_seq"), plant.alias("plant"),
        F.when(F.col("x") % 9 == 4, "old").otherwise("s").alias("session"), F.lit("t").alias("stream"), (F.col("x") % 10).alias("parent_seq"), (F.col("x") % 8).alias("parent_offset"),
    )
    p = m.select(plant.alias("plant"), "market", F.lit("s").alias("session"), F.lit("t").alias("stream"), F.lit(8).cast("long").alias("committed_seq"), F.lit(6).cast("long").alias("applied_offset"))
    return coverage.gateway_checks(m, g, p).select("market", "ready", F.array_join("reasons", ",").alias("reasons"), "qualified")


def _upserts(spark, sf_dir):
    p = _read(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("c"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("condition_id"), "p_brand")
    known = p.where("p_partkey % 4 = 1")
    markets = known.select((F.col("p_partkey") * 2).alias("market_id"), "condition_id", F.lit("old").alias("category"))
    tokens = known.select((F.col("p_partkey") * 2).alias("market_id"), F.explode(F.array(F.struct((F.col("p_partkey") * 10).cast("string").alias("token_id"), F.lit(0).alias("outcome_index")), F.struct((F.col("p_partkey") * 10 + 1).cast("string").alias("token_id"), F.lit(1).alias("outcome_index")))).alias("t")).select("market_id", "t.token_id", (-F.col("market_id") * 2 - F.col("t.outcome_index")).alias("id"), "t.outcome_index")
    own = F.when(F.col("p_partkey") % 12 == 2, F.col("p_partkey") - 1).otherwise(F.col("p_partkey"))  # some claim the tokens of the one before
    rows = p.where("p_partkey % 3 = 2").select("condition_id", (own * 10).cast("string").alias("yes_token"), (own * 10 + 1).cast("string").alias("no_token"), F.col("p_brand").alias("category"))
    return registry.upsert_registry(rows, markets, tokens)


def upserted(spark, sf_dir):
    return _upserts(spark, sf_dir)[0]


def upserted_tokens(spark, sf_dir):
    return _upserts(spark, sf_dir)[1]


def upsert_conflicts(spark, sf_dir):
    return _upserts(spark, sf_dir)[2]


def recovered(spark, sf_dir):
    pages = fx.frame(spark, sf_dir, fx.pages)
    latest = pages.select(F.col("id").cast("string").alias("failure_key"), (F.col("id") % 2).alias("generation"), "id", "payload")
    ledger = pages.select(F.col("id").cast("string").alias("failure_key"), F.lit(0).cast("long").alias("generation"), F.when(F.col("id") % 5 == 3, "closed").otherwise("open").alias("status"))
    markets = registry.normalize_markets(pages)[0].where("id % 3 <> 0").select("condition_id")
    return registry.recover_failures(ledger, latest, markets)


def rules(spark, sf_dir):
    """Rounds that bind to their rule."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    url = registry.RULE_URL % "btc"
    text = F.when(k % 7 == 3, "no rule").otherwise(f"Up if the time-weighted average is greater than or equal to the start, see {url}")
    tokens = F.array((k * 2 + 1).cast("string"), (k * 2 + F.when(k % 11 == 4, 1).otherwise(2)).cast("string"))
    rows = o.select(
        F.lit("BTC").alias("asset"), (k * 300_000).alias("start_ms"), (k * 300_000 + F.when(k % 13 == 5, 1).otherwise(300_000)).alias("end_ms"), F.concat(F.lit("btc-updown-5m-"), (k * 300).cast("string")).alias("slug"), F.lit(url).alias("source"), text.alias("description"),
        F.lit("v2").alias("version"), F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(k)), 64, "0")).alias("condition_id"), F.when(k % 2 == 0, F.array(F.lit("Up"), F.lit("down"))).otherwise(F.array(F.lit("Down"), F.lit("UP"))).alias("labels"), tokens.alias("tokens"),
    )
    return registry.bind_rules(rows)[0].select("condition_id", "up_token", "down_token", F.substring("rule_version", 1, 7).alias("rule_version"))


def fact_layout(spark, sf_dir):
    """Facts written by block range, read back by range."""
    path = f"{jobs.work_dir(spark)}/facts"
    owned = fills.owners(fx.frame(spark, sf_dir, fx.markets), fx.frame(spark, sf_dir, fx.tokens))
    fills.write_facts(fills.project_fills(fills.decode_fills(fx.frame(spark, sf_dir, fx.logs))[0], owned)[0], path)
    return spark.read.parquet(path).groupBy("block_bucket").agg(F.count("*").alias("n"), F.min("block_number").alias("first"), F.max("block_number").alias("last"))


QUERIES = {
    "recent_days": recent, "receive_order": received, "deterministic_sample": sample, "merged_streams": merged_streams, "token_pairs": pairs, "archive_segments": segments, "gap_attribution": gaps, "without_disposition": undisposed,
    "owner_map": owners, "owner_map_conflicts": owner_conflicts, "failure_versions": versions, "stage_sets": stages, "active_states": active, "candidate_states": candidates, "merged_lanes": lanes, "repair_windows": windows, "pending_validation": pending,
    "shell_and_strict": shells, "promotion_ledger": promotions, "fleet_health": fleet, "storage_rollup": storage, "soak_windows": soak, "gateway_checks": gateway, "registry_upsert": upserted, "registry_upsert_tokens": upserted_tokens, "registry_conflicts": upsert_conflicts, "recovered_failures": recovered,
    "bound_rules": rules, "fact_layout": fact_layout,
}

_SEGMENTS = fx.cte(ev=fx.book_events) + """
    , sg AS (SELECT market % 5 AS stream, pos // 100 AS segment, min(pos) AS first, max(pos) AS last FROM ev GROUP BY ALL HAVING (segment + stream) % 6 <> 2)
"""
_OWNERS = """
    WITH l AS (SELECT l_partkey * 7 + l_suppkey AS key, l_suppkey % 3 AS owner, l_orderkey % 2 AS odd FROM lineitem), g AS (SELECT key, min(owner) FILTER (odd = 0) AS a, min(owner) FILTER (odd = 1) AS b, max(owner) FILTER (odd = 1) AS c FROM l GROUP BY key)
"""
_STATES = """
    WITH s AS (SELECT user_id AS token, event_id % 3 AS shard, event_id % 2 AS connection, event_id AS id FROM events), r AS (SELECT user_id AS token, max(event_id) AS x FROM events WHERE user_id % 10 <> 4 GROUP BY 1),
    m AS (SELECT s.*, coalesce(shard = x % 3 AND connection = x % 2, false) AS is_on FROM s LEFT JOIN r USING (token))
"""
_UPSERT = """
    WITH r AS (SELECT p_partkey AS p, CASE WHEN p_partkey % 12 = 2 THEN p_partkey - 1 ELSE p_partkey END AS own, p_brand FROM part WHERE p_partkey % 3 = 2),
    j AS (SELECT r.*, own <> p AND own % 4 = 1 AS taken, count(*) OVER (PARTITION BY own) > 1 AS twice FROM r), ok AS (SELECT * FROM j WHERE NOT taken AND NOT twice),
    u AS (
        SELECT p_partkey * 2 AS market_id, 'c' || lpad(p_partkey::VARCHAR, 9, '0') AS condition_id, coalesce(ok.p_brand, 'old') AS category, p_partkey AS own, false AS fresh FROM part LEFT JOIN ok ON ok.p = p_partkey WHERE p_partkey % 4 = 1
        UNION ALL SELECT (SELECT max(p_partkey) * 2 FROM part WHERE p_partkey % 4 = 1) + row_number() OVER (ORDER BY p), 'c' || lpad(p::VARCHAR, 9, '0'), p_brand, own, true FROM ok WHERE p % 4 <> 1
    )
"""
from augury.plans.fill_queries import ORACLE_SQL as _FILLS  # noqa: E402
from augury.plans.registry_queries import _PAGES  # noqa: E402

ORACLE_SQL = {
    "recent_days": "WITH d AS (SELECT epoch_ms(ts) // 86400000 AS day, event_type, event_id FROM events) SELECT day, event_type, count(*) AS n, max(event_id) AS last FROM d WHERE day >= (SELECT max(day) - 1 FROM d) GROUP BY ALL",
    "receive_order": fx.cte(ev=fx.book_events) + """
        , r AS (SELECT market % 7 AS connection, pos AS s, pos // CASE WHEN pos % 50 < 2 THEN 2 ELSE 1 END AS id FROM ev WHERE pos % 31 <> 5), l AS (SELECT *, lag(s) OVER (PARTITION BY connection ORDER BY s) AS p FROM r)
        SELECT connection, count(*) AS records, count(*) FILTER (s <> p + 1) AS breaks, count(*) - count(DISTINCT id) AS repeats FROM l GROUP BY 1""",
    "deterministic_sample": "SELECT DISTINCT ON (h) l_orderkey, l_partkey, l_suppkey FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, sha256('42|' || l_orderkey || '|' || l_partkey || '|' || l_suppkey) AS h FROM lineitem) ORDER BY h LIMIT 20",
    "merged_streams": fx.cte(p=fx.prices) + "SELECT asset AS stream, id AS offset, max(received_ms) OVER (PARTITION BY asset ORDER BY id) AS at FROM p",
    "token_pairs": fx.cte(t=fx.tokens) + """
        , g AS (SELECT market_id, count(*) AS owned, max(token_id) FILTER (outcome = 'Yes') AS y, max(token_id) FILTER (outcome = 'No') AS n, max(token_id) FILTER (outcome_index = 0) AS s0, max(token_id) FILTER (outcome_index = 1) AS s1 FROM t GROUP BY 1)
        SELECT market_id, owned, coalesce(owned = 2 AND y = s0 AND n = s1, false) AS verified FROM g""",
    "archive_segments": _SEGMENTS + "SELECT market % 5 AS stream, pos AS offset, coalesce(segment, -1) AS segment FROM ev LEFT JOIN sg ON sg.stream = market % 5 AND pos BETWEEN first AND last",
    "gap_attribution": _SEGMENTS.replace("WITH ", "WITH " + fx.cte(rd=fx.readiness)[5:] + ", ", 1) + """
        , g AS (SELECT market % 5 AS stream, pos, market AS token, coalesce(segment, -1) AS segment FROM ev LEFT JOIN sg ON sg.stream = market % 5 AND pos BETWEEN first AND last WHERE kind = 'GAP'),
        s AS (SELECT g.*, r.ready, r.lane, r.id FROM g ASOF LEFT JOIN rd r ON r.token = g.token AND r.id <= g.pos)
        SELECT stream, pos AS offset, token, segment, CASE WHEN segment < 0 THEN 'NOT_ARCHIVED' WHEN id IS NULL THEN 'NO_STATE' WHEN NOT ready THEN CASE lane WHEN 0 THEN 'SNAPSHOT_MISSING' ELSE 'STALE' END ELSE 'UNEXPLAINED' END AS cause FROM s""",
    "without_disposition": fx.cte(ev=fx.book_events) + "SELECT market % 5 AS stream, pos AS offset, kind FROM ev WHERE pos % 9 = 4",
    "owner_map": _OWNERS + "SELECT key, coalesce(a, b) AS owner FROM g",
    "owner_map_conflicts": _OWNERS + "SELECT key, coalesce(a, -1) AS owner, b AS first, c AS last FROM g WHERE b <> c OR a <> b OR a <> c",
    "failure_versions": """
        WITH l AS (SELECT 'c' || o_custkey AS source, o_orderkey AS k, o_orderkey % 5 + 1 AS n, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey * 2 ELSE o_orderkey END AS "at" FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 1)
        SELECT source, min("at") AS oldest, string_agg(k || '=' || n, ',' ORDER BY k::VARCHAR) AS versions FROM l GROUP BY source ORDER BY oldest, source LIMIT 10""",
    "stage_sets": """
        WITH s AS (SELECT user_id AS token, event_id % 4 AS lane, bool_or(event_id % 11 <> 3) AS e, bool_and(event_id % 17 <> 2) AS w, bool_and(event_id % 13 <> 5) AS b, bool_and(event_id % 7 <> 1) AS r FROM events GROUP BY ALL)
        SELECT token, lane, 'EXPECTED_NOT_WRITTEN' AS stage FROM s WHERE e AND NOT w UNION ALL SELECT token, lane, 'WRITTEN_NOT_SEEN' FROM s WHERE w AND NOT b UNION ALL SELECT token, lane, 'EXPECTED_NOT_READY' FROM s WHERE e AND NOT r""",
    "active_states": _STATES + "SELECT token, shard, connection, id, count(*) OVER (PARTITION BY token) > 1 AS duplicate FROM m WHERE is_on",
    "candidate_states": _STATES + "SELECT token, shard, connection, id FROM m WHERE NOT is_on",
    "merged_lanes": """
        WITH o AS (SELECT (o_orderkey % 3)::INT AS lane, o_custkey AS key, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::INT AS "at", max(o_orderkey) AS id FROM orders GROUP BY ALL)
        SELECT key, max("at") AS "at", last(id ORDER BY "at", lane) AS id, string_agg(DISTINCT lane::VARCHAR, ',' ORDER BY lane::VARCHAR) AS lanes FROM o GROUP BY key""",
    "repair_windows": """
        WITH f AS (SELECT o_orderkey // 1000 AS w, o_orderkey % 307 <> 11 AS e, o_orderkey % 101 <> 7 OR o_orderkey % 2000 < 1000 AS s, o_orderkey % 211 = 9 AND o_orderkey % 2000 >= 1000 AS d FROM orders)
        SELECT w AS "window", count(*) FILTER (e) AS expected, count(*) FILTER (s) AS stored, count(*) FILTER (e AND NOT s) AS missing, count(*) FILTER (s AND NOT e) AS superfluous, count(*) FILTER (e AND s AND d) AS changed, count(*) FILTER (e <> s OR (e AND s AND d)) = 0 AS verified
        FROM f GROUP BY w HAVING count(*) FILTER (e OR s) > 0""",
    "pending_validation": fx.cte(r=fx.catalog_rows) + """
        , x AS (
            SELECT id::BIGINT AS p, "conditionId" AS c, CASE version WHEN 'V2' THEN 2 WHEN '2' THEN 2 WHEN 'v3' THEN 3 ELSE 1 END AS v, id::BIGINT % 11 IN (3, 4) AS odd, len(outcomes::JSON::VARCHAR[]) AS n, closed OR coalesce("enableOrderBook" = false, false) AS gone FROM r
        ), y AS (
            SELECT CASE WHEN p % 16 = 6 THEN '0xno' || p ELSE c END AS market, CASE WHEN p % 16 = 6 THEN 'NO_ANSWER' WHEN gone THEN 'gone' WHEN v = 3 THEN 'UNSUPPORTED_MARKET_VERSION' WHEN v = 1 AND odd THEN 'UNRESOLVED_BINARY_IDENTITY' WHEN n <> 2 THEN 'OUTCOME_MAPPING_MISSING'
                WHEN p % 6 = 2 OR (p % 6 = 0 AND v = 2) THEN 'NATIVE_GAMMA_TOKEN_MISMATCH' ELSE '' END AS e FROM x WHERE p % 2 = 0 AND (c <> '' OR p % 16 = 6)
        )
        SELECT market, CASE e WHEN 'gone' THEN 'EXCLUDE' WHEN '' THEN 'UPSERT' ELSE 'RETRY' END AS action, CASE e WHEN 'gone' THEN '' ELSE e END AS error, CASE WHEN e IN ('gone', '') THEN -1 ELSE 1060 END AS next_retry FROM y""",
    "shell_and_strict": fx.cte(m=fx.unnamed_markets) + """
        SELECT market_id, coalesce(trim(gamma_market_id), '') = '' AND (lower(category) = 'orderfilled-placeholder' OR slug LIKE 'trade-indexer-placeholder-%') AS replaceable, coalesce(trim(gamma_market_id), '') <> '' AND slug <> category AS strict FROM m""",
    "promotion_ledger": """
        WITH g AS (SELECT o_custkey::VARCHAR AS condition_id, max(o_orderkey) FILTER (o_orderkey % 2 = 1) AS a, max(o_orderkey) FILTER (o_orderkey % 2 = 0) AS b, min(o_orderkey) AS first_seen, max(o_orderkey) AS last_seen, count(*) AS occurrences FROM orders GROUP BY 1)
        SELECT condition_id, coalesce(b, a)::VARCHAR AS payload, first_seen, last_seen, occurrences, CASE WHEN a IS NULL THEN 'new' ELSE 'old' END AS status FROM g""",
    "fleet_health": """
        WITH n AS (SELECT event_type AS role, user_id % 20 AS node, count(*) AS records, count(*) FILTER (event_id % 9 = 1) AS errors, max(event_id) % 97 AS p99, min(event_id) % 11 AS lag FROM events GROUP BY ALL)
        SELECT role, count(*) AS nodes, sum(records)::BIGINT AS records, sum(errors)::BIGINT AS errors, max(p99) AS max_p99_ms, min(p99) AS min_p99_ms, count(*) FILTER (p99 > 50) AS slow_nodes, max(lag) AS max_lag FROM n GROUP BY role""",
    "storage_rollup": """
        WITH s AS (SELECT user_id % 9 AS stream, event_id % 5 AS k, event_id % 1000 AS b, event_id AS "at" FROM events)
        SELECT stream, coalesce(sum(b) FILTER (k = 0), 0)::BIGINT AS pending, coalesce(sum(b) FILTER (k BETWEEN 1 AND 3), 0)::BIGINT AS committed, coalesce(sum(b) FILTER (k = 4), 0)::BIGINT AS evicted, coalesce(min("at") FILTER (k = 0), -1) AS oldest_pending FROM s GROUP BY stream""",
    "soak_windows": """
        WITH s AS (SELECT user_id % 30 AS key, event_id * 3 AS "at", event_id // 900 AS f FROM events), l AS (SELECT *, lag("at") OVER w AS pa, lag(f) OVER w AS pf FROM s WINDOW w AS (PARTITION BY key ORDER BY "at")),
        n AS (SELECT *, sum(CASE WHEN pa IS NULL OR "at" - pa > 120 OR f <> pf THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY "at") AS session FROM l)
        SELECT key, session::BIGINT AS session, min("at") AS "from", max("at") AS "to", count(*) AS samples FROM n GROUP BY ALL""",
    "gateway_checks": """
        WITH m AS (SELECT user_id AS market, max(event_id) AS x FROM events GROUP BY 1),
        g AS (SELECT *, market % 11 <> 3 AND x % 7 <> 1 AND x % 13 <> 2 AS ready, x % 5 <> 3 AND x % 6 <> 0 AS at_source, x % 5 <> 3 AS source FROM m),
        r AS (
            SELECT market, ready, list_filter([CASE WHEN NOT ready THEN 'GATEWAY_PAIR_NOT_READY' END, CASE WHEN ready AND NOT at_source THEN 'COMMITTED_SOURCE_EVIDENCE_MISSING' END,
                CASE WHEN market % 11 <> 3 AND source AND x % 9 = 4 THEN 'GATEWAY_SOURCE_SESSION_MISMATCH' END, CASE WHEN market % 11 <> 3 AND source AND (x % 10 > 8 OR x % 8 > 6) THEN 'GATEWAY_PARENT_OUTSIDE_CAPTURED_PLANT_PREFIX' END], lambda v: v IS NOT NULL) AS w FROM g
        )
        SELECT market, ready, array_to_string(w, ',') AS reasons, len(w) = 0 AS qualified FROM r""",
    "registry_upsert": _UPSERT + "SELECT market_id, condition_id, category FROM u",
    "registry_upsert_tokens": _UPSERT + """
        SELECT p_partkey * 2 AS market_id, (p_partkey * 10 + s)::VARCHAR AS token_id, -p_partkey * 4 - s AS id, s AS outcome_index FROM part, (SELECT unnest([0, 1]) AS s) WHERE p_partkey % 4 = 1
        UNION ALL SELECT market_id, (own * 10 + s)::VARCHAR, -(2 * market_id - 1 + s), s FROM u, (SELECT unnest([0, 1]) AS s) WHERE fresh""",
    "registry_conflicts": _UPSERT + "SELECT 'c' || lpad(p::VARCHAR, 9, '0') AS condition_id, CASE WHEN taken THEN 'token belongs to another condition' ELSE 'token claimed twice in batch' END AS reason FROM j WHERE taken OR twice",
    "recovered_failures": _PAGES + "SELECT id::VARCHAR AS failure_key, 0::BIGINT AS generation, CASE WHEN id % 5 = 3 THEN 'closed' WHEN id % 2 = 0 AND reason IS NULL AND id % 3 <> 0 THEN 'resolved' ELSE 'open' END AS status FROM k",
    "bound_rules": """
        SELECT '0x' || lpad(lower(to_hex(o_orderkey)), 64, '0') AS condition_id, (o_orderkey * 2 + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END)::VARCHAR AS up_token, (o_orderkey * 2 + CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END)::VARCHAR AS down_token, 'twap60:' AS rule_version
        FROM orders WHERE o_orderkey % 7 <> 3 AND o_orderkey % 11 <> 4 AND o_orderkey % 13 <> 5""",
    "fact_layout": f"SELECT block_number // 1000000 AS block_bucket, count(*) AS n, min(block_number) AS first, max(block_number) AS last FROM ({_FILLS['fill_facts']}) GROUP BY 1",
}
