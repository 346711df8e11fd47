"""Queries over the registry, probes, catalogue and streams, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from augury.operators import book, catalogue, fills, registry
from augury.sources import fixtures as fx
from augury.streaming import jobs


def _shown(good):
    keys = [c for c in ("ordinal",) if c in good.columns]
    return good.select("id", *keys, "condition_id", "yes_token", "no_token", "yes_outcome", "no_outcome", F.coalesce(F.col("yes_price").cast("double"), F.lit(-1.0)).alias("yes_price"), F.array_join("tags", ",").alias("tags"), "category", F.coalesce("event_slug", F.lit("")).alias("event_slug"), "is_closed", F.coalesce("created_us", F.lit(-1)).alias("created_us"))


def normalized(spark, sf_dir):
    return _shown(registry.normalize_markets(fx.frame(spark, sf_dir, fx.pages))[0])


def rejects(spark, sf_dir):
    return registry.normalize_markets(fx.frame(spark, sf_dir, fx.pages))[1]


def event_normalized(spark, sf_dir):
    return _shown(registry.normalize_markets(registry.event_markets(fx.frame(spark, sf_dir, fx.event_pages)))[0])


def event_rejects(spark, sf_dir):
    return registry.normalize_markets(registry.event_markets(fx.frame(spark, sf_dir, fx.event_pages)))[1]


def identities(spark, sf_dir):
    """Every catalogue row in one of the three outputs."""
    eligible, excluded, unresolved = registry.catalog_identity(fx.frame(spark, sf_dir, fx.catalog_rows))
    out = eligible.select("id", F.lit("ELIGIBLE").alias("outcome"), F.concat_ws(",", "asset_id_kind", "assets").alias("detail"))
    return out.unionByName(excluded.select("id", F.lit("EXCLUDED").alias("outcome"), F.lit("").alias("detail"))).unionByName(unresolved.select("id", F.lit("UNRESOLVED").alias("outcome"), F.col("reason").alias("detail")))


def classes(spark, sf_dir):
    return registry.identity_classes(fx.frame(spark, sf_dir, fx.unnamed_markets)).select("market_id", F.coalesce("target_kind", F.lit("")).alias("target_kind"), "marks")


def gate(spark, sf_dir):
    return registry.identity_gate(registry.identity_classes(fx.frame(spark, sf_dir, fx.unnamed_markets)))


def violations(spark, sf_dir):
    return registry.rule_violations(fx.frame(spark, sf_dir, fx.unnamed_markets))


def _claims(spark, sf_dir):
    """Every order line is a claim of its order, or, in one order of nine, owned by it already."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("condition_id"), (F.col("l_partkey") * 50 + F.col("l_suppkey")).alias("token"))
    return lines.where("condition_id % 9 < 8").distinct(), lines.where("condition_id % 9 = 8").groupBy("token").agg(F.min("condition_id").alias("condition_id"))


def accepted(spark, sf_dir):
    return registry.filter_claims(*_claims(spark, sf_dir))[0]


def blocked(spark, sf_dir):
    return registry.filter_claims(*_claims(spark, sf_dir))[1]


def ledger(spark, sf_dir):
    """Ledger of rejected catalogue rows after a second scan that saw only some of them."""
    bad = rejects(spark, sf_dir).select(F.col("id").cast("string").alias("failure_key"), "reason")
    seen = lambda at, status: bad.select("failure_key", "reason", F.lit(1).cast("long").alias("occurrences"), F.lit(at).alias("first_seen"), F.lit(at).alias("last_seen"), F.lit(status).alias("status"))
    first = seen(1, "open").withColumn("status", F.when(F.col("failure_key").cast("long") % 3 == 0, "closed").otherwise("open"))
    return registry.merge_failures(first.where("cast(failure_key as long) % 5 <> 1"), seen(2, "open").where("cast(failure_key as long) % 2 = 0"))


def _catalog_events(spark, sf_dir):
    """Events of entries; the identity now and then differs, the body more often, and entries of one cell share an asset."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("m", F.col("user_id") * 20 + F.col("event_id") % 20)
    action = F.when(F.col("event_type") == "error", "EXCLUDE").when(F.col("event_type") == "signup", "NEW").when(F.col("event_id") % 11 == 3, "RESOLVE").otherwise("UPSERT")
    identity = F.when(F.col("event_id") % 13 == 5, "other").otherwise("own")
    body = F.concat(identity, F.when(F.col("event_id") % 7 == 2, "-b").otherwise("-a"))
    assets = F.array(F.concat(F.lit("a"), F.col("m")), F.when(F.col("m") % 10 == 7, F.concat(F.lit("s"), F.floor(F.col("m") / 100))).otherwise(F.concat(F.lit("b"), F.col("m"))))
    return e.select(F.col("m").alias("market"), F.col("event_id").alias("seq"), action.alias("action"), identity.alias("identity"), body.alias("body"), assets.alias("assets"), F.when(F.col("event_id") % 3 == 1, catalogue.REVALIDATED).otherwise("SCAN").alias("source"))


def catalog_state(spark, sf_dir):
    return catalogue.fold(_catalog_events(spark, sf_dir))[0].select("market", "state", "revision", F.coalesce("body", F.lit("")).alias("body"))


def catalog_changes(spark, sf_dir):
    return catalogue.fold(_catalog_events(spark, sf_dir))[1]


def _catalog_streamed(spark, sf_dir):
    folder = jobs.work_dir(spark)
    files = jobs.write_in_order(_catalog_events(spark, sf_dir), "seq", f"{folder}/events", 4)
    return jobs.catalog_stream(jobs.file_stream(spark, f"{folder}/events", files), folder)


def streamed_catalog(spark, sf_dir):
    """The changes from four micro-batches."""
    return spark.read.schema(f"{catalogue.CHANGE}, batch int").parquet(_catalog_streamed(spark, sf_dir)[1]).drop("batch")


def streamed_entries(spark, sf_dir):
    entries = _catalog_streamed(spark, sf_dir)[0]
    return jobs.last_entries(spark, entries).select("market", "state", "revision", F.coalesce("body", F.lit("")).alias("body"))


def probes(spark, sf_dir):
    return registry.probe_health(fx.frame(spark, sf_dir, fx.probes), 3_600_000 * 24)[0]


def probe_sessions(spark, sf_dir):
    return registry.probe_health(fx.frame(spark, sf_dir, fx.probes), 3_600_000 * 24)[1]


def streamed_rounds(spark, sf_dir):
    events = jobs.file_stream(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = jobs.work_dir(spark)
    jobs.drain(jobs.rounds_stream(events, "1 day"), folder)
    return spark.read.schema("start long, event_type string, n long").parquet(f"{folder}/out")


def streamed_keys(spark, sf_dir):
    """Users and types that came through the deduplicating stream."""
    events = jobs.file_stream(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = jobs.work_dir(spark)
    jobs.drain(jobs.dedupe_stream(events, ["user_id", "event_type"], "3650 days").select("user_id", "event_type"), folder)
    return spark.read.schema("user_id long, event_type string").parquet(f"{folder}/out").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


def streamed_tape(spark, sf_dir):
    """Tape with lost rows, applied as a stream."""
    folder = jobs.work_dir(spark)
    tape = book.sequence_tape(fx.frame(spark, sf_dir, fx.book_events)).where("pos % 29 <> 4").select("market", "pos", "kind", F.col("market_seq").cast("long").alias("market_seq"))
    tape.write.parquet(f"{folder}/tape")
    jobs.drain(jobs.tape_apply_stream(jobs.file_stream(spark, f"{folder}/tape")), folder)
    return spark.read.schema("market long, pos long, status string").parquet(f"{folder}/out")


def streamed_fills(spark, sf_dir):
    folder = jobs.work_dir(spark)
    fx.frame(spark, sf_dir, fx.logs).write.parquet(f"{folder}/logs")
    owned = fills.owners(fx.frame(spark, sf_dir, fx.markets), fx.frame(spark, sf_dir, fx.tokens))
    facts, _ = jobs.fills_stream(jobs.file_stream(spark, f"{folder}/logs"), owned, folder)
    return facts.select("tx_hash", "log_index", "market_id", "token_id", "outcome_code", "side_code", "block_number", *[F.col(c).cast("string").alias(c) for c in ("price", "size")])


QUERIES = {
    "market_normalized": normalized, "market_rejects": rejects, "event_markets_normalized": event_normalized, "event_market_rejects": event_rejects, "catalog_identity": identities, "identity_marks": classes, "identity_gate": gate, "rule_violations": violations, "probe_sessions": probe_sessions, "claims_accepted": accepted, "claims_blocked": blocked, "claims_accepted_all": accepted, "claims_blocked_all": blocked, "failure_ledger": ledger, "catalog_state": catalog_state, "catalog_changes": catalog_changes, "stream_catalog": streamed_catalog, "stream_catalog_entries": streamed_entries,
    "probe_health": probes, "stream_rounds": streamed_rounds, "stream_dedupe": streamed_keys, "stream_tape": streamed_tape, "stream_fills": streamed_fills,
}



def _list(j: str) -> str:
    """Entries of a JSON list, or of JSON text of one; null if it is none."""
    inner = f"try_cast({j}->>'$' AS JSON)"
    return f"(CASE json_type({j}) WHEN 'ARRAY' THEN ({j})::VARCHAR[] WHEN 'VARCHAR' THEN CASE json_type({inner}) WHEN 'ARRAY' THEN ({inner})::VARCHAR[] END END)"


def _bad(j: str) -> str:
    return f"(coalesce({j}->>'$', '') <> '' AND {_list(j)} IS NULL)"


_TEXT = "nullif(trim(regexp_replace(%s, '\\s+', ' ', 'g')), '')"
_LABEL = "lower(" + _TEXT % "CASE WHEN x LIKE '{%%' THEN coalesce(nullif(x::JSON->>'slug', ''), x::JSON->>'label') ELSE x END" + ")"


def _tags(j: str) -> str:
    return f"(CASE WHEN coalesce({j}->>'$', '') = '' THEN [] ELSE coalesce({_list(j)}, [{j}->>'$']) END)"


def _normal(source: str) -> str:
    """The rules over a table src (id, ordinal, payload, event) of JSON texts."""
    first = lambda a, b: f"coalesce(CASE WHEN coalesce(m->>'{a}', '') <> '' THEN m->'{a}' END, m->'{b}')"
    clean = lambda x: f"list_transform({x}, lambda x: coalesce({_TEXT % 'x'}, ''))"
    return source + f"""
    , j0 AS (SELECT id, ordinal, try_cast(payload AS JSON) AS m, try_cast(event AS JSON) AS given FROM src),
    j AS (SELECT id, ordinal, CASE json_type(m) WHEN 'OBJECT' THEN m END AS m, coalesce(given, m->'events'->0) AS e FROM j0),
    f AS (
        SELECT id, ordinal, m, e, lower({_TEXT % first('conditionId', 'condition_id').replace("m->'", "m->>'")}) AS c, {first('clobTokenIds', 'clob_token_ids')} AS tk, m->'outcomes' AS oj, {first('outcomePrices', 'outcome_prices')} AS pj, m->'tags' AS mt, e->'tags' AS et,
            lower(m->>'closed') AS cl, m->>'createdAt' AS cr FROM j
    ), g AS (
        SELECT *, CASE WHEN c LIKE '0x%' THEN c ELSE '0x' || c END AS condition_id, {clean(_list('tk'))} AS t, {clean(_list('oj'))} AS oc, {_list('pj')} AS pr, {_bad('tk')} AS bt, {_bad('oj')} AS bo, {_bad('pj')} AS bp,
            list_filter(list_transform({_tags('mt')} || {_tags('et')}, lambda x: {_LABEL}), lambda x: x IS NOT NULL) AS tg,
            CASE WHEN cl IN ('true', '1') THEN true WHEN cl IN ('false', '0') THEN false WHEN cl IS NULL THEN true END AS is_closed, CASE WHEN cr LIKE '2024%123456789Z' THEN 1714979289123456 WHEN cr LIKE '2024%' THEN 1714979289000000 WHEN cr IS NULL THEN -1 END AS created_us,
            list_filter(list_transform([m->>'category', e->>'category', e->>'subcategory'] || coalesce(CASE WHEN json_type(e->'categories') = 'ARRAY' THEN (e->'categories')::VARCHAR[] END, CASE WHEN json_type(m->'categories') = 'ARRAY' THEN (m->'categories')::VARCHAR[] END, []), lambda x: {_LABEL}), lambda x: x IS NOT NULL) AS named FROM f
    ), k AS (
        SELECT *, [x for x, i in tg if list_position(tg, x) = i] AS tags, CASE WHEN m IS NULL OR coalesce(m->>'id', '') = '' THEN 'no id' WHEN c IS NULL THEN 'no condition' WHEN bt THEN 'tokens are no list' WHEN len(t) <> 2 OR list_contains(t, '') OR t[1] = t[2] THEN 'two distinct tokens required'
            WHEN bo THEN 'outcomes are no list' WHEN len(oc) <> 2 OR list_contains(oc, '') THEN 'two outcomes required' WHEN upper(oc[1]) = upper(oc[2]) AND upper(oc[1]) IN ('YES', 'NO', 'UP', 'DOWN') THEN 'outcomes are the same label'
            WHEN bp THEN 'prices are no list' WHEN len(pr) NOT IN (0, 2) THEN 'two prices required' WHEN list_max(list_transform(pr, lambda x: x::DOUBLE)) > 1 THEN 'price out of range' WHEN is_closed IS NULL THEN 'not a boolean' WHEN created_us IS NULL THEN 'not a time' END AS reason,
            CASE WHEN upper(oc[1]) = 'NO' AND upper(oc[2]) = 'YES' OR upper(oc[1]) = 'DOWN' AND upper(oc[2]) = 'UP' THEN 2 ELSE 1 END AS y FROM g
    )
"""


#: The primary categories, in order of preference: fixed values.
_PRIMARY = "['politics', 'sports', 'crypto', 'weather', 'economy', 'economics', 'finance', 'tech', 'science', 'pop-culture']"
_SHOWN = f"""condition_id, t[y] AS yes_token, t[3 - y] AS no_token, oc[y] AS yes_outcome, oc[3 - y] AS no_outcome, coalesce(pr[y]::DOUBLE, -1) AS yes_price, array_to_string(tags, ',') AS tags,
    coalesce(named[1], list_filter({_PRIMARY}, lambda x: list_contains(tags, x))[1], tags[1], 'other') AS category, coalesce(e->>'slug', '') AS event_slug, is_closed, created_us FROM k WHERE reason IS NULL"""
_PAGES = _normal(fx.cte(pg=fx.pages) + ", src AS (SELECT id, 0 AS ordinal, payload, NULL::VARCHAR AS event FROM pg)")
_EVENTS = _normal(fx.cte(pg=fx.event_pages) + """
    , r AS (SELECT id, payload AS event, try_cast(payload AS JSON)->'markets' AS ms FROM pg), u AS (SELECT id, event, unnest(ms::JSON[]) AS x, unnest(range(len(ms::JSON[]))) AS ordinal FROM r WHERE json_type(ms) = 'ARRAY'),
    src AS (SELECT id, ordinal::INTEGER AS ordinal, x::VARCHAR AS payload, event FROM u WHERE json_type(x) = 'OBJECT')""")
_CLAIMS = """
    WITH c AS (SELECT DISTINCT l_orderkey AS condition_id, l_partkey * 50 + l_suppkey AS token FROM lineitem WHERE l_orderkey % 9 < 8),
    o AS (SELECT l_partkey * 50 + l_suppkey AS token, min(l_orderkey) AS owner FROM lineitem WHERE l_orderkey % 9 = 8 GROUP BY 1),
    r AS (
        SELECT c.condition_id, bool_or(coalesce(o.owner <> c.condition_id, false)) AS taken, bool_or(EXISTS (SELECT 1 FROM c d WHERE d.token = c.token AND d.condition_id <> c.condition_id)) AS twice
        FROM c LEFT JOIN o ON o.token = c.token GROUP BY 1
    )
"""
#: The states one event at a time, as a recursion over the events of an entry, or of all entries that share an asset.
_CATALOG = """
    WITH RECURSIVE e AS (
        SELECT user_id * 20 + event_id % 20 AS market, event_id AS seq, CASE WHEN event_type = 'error' THEN 'EXCLUDE' WHEN event_type = 'signup' THEN 'NEW' WHEN event_id % 11 = 3 THEN 'RESOLVE' ELSE 'UPSERT' END AS action,
            CASE WHEN event_id % 13 = 5 THEN 'other' ELSE 'own' END AS identity, identity || CASE WHEN event_id % 7 = 2 THEN '-b' ELSE '-a' END AS body, event_id % 3 = 1 AS again FROM events
    ), n AS (SELECT *, CASE WHEN market % 10 = 7 THEN market // 100 END AS shared FROM e),
    -- Entries that share an asset are walked together, all others alone.
    w AS (SELECT *, coalesce('s' || shared, 'm' || market) AS g, row_number() OVER (PARTITION BY coalesce('s' || shared, 'm' || market) ORDER BY seq) AS i FROM n),
    walk AS (
        SELECT g, 0::BIGINT AS i, NULL::BIGINT AS market, NULL::BIGINT AS seq, NULL::VARCHAR AS change, NULL::VARCHAR AS state, NULL::VARCHAR AS body, MAP {}::MAP(BIGINT, VARCHAR) AS states, MAP {}::MAP(BIGINT, VARCHAR) AS bodies, NULL::BIGINT AS owner FROM (SELECT DISTINCT g FROM w)
        UNION ALL
        SELECT g, i, market, seq, change, new_state, new_body, map_concat(states, MAP {market: new_state}), map_concat(bodies, MAP {market: new_body}), CASE WHEN change = 'UPSERT' AND shared IS NOT NULL THEN coalesce(owner, market) ELSE owner END FROM (
            SELECT *, CASE change WHEN 'TERMINAL' THEN 'TERMINAL' WHEN 'PENDING_VALIDATION' THEN 'PENDING_VALIDATION' WHEN 'SCOPE_EXCLUDED' THEN 'EXCLUDED_SCOPE' WHEN 'UPSERT' THEN 'ELIGIBLE' WHEN 'IDENTITY_QUARANTINED' THEN 'QUARANTINED' WHEN 'TOKEN_OWNERSHIP_CONFLICT' THEN 'QUARANTINED' ELSE was END AS new_state,
                CASE WHEN change IN ('UPSERT', 'TOKEN_OWNERSHIP_CONFLICT') THEN body ELSE own END AS new_body FROM (
                SELECT *, CASE WHEN action = 'RESOLVE' THEN CASE WHEN was IS DISTINCT FROM 'TERMINAL' THEN 'TERMINAL' END WHEN action = 'NEW' THEN CASE WHEN was IS NULL THEN 'PENDING_VALIDATION' END
                    WHEN action = 'EXCLUDE' THEN CASE WHEN was IN ('PENDING_VALIDATION', 'ELIGIBLE', 'QUARANTINED') THEN 'SCOPE_EXCLUDED' END WHEN was IN ('TERMINAL', 'QUARANTINED') OR (was = 'EXCLUDED_SCOPE' AND NOT again) THEN NULL
                    WHEN split_part(own, '-', 1) <> identity THEN 'IDENTITY_QUARANTINED' WHEN own = body AND was = 'ELIGIBLE' THEN NULL WHEN shared IS NOT NULL AND owner <> event_market THEN 'TOKEN_OWNERSHIP_CONFLICT' ELSE 'UPSERT' END AS change FROM (
                    SELECT w.g, w.i, w.market, w.seq, w.action, w.identity, w.body, w.again, w.shared, w.market AS event_market, walk.states, walk.bodies, walk.owner, walk.states[w.market] AS was, walk.bodies[w.market] AS own FROM walk JOIN w ON w.g = walk.g AND w.i = walk.i + 1
                )
            )
        )
    ), c AS (SELECT market, seq, state, change, body, row_number() OVER (PARTITION BY market ORDER BY seq) AS revision FROM walk WHERE change IS NOT NULL)
"""

_MARKS = fx.cte(m=fx.unnamed_markets) + """
    , l AS (SELECT market_id, lower(category) AS c, lower(slug) AS s, lower(coalesce(tags, '')) AS t, condition_id FROM m),
    k AS (
        SELECT market_id, list_filter([CASE WHEN c = 'orderfilled-placeholder' OR s LIKE 'trade-indexer-placeholder-%' THEN 'legacy_placeholder' END, CASE WHEN t LIKE '%data-api-combo%' OR (s LIKE 'combo-%' AND t LIKE '%combo%') THEN 'legacy_combo' END,
            CASE WHEN c IN ('ghost', '[ghost]') OR s LIKE 'ghost-market-%' OR (t LIKE '%orphaned%' AND t LIKE '%unknown%') THEN 'legacy_ghost' END, CASE WHEN s LIKE 'onchain-condition-v2-%' THEN 'chain_v2' END,
            CASE WHEN trim(condition_id) = '0x' || repeat('0', 64) THEN 'invalid_shell' END], lambda x: x IS NOT NULL) AS kinds FROM l
    )
"""
_PROBES = fx.cte(p=fx.probes) + """
    , l AS (SELECT *, lag(kind) OVER w AS pk, lag(ms) OVER w AS pms FROM p WINDOW w AS (PARTITION BY connection, session ORDER BY ms, id)),
    a AS (SELECT *, kind = 'PING' AND coalesce(pk = 'PING', false) AS overlap FROM l), s AS (SELECT connection, session, min((ms, id)) FILTER (overlap) AS since FROM a GROUP BY ALL),
    k AS (SELECT a.*, kind = 'PONG' AND coalesce(pk = 'PING', false) AND (since IS NULL OR (ms, id) < since) AS matched FROM a JOIN s USING (connection, session))
"""

from augury.plans.fill_queries import ORACLE_SQL as _FILLS  # noqa: E402

ORACLE_SQL = {
    "market_normalized": _PAGES + f"SELECT id, {_SHOWN}",
    "market_rejects": _PAGES + "SELECT id, reason FROM k WHERE reason IS NOT NULL",
    "event_markets_normalized": _EVENTS + f"SELECT id, ordinal, {_SHOWN}",
    "event_market_rejects": _EVENTS + "SELECT id, ordinal, reason FROM k WHERE reason IS NOT NULL",
    "catalog_identity": fx.cte(r=fx.catalog_rows) + """
        , v AS (SELECT *, CASE version WHEN NULL THEN '1' WHEN 'V2' THEN '2' WHEN '2' THEN '2' WHEN 'v3' THEN '3' ELSE '1' END AS ver FROM r), a AS (SELECT *, (CASE ver WHEN '1' THEN "clobTokenIds" ELSE "positionIds" END)::JSON::VARCHAR[] AS x, len(outcomes::JSON::VARCHAR[]) AS n FROM v),
        o AS (
            SELECT id, ver, x, CASE WHEN closed OR "enableOrderBook" = false THEN 'EXCLUDED' WHEN ver = '3' THEN 'UNSUPPORTED_MARKET_VERSION' WHEN x[1] = x[2] OR x[2] = 'x' THEN 'UNRESOLVED_BINARY_IDENTITY' WHEN n <> 2 THEN 'OUTCOME_MAPPING_MISSING'
                WHEN "conditionId" = '' THEN 'MARKET_ID_MISSING' ELSE 'ELIGIBLE' END AS w FROM a
        )
        SELECT id, CASE WHEN w IN ('EXCLUDED', 'ELIGIBLE') THEN w ELSE 'UNRESOLVED' END AS outcome, CASE w WHEN 'EXCLUDED' THEN '' WHEN 'ELIGIBLE' THEN CASE ver WHEN '1' THEN 'CLOB_TOKEN_ID' ELSE 'POSITION_ID' END || ',' || x[1] || ',' || x[2] ELSE w END AS detail FROM o""",
    "identity_marks": _MARKS + "SELECT market_id, coalesce(kinds[1], '') AS target_kind, len(kinds) AS marks FROM k",
    "identity_gate": _MARKS + """
        SELECT count(*) AS total, count(*) FILTER (kinds[1] = 'legacy_placeholder') AS legacy_placeholder, count(*) FILTER (kinds[1] = 'legacy_combo') AS legacy_combo, count(*) FILTER (kinds[1] = 'legacy_ghost') AS legacy_ghost, count(*) FILTER (kinds[1] = 'chain_v2') AS chain_v2,
            count(*) FILTER (kinds[1] = 'invalid_shell') AS invalid_shell, count(*) FILTER (len(kinds) = 0) AS unclassified, count(*) FILTER (len(kinds) > 1) AS overlapping, max(len(kinds)) = 1 AND min(len(kinds)) = 1 AS passed FROM k""",
    "rule_violations": fx.cte(m=fx.unnamed_markets) + """
        , g AS (SELECT market_id, identity_kind AS k, coalesce(trim(gamma_market_id), '') <> '' AS s FROM m)
        SELECT market_id, 'identity kind' AS rule FROM g WHERE k = 'other' UNION ALL SELECT market_id, 'canonical without source' FROM g WHERE k = 'canonical_gamma' AND NOT s
        UNION ALL SELECT market_id, 'source without canonical kind' FROM g WHERE s AND k NOT IN ('canonical_gamma', 'canonical_clob')""",
    "claims_accepted": _CLAIMS + "SELECT condition_id FROM r WHERE NOT taken AND NOT twice",
    "claims_blocked": _CLAIMS + "SELECT condition_id, CASE WHEN taken THEN 'token belongs to another condition' ELSE 'token claimed twice in batch' END AS reason FROM r WHERE taken OR twice",
    "claims_accepted_all": _CLAIMS + "SELECT condition_id FROM r WHERE NOT taken AND NOT twice",
    "claims_blocked_all": _CLAIMS + "SELECT condition_id, CASE WHEN taken THEN 'token belongs to another condition' ELSE 'token claimed twice in batch' END AS reason FROM r WHERE taken OR twice",
    "failure_ledger": _PAGES + """
        , x AS (SELECT id, reason, id % 5 <> 1 AS a, id % 2 = 0 AS b FROM k WHERE reason IS NOT NULL)
        SELECT id::VARCHAR AS failure_key, reason, a::BIGINT + b::BIGINT AS occurrences, CASE WHEN a THEN 1 ELSE 2 END AS first_seen, CASE WHEN b THEN 2 ELSE 1 END AS last_seen, CASE WHEN a AND id % 3 = 0 THEN 'closed' ELSE 'open' END AS status FROM x WHERE a OR b""",
    "catalog_state": _CATALOG + "SELECT market, last(state ORDER BY seq) AS state, max(revision) AS revision, coalesce(last(body ORDER BY seq), '') AS body FROM c GROUP BY market",
    "catalog_changes": _CATALOG + "SELECT market, seq, state, change, revision FROM c",
    "probe_health": _PROBES + """
        SELECT id, connection, session, ms - pms AS rtt_ms, ms - pms > 86400000 AS late, count(*) OVER l3 = 3 AND max(ms - pms) OVER l3 <= 86400000 AS healthy
        FROM k WHERE matched WINDOW l3 AS (PARTITION BY connection, session ORDER BY ms, id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "probe_sessions": _PROBES + "SELECT connection, session, count(*) FILTER (kind = 'PING') AS pings, count(*) FILTER (matched) AS answers, count(*) FILTER (kind = 'PONG' AND NOT matched) AS unmatched, bool_or(overlap) AS ambiguous FROM k GROUP BY ALL",
    "stream_rounds": "WITH d AS (SELECT epoch_us(date_trunc('day', ts)) // 1000000 AS start, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT * FROM d WHERE start + 86400 <= (SELECT (epoch_us(max(ts)) - 600000000) // 1000000 FROM events)",
    "stream_dedupe": "SELECT user_id, event_type, 1::BIGINT AS n FROM events GROUP BY ALL",
    "stream_tape": fx.cte(ev=fx.book_events) + """
        , t AS (SELECT market, pos, kind, row_number() OVER (PARTITION BY market ORDER BY pos) AS s FROM ev), l AS (SELECT *, lag(s) OVER (PARTITION BY market ORDER BY pos) AS p FROM t WHERE pos % 29 <> 4),
        r AS (SELECT *, sum(CASE kind WHEN 'RESET' THEN 1 ELSE 0 END) OVER (PARTITION BY market ORDER BY pos) AS epoch FROM l),
        b AS (SELECT *, sum(CASE WHEN kind <> 'RESET' AND s IS DISTINCT FROM p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY market, epoch ORDER BY pos) AS bad FROM r)
        SELECT market, pos, CASE WHEN kind = 'RESET' THEN 'RESET' WHEN epoch > 0 AND bad = 0 THEN 'APPLIED' ELSE 'RESET_REQUIRED' END AS status FROM b""",
    "stream_fills": _FILLS["fill_facts"],
}
ORACLE_SQL |= {"stream_catalog": ORACLE_SQL["catalog_changes"], "stream_catalog_entries": ORACLE_SQL["catalog_state"]}
