"""Queries over fills and the table kit, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augury.operators import fills, tables
from augury.sources import fixtures as fx
from augury.sources.shared import written

text = lambda *names: [F.col(n).cast("string").alias(n) for n in names]


def _fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fills.decode_fills(fx.frame(spark, sf_dir, fx.logs))[0]


def _owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fills.owners(fx.frame(spark, sf_dir, fx.markets), fx.frame(spark, sf_dir, fx.tokens))


def decoded(spark, sf_dir):
    return _fills(spark, sf_dir).select("contract", "event_version", "tx_hash", "log_index", "block_number", "order_hash", "maker", "taker", "token_id", "side", *text("price", "size", "maker_amount", "taker_amount", "fee"))


def rejected(spark, sf_dir):
    return fills.decode_fills(fx.frame(spark, sf_dir, fx.logs))[1].select("tx_hash", "log_index", "reason")


def owner_rows(spark, sf_dir):
    return _owned(spark, sf_dir)


def facts(spark, sf_dir):
    found = fills.project_fills(_fills(spark, sf_dir), _owned(spark, sf_dir))[0]
    return found.select("tx_hash", "log_index", "market_id", "token_id", "outcome_code", "side_code", "block_number", *text("price", "size"))


def gaps(spark, sf_dir):
    return fills.rollup_gaps(fills.project_fills(_fills(spark, sf_dir), _owned(spark, sf_dir))[1])


def volume(spark, sf_dir):
    """Flagship: traded volume by market and outcome."""
    found = fills.project_fills(_fills(spark, sf_dir), _owned(spark, sf_dir))[0]
    usdc = F.when(F.col("side_code") == 1, F.col("maker_amount")).otherwise(F.col("taker_amount"))
    return found.groupBy("market_id", "outcome_code").agg(F.count("*").alias("fills"), F.sum(usdc).cast("long").alias("usdc"), F.sum(F.col("size") * 1_000_000).cast("long").alias("size_micro"), *[f("price").cast("string").alias(n) for f, n in ((F.min, "low"), (F.max, "high"))])


def replay(spark, sf_dir):
    """Gaps after tokens got owners: every token counts as known once its inactive or indexless row is repaired."""
    all_fills, owned = _fills(spark, sf_dir), _owned(spark, sf_dir)
    open_ = fills.rollup_gaps(fills.project_fills(all_fills, owned)[1])
    repaired = fx.frame(spark, sf_dir, fx.tokens).withColumn("active", F.lit(True)).withColumn("outcome_index", F.when(F.col("outcome_index") > 1, 1).otherwise(F.col("outcome_index")))
    later = fills.owners(fx.frame(spark, sf_dir, fx.markets), repaired)
    got, state = fills.replay_gaps(open_, all_fills, later)
    counts = got.groupBy("token_id").agg(F.count("*").alias("replayed"))
    return state.join(counts, "token_id", "left").select("token_id", "status", "seen_count", F.coalesce("replayed", F.lit(0)).alias("replayed"))


def key_audit(spark, sf_dir):
    """Audit by block window: the sink lacks some keys, holds others twice, and has one that the chain lacks."""
    chain = fx.frame(spark, sf_dir, fx.logs).select((F.floor(F.col("block_number") / 100_000)).alias("bucket"), "address", "tx_hash", "log_index")
    kept = chain.where((F.col("log_index") % 13) != 5)
    sink = kept.unionByName(kept.where((F.col("log_index") % 17) == 2)).unionByName(chain.where((F.col("log_index") % 19) == 3).withColumn("log_index", F.col("log_index") + 1000))
    return tables.audit_keys(chain, sink, ["bucket", "address", "tx_hash", "log_index"], ["bucket"])


def appended(spark, sf_dir):
    """Keys of a batch that are appended, and of those that repeat in it."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"))
    new, twice = fills.append_new(lines.where("part % 5 = 0").select("order", "line").distinct(), lines.where("part % 5 <> 0"), ["order", "line"])
    mark = lambda df, what: df.groupBy("order", "line").agg(F.count("*").alias("n")).withColumn("what", F.lit(what))
    return mark(new, "new").unionByName(mark(twice, "repeated"))


def safe(spark, sf_dir):
    found = written(_fills(spark, sf_dir).select("contract", "block_number"), "fills")  # decoded once for head and rows
    return fills.safe_rows(found, 200_000).groupBy("contract").agg(F.count("*").alias("n"), F.max("block_number").alias("last"))


def windows(spark, sf_dir):
    """Fills by planned block window."""
    found = written(_fills(spark, sf_dir).groupBy("block_number").agg(F.count("*").alias("n")), "blocks")
    edge = found.agg(F.min("block_number").alias("lo"), F.max("block_number").alias("hi")).first()
    if edge["lo"] is None:
        return spark.createDataFrame([], "from_block long, to_block long, n long")
    planned = fills.plan_windows(spark, edge["lo"] - 1, edge["hi"], 50_000)
    counts = found.groupBy((F.floor((F.col("block_number") - edge["lo"]) / 50_000) * 50_000 + edge["lo"]).alias("from_block")).agg(F.sum("n").alias("n"))
    return planned.join(counts, "from_block", "left").select("from_block", "to_block", F.coalesce("n", F.lit(0)).alias("n"))


def scanned(spark, sf_dir):
    """Logs of one window and known contracts; the second legacy contract starts late."""
    starts = dict.fromkeys((*fx.LEGACY, *fx.CURRENT), 0) | {fx.LEGACY[1]: 3_000_000}
    return fills.scan_logs(fx.frame(spark, sf_dir, fx.logs), 2_500_000, 3_500_000, starts, [fx.LEGACY_TOPIC, fx.CURRENT_TOPIC]).select("address", "tx_hash", "log_index", "block_number")


def block_times(spark, sf_dir):
    """Fills by whether their block has one time: some blocks have none, some two."""
    found = written(_fills(spark, sf_dir).select("block_number"), "fills")
    blocks = found.select("block_number").distinct().where("block_number % 7 <> 0")
    blocks = blocks.select("block_number", (F.col("block_number") * 2).alias("block_time"), F.lit("a").alias("block_hash")).unionByName(
        blocks.where("block_number % 11 = 3").select("block_number", (F.col("block_number") * 2).alias("block_time"), F.lit("b").alias("block_hash"))
    )
    timed, bad = fills.attach_block_time(found, blocks)
    return timed.select(F.lit("timed").alias("what"), "block_time").unionByName(bad.select(F.col("reason").alias("what"), F.lit(0).cast("long").alias("block_time"))).groupBy("what").agg(F.count("*").alias("n"), F.sum("block_time").cast("long").alias("times"))


def latest_fill(spark, sf_dir):
    """Last fill of each token by place."""
    return tables.latest_by(_fills(spark, sf_dir), ["token_id"], ["block_number", "log_index", "tx_hash"]).select("token_id", "block_number", "log_index", "tx_hash", "side", *text("price"))


def merged_gaps(spark, sf_dir):
    """Gaps of early fills merged with those of all later ones."""
    open_ = written(fills.project_fills(_fills(spark, sf_dir), _owned(spark, sf_dir))[1].select("token_id", "block_number", "log_index", "tx_hash"), "open")
    early, late = open_.where("block_number % 2 = 0"), open_.where("block_number % 2 = 1")
    return fills.merge_gaps(fills.rollup_gaps(early), fills.rollup_gaps(late))


QUERIES = {
    "fills_decoded": decoded, "fills_rejected": rejected, "token_owners": owner_rows, "fill_facts": facts, "fill_gaps": gaps, "market_volume": volume,
    "gap_replay": replay, "key_audit": key_audit, "append_new_keys": appended, "safe_head": safe, "block_windows": windows, "log_scan": scanned,
    "block_times": block_times, "latest_fill": latest_fill, "gap_merge": merged_gaps,
}

_DECODE = """
    , w AS (
        SELECT *, substr(data, 3) AS b, len(data) - 2 AS n FROM logs
    ), v AS (
        SELECT *, CASE WHEN topic0 = '{old}' AND address IN {olds} THEN 'legacy' WHEN topic0 = '{new}' AND address IN {news} THEN 'v2026' END AS event_version,
            substr(b, 1, 64) AS w0, substr(b, 65, 64) AS w1, ('0x' || substr(b, 177, 16))::BIGINT AS maker_amount,
            ('0x' || substr(b, 241, 16))::BIGINT AS taker_amount, try_cast('0x' || substr(b, 305, 16) AS BIGINT) AS fee FROM w
    ), s AS (
        SELECT *, CASE WHEN event_version = 'legacy' THEN CASE WHEN w0 = repeat('0', 64) AND w1 <> repeat('0', 64) THEN 'BUY' WHEN w1 = repeat('0', 64) AND w0 <> repeat('0', 64) THEN 'SELL' END
            ELSE CASE w0 WHEN repeat('0', 64) THEN 'BUY' WHEN repeat('0', 63) || '1' THEN 'SELL' END END AS side FROM v
    ), decided AS (
        SELECT *, CASE WHEN event_version = 'legacy' AND side = 'SELL' THEN w0 ELSE w1 END AS token_id,
            CASE WHEN side = 'BUY' THEN maker_amount ELSE taker_amount END AS usdc, CASE WHEN side = 'BUY' THEN taker_amount ELSE maker_amount END AS tok,
            CASE WHEN n_topics <> 4 THEN 'four topics required' WHEN event_version IS NULL THEN 'unknown topic and address' WHEN n % 64 <> 0 THEN 'data is not words'
                WHEN n // 64 <> CASE event_version WHEN 'legacy' THEN 5 ELSE 7 END THEN 'wrong number of words' WHEN side IS NULL THEN 'invalid side or asset'
                WHEN tok <= 0 THEN 'token amount must be positive' END AS reason FROM s
    ), fills AS (
        SELECT address AS contract, event_version, substr(tx_hash, 3) AS tx_hash, log_index, block_number, substr(topic1, 3) AS order_hash, '0x' || right(topic2, 40) AS maker, '0x' || right(topic3, 40) AS taker,
            token_id, side, (usdc // tok)::VARCHAR || '.' || lpad(((usdc % tok)::HUGEINT * 10000000000 // tok)::VARCHAR, 10, '0') AS price,
            (tok // 1000000)::VARCHAR || '.' || lpad((tok % 1000000)::VARCHAR, 6, '0') || '0000' AS size, maker_amount, taker_amount, fee, usdc, tok
        FROM decided WHERE reason IS NULL
    )
""".format(old=fx.LEGACY_TOPIC, new=fx.CURRENT_TOPIC, olds=fx.LEGACY, news=fx.CURRENT)

_OWNED = """
    , owned AS (
        SELECT t.token_id, t.market_id, t.condition_id, t.outcome, t.outcome_index, m.identity_kind
        FROM {tokens} t JOIN markets m ON m.market_id = t.market_id
        WHERE t.active AND t.condition_id <> '' AND lower(t.condition_id) = lower(m.condition_id)
            AND m.identity_kind NOT IN ('legacy_placeholder', 'legacy_ghost', 'invalid_shell') AND lower(m.category) NOT IN ('ghost', '[ghost]', 'orderfilled-placeholder', 'invalid-identity-shell')
            AND lower(m.slug) NOT LIKE 'ghost-market-%' AND lower(m.slug) NOT LIKE 'trade-indexer-placeholder-%'
    )
"""
_FACTS = """
    , matched AS (
        SELECT f.*, o.market_id, o.outcome_index, o.identity_kind, coalesce(o.outcome_index IN (0, 1), false) AS known FROM fills f LEFT JOIN owned o ON o.token_id = f.token_id
    ), facts AS (
        SELECT *, CASE WHEN contract = '{combo}' OR identity_kind = 'official_combo' THEN 0 ELSE outcome_index + 1 END AS outcome_code, CASE side WHEN 'BUY' THEN 1 ELSE 2 END AS side_code FROM matched WHERE known
    ), gaps AS (
        SELECT token_id, 'open' AS status, min(block_number) AS first_seen_block, max(block_number) AS last_seen_block,
            first(tx_hash ORDER BY block_number, log_index, tx_hash) AS first_tx_hash, last(tx_hash ORDER BY block_number, log_index, tx_hash) AS last_tx_hash,
            first(log_index ORDER BY block_number, log_index, tx_hash) AS first_log_index, last(log_index ORDER BY block_number, log_index, tx_hash) AS last_log_index, count(*) AS seen_count
        FROM matched WHERE NOT known GROUP BY token_id
    )
""".replace("{combo}", fills.COMBO_EXCHANGE)

_BASE = fx.cte(logs=fx.logs) + _DECODE
_ALL = fx.cte(logs=fx.logs, markets=fx.markets, tokens=fx.tokens) + _DECODE + _OWNED.replace("{tokens}", "tokens") + _FACTS

ORACLE_SQL = {
    "fills_decoded": _BASE + "SELECT contract, event_version, tx_hash, log_index, block_number, order_hash, maker, taker, token_id, side, price, size, maker_amount::VARCHAR AS maker_amount, taker_amount::VARCHAR AS taker_amount, fee::VARCHAR AS fee FROM fills",
    "fills_rejected": _BASE + "SELECT tx_hash, log_index, reason FROM decided WHERE reason IS NOT NULL",
    "token_owners": fx.cte(markets=fx.markets, tokens=fx.tokens) + _OWNED.replace("{tokens}", "tokens") + "SELECT * FROM owned",
    "fill_facts": _ALL + "SELECT tx_hash, log_index, market_id, token_id, outcome_code, side_code, block_number, price, size FROM facts",
    "fill_gaps": _ALL + "SELECT * FROM gaps",
    "market_volume": _ALL + "SELECT market_id, outcome_code, count(*) AS fills, sum(usdc)::BIGINT AS usdc, sum(tok)::BIGINT AS size_micro, min(price) AS low, max(price) AS high FROM facts GROUP BY ALL",
    "gap_replay": _ALL + """
        , later AS (
            SELECT t.token_id, least(t.outcome_index, 1) AS i FROM tokens t JOIN markets m ON m.market_id = t.market_id
            WHERE t.condition_id <> '' AND lower(t.condition_id) = lower(m.condition_id) AND m.identity_kind NOT IN ('legacy_placeholder', 'invalid_shell') AND lower(m.category) <> 'ghost' AND m.slug NOT LIKE 'ghost-market-%'
        )
        SELECT token_id, CASE WHEN i IS NULL THEN 'open' ELSE 'resolved' END AS status, seen_count, CASE WHEN i IS NULL THEN 0 ELSE seen_count END AS replayed FROM gaps LEFT JOIN later USING (token_id)""",
    "key_audit": fx.cte(logs=fx.logs) + """
        , chain AS (SELECT block_number // 100000 AS bucket, address || tx_hash || '/' || log_index AS k, log_index AS i, address || tx_hash || '/' || (log_index + 1000) AS other FROM logs),
        sink AS (
            SELECT bucket, k FROM chain WHERE i % 13 <> 5 UNION ALL SELECT bucket, k FROM chain WHERE i % 13 <> 5 AND i % 17 = 2 UNION ALL SELECT bucket, other FROM chain WHERE i % 19 = 3
        ), e AS (SELECT bucket, k, count(*) AS n FROM chain GROUP BY ALL), a AS (SELECT bucket, k, count(*) AS n FROM sink GROUP BY ALL),
        j AS (SELECT bucket, coalesce(e.n, 0) AS e, coalesce(a.n, 0) AS a FROM e FULL JOIN a USING (bucket, k))
        SELECT bucket, count(*) FILTER (e > 0) AS expected_keys, count(*) FILTER (a > 0) AS actual_keys, sum(greatest(e - 1, 0))::BIGINT AS expected_duplicates, sum(greatest(a - 1, 0))::BIGINT AS actual_duplicates,
            count(*) FILTER (a = 0) AS missing, count(*) FILTER (e = 0) AS extra, bool_and(e = 1 AND a = 1) AS exact FROM j GROUP BY bucket""",
    "append_new_keys": """
        WITH batch AS (SELECT l_orderkey AS "order", l_linenumber AS line, count(*) AS n FROM lineitem WHERE l_partkey % 5 <> 0 GROUP BY ALL),
        old AS (SELECT DISTINCT l_orderkey AS "order", l_linenumber AS line FROM lineitem WHERE l_partkey % 5 = 0)
        SELECT "order", line, n, 'repeated' AS what FROM batch WHERE n > 1
        UNION ALL SELECT "order", line, n, 'new' FROM batch ANTI JOIN old USING ("order", line) WHERE n = 1""",
    "safe_head": _BASE + "SELECT contract, count(*) AS n, max(block_number) AS last FROM fills WHERE block_number <= (SELECT max(block_number) FROM fills) - 200000 GROUP BY contract",
    "block_windows": _BASE + """
        , e AS (SELECT min(block_number) AS lo, max(block_number) AS hi FROM fills), p AS (SELECT unnest(range(lo, hi + 1, 50000)) AS from_block, hi FROM e)
        SELECT from_block, least(from_block + 49999, hi) AS to_block, (SELECT count(*) FROM fills WHERE block_number BETWEEN from_block AND from_block + 49999) AS n FROM p""",
    "log_scan": fx.cte(logs=fx.logs) + f"SELECT address, tx_hash, log_index, block_number FROM logs WHERE block_number BETWEEN 2500000 AND 3500000 AND topic0 <> '0xff' AND (address <> '{fx.LEGACY[1]}' OR block_number >= 3000000)",
    "block_times": _BASE + """
        SELECT CASE WHEN block_number % 7 = 0 THEN 'block without time' WHEN block_number % 11 = 3 THEN 'conflicting block' ELSE 'timed' END AS what, count(*) AS n,
            sum(CASE WHEN block_number % 7 = 0 OR block_number % 11 = 3 THEN 0 ELSE 2 * block_number END)::BIGINT AS times FROM fills GROUP BY 1""",
    "latest_fill": _BASE + "SELECT token_id, block_number, log_index, tx_hash, side, price FROM fills QUALIFY row_number() OVER (PARTITION BY token_id ORDER BY block_number DESC, log_index DESC, tx_hash DESC) = 1",
    "gap_merge": _ALL + """
        , part AS (
            SELECT token_id, block_number % 2 AS late, min(block_number) AS lo, max(block_number) AS hi, first(tx_hash ORDER BY block_number, log_index, tx_hash) AS ta, last(tx_hash ORDER BY block_number, log_index, tx_hash) AS tb,
                first(log_index ORDER BY block_number, log_index, tx_hash) AS ia, last(log_index ORDER BY block_number, log_index, tx_hash) AS ib, count(*) AS n FROM matched WHERE NOT known GROUP BY ALL
        )
        SELECT token_id, 'open' AS status, min(lo) AS first_seen_block, max(hi) AS last_seen_block, first(ta ORDER BY late) AS first_tx_hash, last(tb ORDER BY late) AS last_tx_hash,
            first(ia ORDER BY late) AS first_log_index, last(ib ORDER BY late) AS last_log_index, max(n) AS seen_count FROM part GROUP BY token_id""",
}
