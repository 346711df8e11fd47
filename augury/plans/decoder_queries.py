"""Queries over event decoders and sinks, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from augury.operators import book, decoders
from augury.sources import fixtures as fx
from augury.sources import sinks
from augury.streaming import jobs

CONDITIONS = {"0x04": "ConditionPreparation", "0x05": "ConditionResolution"}
REQUESTS = {"0x01": "RequestPrice", "0x02": "Settle"}


def conditions(spark, sf_dir):
    good = decoders.decode_ctf(fx.frame(spark, sf_dir, fx.condition_logs), CONDITIONS)[0]
    return good.select("tx_hash", "log_index", "status", "condition_id", "oracle", "question_id", "slots", F.coalesce(F.array_join("numerators", ","), F.lit("")).alias("numerators"))


def condition_rejects(spark, sf_dir):
    return decoders.decode_ctf(fx.frame(spark, sf_dir, fx.condition_logs), CONDITIONS)[1].select("tx_hash", "reason")


def requests(spark, sf_dir):
    good = decoders.decode_oracle_requests(fx.frame(spark, sf_dir, fx.request_logs), REQUESTS)[0]
    return good.select("block_number", "oracle", "status", "requester", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("proposer", "price", "payout")], "text")


def request_rejects(spark, sf_dir):
    return decoders.decode_oracle_requests(fx.frame(spark, sf_dir, fx.request_logs), REQUESTS)[1].select("block_number", "reason")


def tape_sink(spark, sf_dir):
    tape = book.sequence_tape(fx.frame(spark, sf_dir, fx.book_events)).select((F.col("market") % 5).alias("stream"), F.col("pos").alias("offset"), "market", "kind", "market_seq")
    return sinks.write_tape(tape, f"{jobs.work_dir(spark)}/tape").select("stream", "first", "last", "n")


def observation_sink(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("position"), "source", F.col("text").alias("raw"))
    return sinks.write_observations(rows, f"{jobs.work_dir(spark)}/observations", 100)


ADAPTERS = {"0x11": "QuestionInitialized", "0x12": "QuestionReset", "0x13": "QuestionResolved", "0x14": "QuestionSettled"}
MODULES = {"0x21": "ConditionResolved", "0x22": "ResultReported", "0x23": "CombinatorialConditionPrepared", "0x24": "Upgraded", "0x25": "MigrationResolved"}


def adapters(spark, sf_dir):
    good = decoders.decode_adapter_events(fx.frame(spark, sf_dir, fx.adapter_logs), ADAPTERS, "0xold")[0]
    flag = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return good.select("block_number", "adapter", "status", "question_id", flag("price"), flag("emergency"), flag("early"), F.coalesce(F.decode(F.unhex("ancillary_hex"), "UTF-8"), F.lit("")).alias("text"))


def adapter_rejects(spark, sf_dir):
    return decoders.decode_adapter_events(fx.frame(spark, sf_dir, fx.adapter_logs), ADAPTERS, "0xold")[1].select("block_number", "reason")


def prepared(spark, sf_dir):
    return decoders.decode_prepared(fx.frame(spark, sf_dir, fx.condition_logs))


def _modules(spark, sf_dir):
    return decoders.decode_module_events(fx.frame(spark, sf_dir, fx.module_logs), MODULES, {"0xm1": 1, "0xm2": 2, "0xm3": 3}, "0xm3")


def modules(spark, sf_dir):
    return _modules(spark, sf_dir)[0].select("block_number", "module", "event", F.coalesce("condition_id", F.lit("")).alias("condition_id"), F.coalesce(F.array_join("payouts", ","), F.lit("")).alias("payouts"), F.coalesce(F.size("legs"), F.lit(-1)).alias("legs"))


def module_rejects(spark, sf_dir):
    return _modules(spark, sf_dir)[1].select("block_number", "reason")


def _enriched(spark, sf_dir):
    """Requests whose ancillary bytes name a question; some questions share their bytes, some adapters are translated."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    text = F.lower(F.hex(F.concat(F.lit("about "), "p_brand", F.lit(" "), (F.col("p_partkey") % 300).cast("string"))))
    key = F.col("p_partkey").cast("string")
    questions = p.where("p_partkey % 5 <> 1").select(key.alias("question_id"), F.concat(F.lit("adapter"), F.col("p_partkey") % 3).alias("adapter"), text.alias("ancillary_hex"))
    requests = p.where("p_partkey % 3 = 1").select(F.col("p_partkey").alias("id"), text.alias("ancillary_hex"))
    translations = p.where("p_partkey % 2 = 0").select(key.alias("request_id"), F.concat(F.lit("t"), key).alias("question_id"))
    return decoders.enrich_requests(requests, questions, translations, ("adapter2",))


def enriched(spark, sf_dir):
    none = F.lit("")
    return _enriched(spark, sf_dir)[0].select("id", F.coalesce("adapter", none).alias("adapter"), F.coalesce("question_id", none).alias("question_id"))


def enrich_conflicts(spark, sf_dir):
    return _enriched(spark, sf_dir)[1].select("id")


def orphans(spark, sf_dir):
    """Events without a market, which their condition or question may name."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    markets = p.select(F.col("p_partkey").alias("market_id"), F.concat(F.lit("0xC"), (F.col("p_partkey") % 1500).cast("string")).alias("condition_id"), F.when(F.col("p_partkey") % 4 != 1, F.concat(F.lit("q"), F.col("p_partkey").cast("string"))).alias("question_id"))
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = (F.col("event_id") * 7) % 2100
    events = e.select("event_id", F.when(F.col("event_id") % 9 == 2, F.col("user_id")).alias("market_id"), F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("0xc"), n.cast("string"))).alias("condition_id"), F.when(F.col("event_id") % 5 != 4, F.concat(F.lit("Q"), (n + F.when(F.col("event_id") % 8 == 7, 1).otherwise(0)).cast("string"))).alias("question_id"))
    return decoders.reconcile_orphans(events, markets).select("event_id", F.coalesce("market_id", F.lit(-1)).alias("market_id"))


QUERIES = {
    "adapter_events": adapters, "adapter_rejects": adapter_rejects, "prepared_requests": prepared, "module_logs": modules, "module_log_rejects": module_rejects, "enriched_requests": enriched, "enrich_conflicts": enrich_conflicts, "reconciled_orphans": orphans,
"condition_events": conditions, "condition_rejects": condition_rejects, "oracle_requests": requests, "oracle_request_rejects": request_rejects, "tape_sink": tape_sink, "observation_sink": observation_sink,
}

_CTF = fx.cte(l=fx.condition_logs) + """
    , r AS (SELECT *, CASE topic0 WHEN '0x04' THEN 'request' WHEN '0x05' THEN 'settle' END AS status, substr(data, 3) AS b, ('0x' || substr(data, 51, 16))::BIGINT AS slots, try_cast('0x' || substr(data, 179, 16) AS BIGINT) AS n FROM l),
    k AS (SELECT *, CASE WHEN status IS NULL THEN 'unknown event' WHEN status = 'settle' AND n = 9 THEN 'payouts out of range' WHEN status = 'settle' AND n <> slots THEN 'payouts do not match slots' END AS reason FROM r)
"""
_UMA = fx.cte(l=fx.request_logs) + """
    , r AS (SELECT *, CASE topic0 WHEN '0x01' THEN 'request' WHEN '0x02' THEN 'settle' END AS status FROM l), k AS (SELECT *, CASE WHEN status IS NULL THEN 'unknown event' WHEN id % 19 = 4 THEN 'ancillary data out of range' END AS reason FROM r)
"""
_ADAPTERS = fx.cte(l=fx.adapter_logs) + """
    , r AS (SELECT *, address = '0xOLD' AS old, CASE topic0 WHEN '0x11' THEN 'initialized' WHEN '0x12' THEN 'reset' WHEN '0x13' THEN 'resolved' WHEN '0x14' THEN CASE WHEN address = '0xOLD' THEN 'settled' END END AS status FROM l),
    k AS (SELECT *, CASE WHEN status IS NULL THEN 'unknown event' WHEN status = 'initialized' AND id % 19 = 3 THEN 'ancillary data out of range' END AS reason, CASE id % 3 WHEN 0 THEN '1000000000000000000' WHEN 1 THEN '0' ELSE '-5' END AS value FROM r JOIN (SELECT p_partkey, p_brand FROM part) ON p_partkey = id)
"""
_MODULE_LOGS = fx.cte(l=fx.module_logs) + """
    , r AS (
        SELECT l.*, CASE topic0 WHEN '0x21' THEN 'ConditionResolved' WHEN '0x22' THEN 'ResultReported' WHEN '0x23' THEN 'CombinatorialConditionPrepared' WHEN '0x24' THEN 'Upgraded' ELSE 'MigrationResolved' END AS event,
            regexp_extract(props, '([0-9]+)', 1)::BIGINT * 9973 % 1000001 AS a, id % 29 = 6 AS seven FROM l JOIN events ON event_id = id
    ), k AS (
        SELECT *, CASE WHEN (address = '0xM3') AND event NOT IN ('CombinatorialConditionPrepared', 'Upgraded') OR address <> '0xM3' AND event = 'CombinatorialConditionPrepared' THEN 'event is not of this module' WHEN event <> 'Upgraded' AND id % 41 = 8 THEN 'condition of another module'
            WHEN event IN ('ConditionResolved', 'ResultReported', 'MigrationResolved') AND seven AND a <> 999993 THEN 'results do not sum to a unit' END AS reason FROM r
    )
"""
_ENRICH = """
    WITH t AS (SELECT p_partkey AS p, p_brand || ' ' || p_partkey % 300 AS x FROM part), q AS (SELECT x, count(DISTINCT p) AS n, min(p::VARCHAR) AS q, min('adapter' || p % 3) AS a FROM t WHERE p % 5 <> 1 GROUP BY x),
    j AS (SELECT p AS id, n, q, a FROM t LEFT JOIN q USING (x) WHERE p % 3 = 1)
"""
ORACLE_SQL = {
    "adapter_events": _ADAPTERS + """
        SELECT block_number, lower(address) AS adapter, status, topic1 AS question_id, CASE WHEN status = 'settled' OR (status = 'resolved' AND NOT old) THEN value ELSE '' END AS price, CASE WHEN status = 'resolved' AND old THEN (id % 3 <> 1)::VARCHAR ELSE '' END AS emergency,
            CASE WHEN status = 'settled' THEN (id % 4 - id % 2 <> 0)::VARCHAR ELSE '' END AS early, CASE WHEN status = 'initialized' THEN 'q ' || id || ' ' || p_brand ELSE '' END AS text FROM k WHERE reason IS NULL""",
    "adapter_rejects": _ADAPTERS + "SELECT block_number, reason FROM k WHERE reason IS NOT NULL",
    "prepared_requests": fx.cte(l=fx.condition_logs) + "SELECT topic3 AS request_id, topic2 AS question_id, topic1 AS market_key, '0xcc' AS operator FROM l",
    "module_logs": _MODULE_LOGS + """
        SELECT block_number, lower(address) AS module, event, CASE event WHEN 'Upgraded' THEN '' ELSE left(topic1, 64) END AS condition_id, CASE WHEN event IN ('ConditionResolved', 'ResultReported', 'MigrationResolved') THEN a || ',' || CASE WHEN seven THEN 7 ELSE 1000000 - a END ELSE '' END AS payouts,
            CASE event WHEN 'CombinatorialConditionPrepared' THEN 2 ELSE -1 END AS legs FROM k WHERE reason IS NULL""",
    "module_log_rejects": _MODULE_LOGS + "SELECT block_number, reason FROM k WHERE reason IS NOT NULL",
    "enriched_requests": _ENRICH + "SELECT id, coalesce(a, '') AS adapter, coalesce(CASE WHEN a = 'adapter2' AND q::BIGINT % 2 = 0 THEN 't' || q ELSE q END, '') AS question_id FROM j WHERE n IS NULL OR n = 1",
    "enrich_conflicts": _ENRICH + "SELECT id FROM j WHERE n > 1",
    "reconciled_orphans": """
        WITH m AS (SELECT p_partkey AS market_id, '0xc' || p_partkey % 1500 AS c, CASE WHEN p_partkey % 4 <> 1 THEN 'q' || p_partkey END AS q FROM part), uc AS (SELECT c, min(market_id) AS m FROM m GROUP BY c HAVING count(*) = 1), uq AS (SELECT q, min(market_id) AS m FROM m WHERE q IS NOT NULL GROUP BY q HAVING count(*) = 1),
        e AS (SELECT event_id, CASE WHEN event_id % 9 = 2 THEN user_id END AS own, CASE WHEN event_id % 3 <> 0 THEN '0xc' || event_id * 7 % 2100 END AS c, CASE WHEN event_id % 5 <> 4 THEN 'q' || (event_id * 7 % 2100 + CASE WHEN event_id % 8 = 7 THEN 1 ELSE 0 END) END AS q FROM events)
        SELECT event_id, coalesce(own, CASE WHEN uc.m IS NULL OR uq.m IS NULL OR uc.m = uq.m THEN coalesce(uc.m, uq.m) END, -1) AS market_id FROM e LEFT JOIN uc USING (c) LEFT JOIN uq USING (q)""",
    "condition_events": _CTF + "SELECT tx_hash, log_index, status, topic1 AS condition_id, '0x' || right(topic2, 40) AS oracle, topic3 AS question_id, slots, CASE status WHEN 'settle' THEN substr(b, 193, 64) || ',' || substr(b, 257, 64) ELSE '' END AS numerators FROM k WHERE reason IS NULL",
    "condition_rejects": _CTF + "SELECT tx_hash, reason FROM k WHERE reason IS NOT NULL",
    "oracle_requests": _UMA + """
        SELECT block_number, '0xab' AS oracle, status, '0x' || right(topic1, 40) AS requester, CASE status WHEN 'settle' THEN '0x' || right(topic2, 40) ELSE '' END AS proposer,
            CASE status WHEN 'settle' THEN CASE id % 3 WHEN 0 THEN '1000000000000000000' WHEN 1 THEN '0' ELSE '-5' END ELSE '' END AS price, CASE status WHEN 'settle' THEN id::VARCHAR ELSE '' END AS payout,
            'q: title: ' || name || ', description: d. market_id: ' || id AS text FROM k WHERE reason IS NULL""",
    "oracle_request_rejects": _UMA + "SELECT block_number, reason FROM k WHERE reason IS NOT NULL",
    "tape_sink": fx.cte(ev=fx.book_events) + "SELECT market % 5 AS stream, min(pos) AS first, max(pos) AS last, count(*) AS n FROM ev GROUP BY 1",
    "observation_sink": "WITH e AS (SELECT doc_id // 100 AS bundle, text, count(*) AS n, max(strlen(text)) AS b FROM documents GROUP BY ALL) SELECT bundle, sum(n)::BIGINT AS occurrences, sum(n * b)::BIGINT AS raw_bytes, sum(b)::BIGINT AS unique_bytes, sum((n - 1) * b)::BIGINT AS saved_bytes FROM e GROUP BY bundle",
}
