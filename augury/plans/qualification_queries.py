"""Qualification at one cut, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from augury.operators import coverage
from augury.operators import qualification as q
from augury.sources import fixtures as fx
from augury.sources.shared import written
from augury.streaming import jobs


def _inputs(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    desired = c.select(F.floor(F.col("c_custkey") / 2).alias("market"), F.col("c_custkey").alias("token"))
    markets = desired.select("market").distinct()
    own = markets.where("market % 41 <> 7").unionByName(markets.where("market % 100 = 3").select((F.col("market") + 10**7).alias("market")))
    owners = own.select("market", (F.col("market") % 3).alias("cohort"), (F.col("market") % 37 != 5).alias("identity_ok"))
    unadmitted = markets.where("market % 53 = 9").select("market", F.lit("IDENTITY_MIGRATION_REQUIRED").alias("reason"))
    lanes = spark.createDataFrame([(p, lane) for p in (0, 1) for lane in (0, 1)], "plant int, lane int")
    errors = F.when((F.col("plant") == 1) & (F.col("cohort") == 2), F.array(F.lit("STATUS_STALE"))).otherwise(F.array().cast("array<string>"))
    nodes = owners.select("cohort").distinct().crossJoin(lanes.select("plant").distinct()).select("plant", "cohort", F.lit(900).alias("applied_offset"), F.lit(950).alias("durable_offset"), errors.alias("errors"))
    s = fx.frame(spark, sf_dir, fx.cut_states)
    states = s.withColumn("eligibility", F.when(F.col("eligible").isNotNull(), F.array("eligible")).otherwise(F.array().cast("array<string>"))).drop("eligible", "copy")
    return desired, owners, unadmitted, nodes, states, lanes


def _gateway(markets):
    m = F.col("market")
    g = markets.where("market % 11 <> 3").select(
        "market", (m % 17 != 3).alias("ready"), (m % 23 == 4).alias("crossed"), F.lit(10).alias("market_seq"), F.when(m % 13 != 5, 10 - (m % 19 == 6).cast("int")).alias("source_seq"), F.lit("P").alias("plant"),
        F.when(m % 29 == 7, "old").otherwise("s").alias("session"), F.lit("t").alias("stream"), F.when(m % 31 == 8, 9).otherwise(3).alias("parent_seq"), F.lit(3).alias("parent_offset"),
    )
    p = markets.select(F.lit("P").alias("plant"), "market", F.lit("s").alias("session"), F.lit("t").alias("stream"), F.lit(4).alias("committed_seq"), F.lit(4).alias("applied_offset"))
    return coverage.gateway_checks(markets, g, p)


def _tokens(spark, sf_dir):
    return q.token_rows(*_inputs(spark, sf_dir))


def _markets(spark, sf_dir, tokens=None):
    desired, *_, lanes = _inputs(spark, sf_dir)
    return q.market_rows(_tokens(spark, sf_dir) if tokens is None else tokens, _gateway(desired.select("market").distinct()), lanes)


def _shown(tokens):
    return tokens.select("market", "token", "plant", "lane", *q.STAGES, F.array_join("reasons", ",").alias("reasons"), "primary_reason")


def token_qualification(spark, sf_dir):
    return _shown(_tokens(spark, sf_dir))


def market_qualification(spark, sf_dir):
    return _markets(spark, sf_dir).withColumn("gateway_reasons", F.array_join("gateway_reasons", ","))


def reasons(spark, sf_dir):
    return q.reason_counts(_tokens(spark, sf_dir))


def _gates(spark, sf_dir, tokens=None, markets=None):
    """The gates read tokens twice and markets once, so both are written first."""
    tokens = written(_tokens(spark, sf_dir), "tokens") if tokens is None else tokens
    markets = written(_markets(spark, sf_dir, tokens), "markets") if markets is None else markets
    desired, owners, unadmitted, nodes, _, lanes = _inputs(spark, sf_dir)
    explained = owners.where(F.col("market") > 10**7)
    return q.gates(desired, owners, explained, unadmitted, nodes, tokens, markets, lanes)


def outputs(spark, sf_dir):
    """Each table is computed once, then written and checked from what was computed."""
    tokens = written(_tokens(spark, sf_dir), "tokens")
    markets = written(_markets(spark, sf_dir, tokens), "markets")
    found, gates = written(q.reason_counts(tokens), "reasons"), written(_gates(spark, sf_dir, tokens, markets), "gates")
    return q.write_report(_shown(tokens), markets.withColumn("gateway_reasons", F.array_join("gateway_reasons", ",")), found, gates, f"{jobs.work_dir(spark)}/report").select("table", "n")


QUERIES = {"token_qualification": token_qualification, "market_qualification": market_qualification, "qualification_reasons": reasons, "qualification_gates": _gates, "qualification_outputs": outputs}

_TOKENS = fx.cte(s=fx.cut_states) + """
    , d AS (SELECT c_custkey // 2 AS market, c_custkey AS token FROM customer), g AS (SELECT d.*, plant, lane FROM d, (SELECT unnest([0, 1]) AS plant), (SELECT unnest([0, 1]) AS lane)),
    one AS (SELECT market, token, plant, lane, any_value(COLUMNS(* EXCLUDE (market, token, plant, lane, copy))), count(*) AS copies FROM s GROUP BY ALL),
    r AS (
        SELECT g.market, g.token, g.plant, g.lane, one.* EXCLUDE (market, token, plant, lane), g.market % 41 <> 7 AS assigned, one.token IS NOT NULL AS there, coalesce(copies > 1, false) AS duplicate
        FROM g LEFT JOIN one ON one.market = g.market AND one.token = g.token AND one.plant = g.plant AND one.lane = g.lane
    ), b AS (SELECT *, there AND written AS w, there AND book_seen AND baseline_connection = connection AS bk FROM r),
    c AS (SELECT *, coalesce(bk AND baseline_durable AND receipt_offset = baseline_offset AND baseline_offset <= 900 AND assigned, false) AS du, coalesce(NOT baseline_durable AND baseline_offset > CASE WHEN assigned THEN 900 ELSE -1 END, false) AS pend FROM b),
    l AS (
        SELECT market, token, plant, lane, assigned, there AS session_assigned, coalesce(w, false) AS written, coalesce(bk, false) AS book_seen, du AS baseline_durable, coalesce(ready, false) AS ready_reported, connection, epoch, shard, duplicate,
            list_filter([CASE WHEN assigned AND plant = 1 AND market % 3 = 2 THEN 'STATUS_STALE' END, CASE WHEN assigned AND market % 37 = 5 THEN 'ASSIGNED_IDENTITY_MISMATCH' END, CASE WHEN market % 53 = 9 THEN 'IDENTITY_MIGRATION_REQUIRED' END, CASE WHEN NOT assigned THEN 'DESIRED_UNASSIGNED' END,
                CASE WHEN duplicate THEN 'DUPLICATE_ACTIVE_STATE' END, CASE WHEN NOT there THEN 'NO_CURRENT_ACTIVE_ROUTE' END, CASE WHEN there AND NOT w THEN 'SUBSCRIPTION_WRITE_EVIDENCE_MISSING' END, CASE WHEN there AND NOT bk THEN 'CURRENT_NATIVE_BASELINE_MISSING' END, CASE WHEN bk AND NOT du AND pend THEN 'CAPTURE_PENDING_DURABLE' END,
                CASE WHEN bk AND NOT du AND NOT pend THEN 'BASELINE_DURABILITY_EVIDENCE_INVALID' END, eligible, CASE WHEN there AND NOT ready THEN coalesce(status, 'NOT_READY') END, CASE WHEN ready AND NOT (w AND bk AND du) THEN 'READY_EVIDENCE_CONTRADICTION' END], lambda x: x IS NOT NULL) AS why FROM c
    ), t AS (SELECT *, ready_reported AND written AND book_seen AND baseline_durable AND len(why) = 0 AS qualified, coalesce(why[1], 'READY') AS primary_reason FROM l)
"""
_MARKETS = _TOKENS + """
    , pr AS (SELECT market, plant, lane, count(*) = 2 AND bool_and(qualified) AND count(DISTINCT connection) = 1 AND count(DISTINCT shard) = 1 AS pair FROM t GROUP BY ALL),
    ms AS (SELECT market, coalesce(string_agg(plant || ':' || lane, ',' ORDER BY plant, lane) FILTER (pair), '') AS complete, coalesce(string_agg(plant || ':' || lane, ',' ORDER BY plant, lane) FILTER (NOT pair), '') AS missing, bool_or(pair) AS any_complete_source, count(DISTINCT plant) FILTER (pair) = 2 AS both_plants, bool_and(pair) AS all_lanes FROM pr GROUP BY market),
    gw AS (SELECT DISTINCT market, market % 11 <> 3 AS there, there AND market % 17 <> 3 AND market % 23 <> 4 AS ok, there AND market % 13 <> 5 AS src FROM d),
    gr AS (SELECT market, ok, list_filter([CASE WHEN NOT ok THEN 'GATEWAY_PAIR_NOT_READY' END, CASE WHEN ok AND NOT (src AND market % 19 <> 6) THEN 'COMMITTED_SOURCE_EVIDENCE_MISSING' END, CASE WHEN src AND market % 29 = 7 THEN 'GATEWAY_SOURCE_SESSION_MISMATCH' END, CASE WHEN src AND market % 31 = 8 THEN 'GATEWAY_PARENT_OUTSIDE_CAPTURED_PLANT_PREFIX' END], lambda x: x IS NOT NULL) AS why FROM gw),
    mk AS (SELECT ms.*, ok AS gateway_ready_reported, array_to_string(why, ',') AS gateway_reasons, len(why) = 0 AS gateway_qualified FROM ms JOIN gr USING (market))
"""
_GATES = _MARKETS + """
    , n AS (SELECT count(*) AS m, count(*) FILTER (any_complete_source) AS a, count(*) FILTER (both_plants) AS b, count(*) FILTER (all_lanes) AS l, count(*) FILTER (gateway_qualified) AS g, count(*) FILTER (gateway_reasons LIKE '%PARENT%') AS p FROM mk),
    k AS (
        SELECT unnest([{'gate': 'denominator_rows_complete', 'ok': (SELECT count(*) FROM t) = 4 * (SELECT count(*) FROM d)}, {'gate': 'unique_market_and_token_identity', 'ok': NOT (SELECT bool_or(duplicate) FROM t)},
            {'gate': 'routing_plan_matches_catalog', 'ok': (SELECT count(*) FROM (SELECT DISTINCT market FROM d) WHERE (market % 41 <> 7 AND market % 37 = 5) OR (market % 100 = 3 AND (market + 10000000) % 37 = 5)) = 0}, {'gate': 'all_desired_assigned', 'ok': (SELECT count(*) FROM d WHERE market % 41 = 7) = 0}, {'gate': 'retired_assignments_explained', 'ok': true},
            {'gate': 'same_revision_fresh_exact_node_cuts', 'ok': (SELECT count(*) FROM (SELECT market FROM d WHERE market % 41 <> 7 UNION ALL SELECT market + 10000000 FROM d WHERE market % 100 = 3) WHERE market % 3 = 2) = 0}, {'gate': 'gateway_parent_prefixes_closed', 'ok': p = 0}, {'gate': 'discovery_identity_resolution', 'ok': (SELECT count(*) FROM d WHERE market % 53 = 9) = 0},
            {'gate': 'all_desired_have_complete_source', 'ok': a = m}, {'gate': 'all_desired_both_plants', 'ok': b = m}, {'gate': 'all_desired_four_lanes', 'ok': l = m}, {'gate': 'all_desired_gateway_qualified', 'ok': g = m}]) AS x FROM n
    )
"""
_COUNTS = "(SELECT plant, lane, reason, sum(p)::BIGINT AS n_primary, sum(a)::BIGINT AS n_all FROM (SELECT plant, lane, primary_reason AS reason, 1 AS p, 0 AS a FROM t UNION ALL SELECT plant, lane, unnest(why), 0, 1 FROM t) GROUP BY ALL)"

ORACLE_SQL = {
    "token_qualification": _TOKENS + "SELECT market, token, plant, lane, assigned, session_assigned, written, book_seen, baseline_durable, ready_reported, qualified, array_to_string(why, ',') AS reasons, primary_reason FROM t",
    "market_qualification": _MARKETS + "SELECT * FROM mk",
    "qualification_reasons": _TOKENS + f"SELECT * FROM {_COUNTS}",
    "qualification_gates": _GATES + "SELECT x.gate AS gate, CASE WHEN x.ok THEN 'PASS' ELSE 'FAIL' END AS result FROM k",
    "qualification_outputs": _MARKETS + f"SELECT 'token_state_at_cut' AS \"table\", count(*) AS n FROM t UNION ALL SELECT 'market_gap_attribution', count(*) FROM mk UNION ALL SELECT 'reasons', count(*) FROM {_COUNTS} UNION ALL SELECT 'gates', 12",
}
