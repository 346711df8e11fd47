"""Settlement queries with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from augury.functions import hexes
from augury.operators import settlement
from augury.sources import fixtures as fx

#: Minute at which open markets are judged.
AS_OF = 28_000_000


def _evidence(spark, sf_dir):
    markets = fx.frame(spark, sf_dir, fx.settlement_markets).withColumn("end_date", F.when(F.col("open_until") >= 0, F.col("open_until")))
    return settlement.settlement_evidence(markets, fx.frame(spark, sf_dir, fx.settlement_tokens), fx.frame(spark, sf_dir, fx.settlement_events), F.lit(AS_OF))


def evidence(spark, sf_dir):
    paid = F.array_join(F.transform(F.coalesce("payouts", F.expr("array()").cast("array<struct<token_id: string, outcome_index: int, outcome: string, numerator: string, denominator: string>>")), lambda p: F.concat_ws(":", p["token_id"], p["numerator"], p["denominator"])), ",")
    return _evidence(spark, sf_dir).select("market_id", "condition_id", "readiness", F.coalesce("settlement_id", F.lit(-1)).alias("settlement_id"), "requests", "settles", "uma_requests", "uma_settles", "token_mapping_valid", paid.alias("payouts"))


def summary(spark, sf_dir):
    return settlement.coverage_summary(_evidence(spark, sf_dir))


def _modules(spark, sf_dir):
    seen = fx.frame(spark, sf_dir, fx.implementations)
    epochs = settlement.module_epochs(seen.where("seen").drop("seen"), seen.where("not seen").drop("seen"))
    return settlement.native_results(fx.frame(spark, sf_dir, fx.module_events), epochs), epochs


def epochs(spark, sf_dir):
    return _modules(spark, sf_dir)[1]


def natives(spark, sf_dir):
    return _modules(spark, sf_dir)[0].select("condition_id", "module_readiness", F.coalesce(F.array_join("module_numerators", ","), F.lit("")).alias("numerators"))


def _combos(spark, sf_dir):
    native, seen = _modules(spark, sf_dir)
    prepared = fx.frame(spark, sf_dir, fx.preparations).withColumn("legs", F.split("legs", ","))
    return settlement.combo_results(prepared, native, seen)


def combos(spark, sf_dir):
    return _combos(spark, sf_dir).select("condition_id", "module_readiness", F.when(F.col("module_readiness") == "READY", F.array_join("module_numerators", ",")).otherwise("").alias("numerators"), F.coalesce("terminal_zero", F.lit(False)).alias("terminal_zero"))


def _module_evidence(spark, sf_dir):
    """Markets of modules: settled by native results; some own swapped tokens."""
    m = fx.frame(spark, sf_dir, fx.module_markets)
    word = lambda k: F.concat(F.substring("condition_id", 3, 62), F.lpad(k.cast("string"), 2, "0"))
    slots = F.explode(F.array(*[F.struct(F.lit(k).alias("outcome_index"), hexes.to_decimal(word(F.when(F.col("swapped") == 1, 1 - k).otherwise(k))).alias("token_id")) for k in (0, 1)]))
    tokens = m.select(F.col("id").alias("market_id"), "condition_id", slots.alias("t")).select("market_id", "t.token_id", "t.outcome_index", F.concat(F.lit("position_"), "t.outcome_index").alias("outcome"), "condition_id")
    markets = m.select("id", F.lit("module").alias("identity_kind"), "condition_id", "active", "closed", F.lit(None).cast("bigint").alias("end_date"))
    native = _modules(spark, sf_dir)[0]
    return settlement.settlement_evidence(markets, tokens, fx.frame(spark, sf_dir, fx.settlement_events), F.lit(AS_OF), native.unionByName(_combos(spark, sf_dir))), m


def module_evidence(spark, sf_dir):
    return _module_evidence(spark, sf_dir)[0].select("market_id", "condition_id", "readiness", "token_mapping_valid", F.coalesce("settlement_basis", F.lit("")).alias("settlement_basis"), F.coalesce(F.array_join(F.transform("payouts", lambda p: p["numerator"]), ","), F.lit("")).alias("numerators"))


def payouts(spark, sf_dir):
    """What a holding of each token pays; every third holding is of a token that the market lacks."""
    found = _evidence(spark, sf_dir)
    token = F.when(F.col("p_partkey") % 3 == 0, F.lit("1")).otherwise((F.col("p_partkey") * 100 + F.col("p_partkey") % 2 + 1).cast("string"))
    held = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("market_id"), token.alias("token_id"), F.when(F.col("p_partkey") % 10 == 9, F.lit(str(10**77))).otherwise(F.concat((F.col("p_partkey") * 1234567).cast("string"), F.lit("000000000000"))).alias("amount"))
    return settlement.payout_for_amount(found, held).select("market_id", "token_id", F.coalesce("payout", F.lit("")).alias("payout"), F.coalesce("reason", F.lit("")).alias("reason"))


def legs(spark, sf_dir):
    """Positions go to decimal text, as events give them, and back."""
    rows = fx.frame(spark, sf_dir, fx.legs)
    return settlement.leg_checks(rows.withColumn("position", F.coalesce(hexes.to_decimal(F.col("word")), F.lit("none"))).drop("word"))


QUERIES = {"settlement_evidence": evidence, "settlement_summary": summary, "module_epochs": epochs, "native_results": natives, "combo_results": combos, "module_evidence": module_evidence, "payout_amounts": payouts, "leg_checks": legs}

_SQL = fx.cte(m=fx.settlement_markets, t=fx.settlement_tokens, e=fx.settlement_events) + f"""
    , c AS (
        SELECT condition_id, count(*) FILTER (event_status = 'request') AS requests, count(*) FILTER (event_status = 'settle') AS settles,
            last(id ORDER BY block_number, log_index, id) FILTER (event_status = 'settle') AS sid FROM e WHERE source_oracle = '{settlement.CONDITIONS}' GROUP BY 1
    ), u AS (SELECT market_id, count(*) FILTER (event_status = 'request') AS ur, count(*) FILTER (event_status = 'settle') AS us FROM e WHERE source_oracle <> '{settlement.CONDITIONS}' GROUP BY 1),
    v AS (
        SELECT id AS sid, source_adapter LIKE '0x%' AS prov, CASE WHEN regexp_full_match(payout, '\\[(0|[1-9][0-9]*)(, ?(0|[1-9][0-9]*))+\\]') THEN list_transform(string_split(regexp_replace(payout, '[^0-9,]', '', 'g'), ','), lambda x: x::BIGINT) END AS nums FROM e
    ), k AS (
        SELECT market_id, count(*) AS n, count(DISTINCT outcome_index) = 2 AS slots, min(condition_id) AS lo, max(condition_id) AS hi, list(token_id ORDER BY outcome_index, token_id) AS ids FROM t GROUP BY 1
    ), j AS (
        SELECT m.*, c.sid, coalesce(requests, 0) AS requests, coalesce(settles, 0) AS settles, coalesce(ur, 0) AS uma_requests, coalesce(us, 0) AS uma_settles, v.prov, v.nums, list_sum(nums) AS total, k.ids,
            coalesce(len(nums) = 2 AND k.n = 2 AND k.slots AND k.lo = m.condition_id AND k.hi = m.condition_id, false) AS mapped, active AND NOT closed AND (open_until < 0 OR open_until > {AS_OF}) AS open
        FROM m LEFT JOIN c ON c.condition_id = m.condition_id LEFT JOIN v ON v.sid = c.sid LEFT JOIN k ON k.market_id = m.id LEFT JOIN u ON u.market_id = m.id
    ), r AS (
        SELECT *, CASE WHEN condition_id LIKE '0x03%' AND len(condition_id) = 64 THEN 'MISSING_COMBO_PREPARATION' WHEN condition_id LIKE '0x01%' AND len(condition_id) = 64 THEN CASE WHEN open THEN 'PENDING' ELSE 'MISSING_MODULE_SETTLEMENT' END
            WHEN len(condition_id) <> 66 THEN 'UNSUPPORTED_MARKET_IDENTITY' WHEN settles > 1 THEN 'CONFLICTING_CTF_SETTLEMENTS' WHEN sid IS NOT NULL AND (nums IS NULL OR total = 0) THEN 'INVALID_CTF_PAYOUT'
            WHEN sid IS NOT NULL AND NOT prov THEN 'INCOMPLETE_CTF_PROVENANCE' WHEN sid IS NOT NULL AND NOT mapped THEN 'TOKEN_MAPPING_CONFLICT' WHEN sid IS NOT NULL THEN 'READY'
            WHEN open AND uma_settles = 0 THEN 'PENDING' ELSE 'MISSING_CTF_SETTLEMENT' END AS readiness FROM j
    )
"""
_EPOCHS = """
    , ep AS (SELECT module_address, last(lower(implementation) ORDER BY block_number, seen, log_index) AS implementation FROM im GROUP BY 1)
"""
_NATIVE = """
    , fit AS (SELECT * FROM me WHERE event_name = 'ConditionResolved' AND len(condition_id) = 64 AND condition_id LIKE CASE module_address WHEN '0x1000008dd9001b968442c1000017eae6e0da00ba' THEN '0x01%' ELSE '0x02%' END),
    lst AS (SELECT condition_id, count(*) AS n, last(fit ORDER BY block_number, log_index, id) AS f FROM fit GROUP BY 1),
    prs AS (SELECT condition_id, n, f.module_address AS a, f.tx_hash AS tx, CASE WHEN regexp_full_match(f.payouts, '\\[ *(0|[1-9][0-9]{0,6}) *, *(0|[1-9][0-9]{0,6}) *\\]') THEN list_transform(string_split(regexp_replace(f.payouts, '[^0-9,]', '', 'g'), ','), lambda x: x::BIGINT) END AS nums FROM lst),
    nat AS (
        SELECT condition_id, nums, CASE WHEN n <> 1 THEN 'CONFLICTING_MODULE_SETTLEMENTS' WHEN nums IS NULL OR nums[1] + nums[2] <> 1000000 THEN 'INVALID_MODULE_PAYOUT' WHEN tx NOT LIKE '0x%' THEN 'INCOMPLETE_MODULE_PROVENANCE' WHEN implementation IS NULL THEN 'MODULE_IMPLEMENTATION_UNVERIFIED'
            WHEN implementation NOT IN ('0x492fec596ec347459e1ebe30b9245eb3b49b1bba', '0xa61e7ca374f721d5b9fd5b0fee6fb90f27d448d7') THEN 'MODULE_IMPLEMENTATION_UNSUPPORTED' ELSE 'READY' END AS r
        FROM prs LEFT JOIN ep ON module_address = a
    )
"""
_COMBOS = """
    , df AS (SELECT condition_id, count(DISTINCT legs) AS defs, string_split(first(legs ORDER BY block_number, log_index, id), ',') AS ls FROM pr GROUP BY 1),
    lg AS (SELECT condition_id, i, ls[i] AS leg FROM (SELECT condition_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM df)),
    lr AS (SELECT lg.*, nat.condition_id IS NULL AS missing, r, nums[1 + right(leg, 2)::INT] AS num FROM lg LEFT JOIN nat ON nat.condition_id = '0x' || left(leg, 62)),
    st AS (
        SELECT condition_id, bool_or(missing) AS missing, bool_or(coalesce(r = 'READY' AND num = 0, false)) AS zero, list(r) AS rs, list(num ORDER BY i) AS nums, count(*) = count(DISTINCT left(leg, 62)) AND bool_and(rising) AS fine
        FROM (SELECT *, coalesce(leg > lag(leg) OVER (PARTITION BY condition_id ORDER BY i), true) AS rising FROM lr) GROUP BY 1
    ), own AS (SELECT max(implementation) FILTER (module_address = '0x30000034706c7d8e12009dab006be20000c031a8') AS mine FROM ep),
    rd AS (
        SELECT condition_id, zero, nums, CASE WHEN defs <> 1 THEN 'CONFLICTING_COMBO_PREPARATION' WHEN NOT fine THEN 'INVALID_COMBO_PREPARATION' WHEN list_contains(rs, 'CONFLICTING_MODULE_SETTLEMENTS') THEN 'CONFLICTING_MODULE_SETTLEMENTS' WHEN list_contains(rs, 'INVALID_MODULE_PAYOUT') THEN 'INVALID_MODULE_PAYOUT'
            WHEN list_contains(rs, 'INCOMPLETE_MODULE_PROVENANCE') THEN 'INCOMPLETE_MODULE_PROVENANCE' WHEN mine IS NULL OR list_contains(rs, 'MODULE_IMPLEMENTATION_UNVERIFIED') THEN 'MODULE_IMPLEMENTATION_UNVERIFIED'
            WHEN mine <> '0x572cd48cce93b2e58f1cc0253a7fdd4b4952a9c2' OR list_contains(rs, 'MODULE_IMPLEMENTATION_UNSUPPORTED') THEN 'MODULE_IMPLEMENTATION_UNSUPPORTED' WHEN zero OR NOT missing THEN 'READY' ELSE 'MISSING_COMBO_LEG_RESULT' END AS readiness
        FROM df JOIN st USING (condition_id), own
    ),
    -- Products of up to three legs of a million each, of the unit 10^36: rounded down leg by leg, and up for the other side.
    fd AS (
        SELECT *, nums[1]::HUGEINT * 1000000000000000000000000000000 AS a, CASE WHEN len(nums) > 1 THEN nums[2]::HUGEINT END AS n2, CASE WHEN len(nums) > 2 THEN nums[3]::HUGEINT END AS n3 FROM rd
    ), f2 AS (SELECT *, CASE WHEN n2 IS NULL THEN a ELSE a // 1000000 * n2 END AS b FROM fd), f3 AS (SELECT *, CASE WHEN n3 IS NULL THEN b ELSE b // 1000000 * n3 END AS down FROM f2)
"""
ORACLE_SQL = {
    "module_epochs": fx.cte(im=fx.implementations) + _EPOCHS + "SELECT * FROM ep",
    "native_results": fx.cte(im=fx.implementations, me=fx.module_events) + _EPOCHS + _NATIVE + "SELECT condition_id, r AS module_readiness, coalesce(array_to_string(nums, ','), '') AS numerators FROM nat",
    "combo_results": fx.cte(im=fx.implementations, me=fx.module_events, pr=fx.preparations) + _EPOCHS + _NATIVE + _COMBOS + """
        SELECT condition_id, readiness AS module_readiness, CASE WHEN readiness <> 'READY' THEN '' WHEN zero THEN '0,1000000000000000000000000000000000000' ELSE down::VARCHAR || ',' || (1000000000000000000000000000000000000::HUGEINT - down)::VARCHAR END AS numerators, zero AS terminal_zero FROM f3""",
    "module_evidence": fx.cte(im=fx.implementations, me=fx.module_events, mm=fx.module_markets) + _EPOCHS + _NATIVE + """
        , j AS (SELECT mm.*, r, nums, coalesce(r = 'READY' AND swapped = 0, false) AS mapped FROM mm LEFT JOIN nat USING (condition_id))
        SELECT id AS market_id, condition_id, CASE WHEN r = 'READY' AND NOT mapped THEN 'TOKEN_MAPPING_CONFLICT' WHEN r IS NOT NULL THEN r WHEN active AND NOT closed THEN 'PENDING' ELSE 'MISSING_MODULE_SETTLEMENT' END AS readiness, mapped AS token_mapping_valid,
            CASE WHEN r IS NULL THEN '' ELSE 'V2_CONDITION_RESOLUTION' END AS settlement_basis, CASE WHEN mapped THEN array_to_string(nums, ',') ELSE '' END AS numerators FROM j""",
    "payout_amounts": _SQL + """
        , h AS (SELECT p_partkey AS market_id, CASE WHEN p_partkey % 3 = 0 THEN '1' ELSE (p_partkey * 100 + p_partkey % 2 + 1)::VARCHAR END AS token_id, p_partkey % 10 = 9 AS huge, p_partkey::HUGEINT * 1234567 * 1000000000000 AS amount FROM part),
        x AS (SELECT h.*, r.readiness, r.total, nums[list_position(ids, token_id)] AS num FROM h LEFT JOIN r ON r.id = h.market_id),
        y AS (SELECT *, CASE WHEN readiness <> 'READY' THEN readiness WHEN num IS NULL THEN 'unknown token' WHEN huge THEN 'huge' ELSE '' END AS reason FROM x)
        SELECT market_id, token_id, CASE WHEN reason = '' THEN (amount * num // total)::VARCHAR WHEN reason = 'huge' AND num = 0 THEN '0' WHEN reason = 'huge' AND num = 1 THEN '1' || repeat('0', 77 - len(total::VARCHAR) + 1) ELSE '' END AS payout,
            CASE WHEN reason = 'huge' THEN CASE WHEN num > 1 THEN 'product is over 256 bits' ELSE '' END ELSE reason END AS reason FROM y""",
    "leg_checks": fx.cte(l=fx.legs) + """
        SELECT leg_id, CASE WHEN word = 'none' THEN '' ELSE word END AS word, word <> 'none' AND outcome_index < 2 AND condition_id NOT LIKE '0x04%' AND word NOT LIKE '%ff' AS valid FROM l""",
    "settlement_evidence": _SQL + """
        SELECT id AS market_id, condition_id, readiness, coalesce(sid, -1) AS settlement_id, requests, settles, uma_requests, uma_settles, mapped AS token_mapping_valid,
            CASE WHEN readiness = 'READY' THEN ids[1] || ':' || nums[1] || ':' || total || ',' || ids[2] || ':' || nums[2] || ':' || total ELSE '' END AS payouts FROM r""",
    "settlement_summary": _SQL + "SELECT identity_kind, readiness, count(*) AS markets FROM r GROUP BY ALL",
}
