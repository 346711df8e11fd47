"""Settlement evidence: one row for every market, its readiness and its exact payouts.

Whole numbers up to 256 bits are decimal text; sums are taken in limbs of twenty digits.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from augury.functions import hexes

# Contracts whose events count: fixed values.
CONDITIONS = "0x4d97dcd97ec945f40cf65f87097ace5ea0476045"
ADJUDICATORS = ("0xbb1a8db2d4350976a11cdfa60a1d43f97710da49", "0x2c0367a9db231ddebd88a94b4f6461a6e47c58b1", "0xee3afe347d5c74317041e2618c49534daf887c24")
#: 2**256, which numbers must stay under.
LIMIT = str(2**256)
_WIDE, _LIMB = 100, 20
_TX, _ADDRESS, _CONDITION, _MODULE = "^0x[0-9a-f]{64}$", "^0x[0-9a-f]{40}$", "^0x[0-9a-f]{64}$", "^0x0[123][0-9a-f]{60}$"


def below_limit(number: Column) -> Column:
    """Whether decimal text is under 2**256: padded text compares as numbers do."""
    return F.lpad(number, _WIDE, "0") < F.lit(LIMIT.zfill(_WIDE))


def total(numbers: Column) -> Column:
    """Exact sum of up to 256 whole numbers in decimal text, without leading zeros."""
    zero, unit = F.lit(0).cast("decimal(38,0)"), F.lit(str(10**_LIMB)).cast("decimal(21,0)")

    def limbs_added(numbers: Column) -> Column:
        part = lambda x, i: F.substring(F.lpad(x, _WIDE, "0"), 1 + _LIMB * i, F.lit(_LIMB)).cast("decimal(38,0)")
        limbs = F.transform(F.sequence(F.lit(_WIDE // _LIMB - 1), F.lit(0)), lambda i: F.aggregate(numbers, zero, lambda s, x: (s + part(x, i)).cast("decimal(38,0)")))
        here = lambda s, limb: (limb + s["carry"]).cast("decimal(38,0)")
        rest = lambda s, limb: (here(s, limb) % unit).cast("decimal(38,0)")
        return F.aggregate(
            limbs, F.struct(zero.alias("carry"), F.lit("").alias("digits")),
            lambda s, limb: F.struct(((here(s, limb) - rest(s, limb)) / unit).cast("decimal(38,0)").alias("carry"), F.concat(F.lpad(rest(s, limb).cast("string"), _LIMB, "0"), s["digits"]).alias("digits")),
            lambda s: F.regexp_replace(s["digits"], "^0+(?=[0-9])", ""),
        )

    # Short numbers, which most are, fit in 38 digits together.
    short = F.forall(numbers, lambda x: x.rlike("^[0-9]{1,35}$")) & (F.size(numbers) <= 256)
    return F.when(short, F.aggregate(numbers, zero, lambda s, x: (s + x.cast("decimal(38,0)")).cast("decimal(38,0)")).cast("string")).otherwise(limbs_added(numbers))


def payout_numbers(text: Column) -> Column:
    """Entries of a list of plain whole numbers such as [1, 0], as text; null for anything else."""
    good = text.rlike(r"^\s*\[\s*(0|[1-9][0-9]{0,77})(\s*,\s*(0|[1-9][0-9]{0,77}))+\s*\]\s*$")
    return F.when(good, F.split(F.regexp_replace(text, r"[\[\]\s]", ""), ","))


def _last_settle() -> Column:
    settle = F.col("event_status") == "settle"
    return F.max_by(F.when(settle, F.col("id")), F.when(settle, F.struct("block_number", "log_index", "id")))


def condition_summary(events: DataFrame) -> DataFrame:
    """Per condition: numbers of requests and settlements, and the last settlement."""
    rows = events.where((F.col("source_oracle") == CONDITIONS) & F.col("condition_id").rlike(_CONDITION))
    return rows.groupBy("condition_id").agg(F.count_if(F.col("event_status") == "request").alias("requests"), F.count_if(F.col("event_status") == "settle").alias("settles"), _last_settle().alias("settlement_id"))


def adjudication_summary(events: DataFrame) -> DataFrame:
    """Per market: numbers of adjudication events by status."""
    rows = events.where(F.col("market_id").isNotNull() & F.col("source_oracle").isin(*ADJUDICATORS))
    return rows.groupBy("market_id").agg(*[F.count_if(F.col("event_status") == s).alias(f"uma_{s}s") for s in ("request", "propose", "dispute", "settle")])


def token_map(tokens: DataFrame) -> DataFrame:
    """Per market: how many tokens, their slots and conditions, whether all ids are valid, and the list in order.

    Tokens are dealt by market before they are grouped, so that no task sorts more than its share, and distinct slots and
    ids are counted in the list, which needs no further copies of the rows.
    """
    valid = F.coalesce(F.col("token_id").rlike("^[1-9][0-9]{0,77}$"), F.lit(False)) & F.coalesce(below_limit(F.col("token_id")), F.lit(False))
    different = lambda c: F.size(F.array_distinct(F.filter(F.transform("tokens", lambda t: t[c]), lambda x: x.isNotNull()))).cast("long")
    return tokens.repartition("market_id").groupBy("market_id").agg(
        F.count("*").alias("n"), F.min("outcome_index").alias("first_slot"), F.max("outcome_index").alias("last_slot"),
        F.min(valid & F.coalesce(F.col("condition_id") != "", F.lit(False))).alias("valid"),
        F.min("condition_id").alias("first_condition"), F.max("condition_id").alias("last_condition"),
        F.array_sort(F.collect_list(F.struct("outcome_index", "token_id", "outcome"))).alias("tokens"),
    ).withColumns({"slots": different("outcome_index"), "ids": different("token_id")})


def validated_settlements(events: DataFrame) -> DataFrame:
    """Settlements of conditions with parsed payouts, their sum, and whether payout and provenance are in order."""
    rows = events.where((F.col("source_oracle") == CONDITIONS) & (F.col("event_status") == "settle"))
    rows = rows.withColumn("numerators", payout_numbers(F.col("payout")))
    rows = rows.withColumn("denominator", F.when(F.size("numerators") <= 256, total(F.col("numerators"))))
    fine = F.size("numerators").between(2, 256) & F.forall("numerators", below_limit) & (F.col("denominator") != "0") & below_limit(F.col("denominator"))
    known = F.col("tx_hash").rlike(_TX) & F.col("source_adapter").rlike(_ADDRESS) & F.col("adapter_question_id").rlike(_TX) & (F.col("block_number") > 0) & (F.col("log_index") >= 0) & F.col("event_time").isNotNull()
    return rows.select(F.col("id").alias("settlement_id"), "numerators", "denominator", F.coalesce(fine, F.lit(False)).alias("payout_valid"), F.coalesce(known, F.lit(False)).alias("provenance_valid"))


def settlement_evidence(markets: DataFrame, tokens: DataFrame, events: DataFrame, as_of, modules: DataFrame | None = None) -> DataFrame:
    """Every market once, with readiness and, where READY, payouts by token (numerator and denominator as text).

    modules, if given, has one row per module condition: condition_id, module_readiness, module_numerators,
    module_denominator, settlement_basis and terminal_zero; a market that they settle must own the two positions of its
    condition. as_of is the moment at which open markets count as pending.
    """
    # Joined by sorting: these grow with the markets, and by the size of their files Spark would broadcast them.
    ctf, uma, owned = (df.hint("merge") for df in (condition_summary(events), adjudication_summary(events), token_map(tokens)))
    # Only the last settlement of each condition is parsed.
    last = ctf.where("settlement_id is not null").select(F.col("settlement_id").alias("id"))
    settlements = validated_settlements(events.join(last, "id", "left_semi")).hint("merge")
    rows = markets.withColumnRenamed("id", "market_id").join(ctf, "condition_id", "left").join(settlements, "settlement_id", "left")
    rows = rows.join(owned.withColumnRenamed("n", "n_tokens"), "market_id", "left").join(uma, "market_id", "left")
    if modules is not None:
        rows = rows.join(modules, "condition_id", "left")
    else:
        rows = rows.withColumns({"module_readiness": F.lit(None).cast("string"), "module_numerators": F.lit(None).cast("array<string>"), "module_denominator": F.lit(None).cast("string"), "settlement_basis": F.lit(None).cast("string"), "terminal_zero": F.lit(None).cast("boolean")})
    slots = [F.coalesce(hexes.from_decimal(F.get("tokens", k)["token_id"]) == hexes.position(F.col("condition_id"), F.lit(k)), F.lit(False)) for k in (0, 1)]
    own = F.col("module_readiness").isNull() | ((F.col("module_readiness") == "READY") & slots[0] & slots[1])
    numerators, denominator = F.coalesce("numerators", "module_numerators"), F.coalesce("denominator", "module_denominator")
    rows = rows.withColumns({"numerators": numerators, "denominator": denominator})
    n = F.col("n_tokens")
    mapped = (
        (n == F.size("numerators")) & (F.col("first_slot") == 0) & (F.col("last_slot") == n - 1) & (F.col("slots") == n) & (F.col("ids") == n) & F.col("valid")
        & (F.col("first_condition") == F.col("condition_id")) & (F.col("last_condition") == F.col("condition_id")) & own
    )
    rows = rows.withColumn("token_mapping_valid", F.coalesce(mapped, F.lit(False)))
    open_ = F.col("active") & ~F.col("closed") & (F.col("end_date").isNull() | (F.col("end_date") > as_of))
    settled, is_module = F.col("settlement_id").isNotNull(), F.coalesce(F.col("condition_id").rlike(_MODULE), F.lit(False))
    state = (
        F.when(is_module & (F.col("module_readiness") == "READY") & ~F.col("token_mapping_valid"), "TOKEN_MAPPING_CONFLICT")
        .when(is_module & F.col("module_readiness").isNotNull(), F.col("module_readiness"))
        .when(is_module & F.col("condition_id").startswith("0x03"), "MISSING_COMBO_PREPARATION").when(is_module & open_, "PENDING").when(is_module, "MISSING_MODULE_SETTLEMENT")
        .when(~F.coalesce(F.col("condition_id").rlike(_CONDITION), F.lit(False)), "UNSUPPORTED_MARKET_IDENTITY").when(F.col("settles") > 1, "CONFLICTING_CTF_SETTLEMENTS")
        .when(settled & ~F.col("payout_valid"), "INVALID_CTF_PAYOUT").when(settled & ~F.col("provenance_valid"), "INCOMPLETE_CTF_PROVENANCE")
        .when(settled & ~F.col("token_mapping_valid"), "TOKEN_MAPPING_CONFLICT").when(settled, "READY")
        .when(open_ & (F.coalesce("uma_settles", F.lit(0)) == 0), "PENDING").otherwise("MISSING_CTF_SETTLEMENT")
    )
    paid = F.transform("tokens", lambda t: F.struct(t["token_id"].alias("token_id"), t["outcome_index"].alias("outcome_index"), t["outcome"].alias("outcome"), F.get("numerators", t["outcome_index"]).alias("numerator"), F.col("denominator").alias("denominator")))
    rows = rows.withColumn("readiness", state)
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("requests", "settles", "uma_requests", "uma_proposes", "uma_disputes", "uma_settles")]
    return rows.select("market_id", "identity_kind", "condition_id", "readiness", "settlement_id", *counts, "token_mapping_valid", F.when(F.col("readiness") == "READY", paid).alias("payouts"), F.when(settled, "CTF_CONDITION_RESOLUTION").otherwise(F.col("settlement_basis")).alias("settlement_basis"), F.coalesce("terminal_zero", F.lit(False)).alias("terminal_zero"))


def coverage_summary(evidence: DataFrame) -> DataFrame:
    """Markets by identity kind and readiness, over all of them."""
    return evidence.groupBy("identity_kind", "readiness").agg(F.count("*").alias("markets"))


#: Module contracts and the only implementation of each whose results are understood: fixed values.
MODULES = {
    "0x1000008dd9001b968442c1000017eae6e0da00ba": ("^0x01[0-9a-f]{60}$", "0x492fec596ec347459e1ebe30b9245eb3b49b1bba"),
    "0x200000900045e3b6259600682756002200028933": ("^0x02[0-9a-f]{60}$", "0xa61e7ca374f721d5b9fd5b0fee6fb90f27d448d7"),
}


def module_epochs(observations: DataFrame, upgrades: DataFrame) -> DataFrame:
    """Latest implementation of each module; of an observation and an upgrade in one block the observation counts.
    Rows of both: module_address, implementation, block_number, log_index."""
    both = observations.withColumn("__p", F.lit(1)).unionByName(upgrades.withColumn("__p", F.lit(0)))
    return both.groupBy("module_address").agg(F.max_by(F.lower("implementation"), F.struct("block_number", "__p", "log_index")).alias("implementation"))


def native_results(module_events: DataFrame, epochs: DataFrame) -> DataFrame:
    """Result of each module condition, as settlement_evidence() takes it: two payouts that sum to a million, one
    resolution, complete provenance, a supported implementation."""
    fits = F.lit(False)
    supported = F.lit(False)
    for module, (pattern, implementation) in MODULES.items():
        here = F.col("module_address") == module
        fits = fits | (here & F.col("condition_id").rlike(pattern))
        supported = supported | (here & (F.col("implementation") == implementation))
    rows = module_events.where((F.col("event_name") == "ConditionResolved") & fits)
    last = rows.groupBy("condition_id").agg(F.count("*").alias("resolutions"), F.max_by(F.struct(*[F.col(c) for c in rows.columns if c != "condition_id"]), F.struct("block_number", "log_index", "id")).alias("e"))
    last = last.select("condition_id", "resolutions", "e.*").join(epochs, "module_address", "left")
    last = last.withColumn("module_numerators", F.when(F.col("payouts").rlike(r"^\[\s*(0|[1-9][0-9]{0,6})\s*,\s*(0|[1-9][0-9]{0,6})\s*\]$"), payout_numbers(F.col("payouts"))))
    known = F.col("tx_hash").rlike(_TX) & (F.col("block_number") > 0) & (F.col("log_index") >= 0) & F.col("event_time").isNotNull()
    state = (
        F.when(F.col("resolutions") != 1, "CONFLICTING_MODULE_SETTLEMENTS").when(F.coalesce(total(F.col("module_numerators")) != "1000000", F.lit(True)), "INVALID_MODULE_PAYOUT")
        .when(~F.coalesce(known, F.lit(False)), "INCOMPLETE_MODULE_PROVENANCE").when(F.col("implementation").isNull(), "MODULE_IMPLEMENTATION_UNVERIFIED")
        .when(~supported, "MODULE_IMPLEMENTATION_UNSUPPORTED").otherwise("READY")
    )
    return last.select("condition_id", state.alias("module_readiness"), "module_numerators", F.lit("1000000").alias("module_denominator"), F.lit("V2_CONDITION_RESOLUTION").alias("settlement_basis"), F.lit(False).alias("terminal_zero"))


#: Implementation of the combination module whose results are understood: fixed value.
COMBO = ("0x30000034706c7d8e12009dab006be20000c031a8", "0x572cd48cce93b2e58f1cc0253a7fdd4b4952a9c2")


def combo_results(preparations: DataFrame, native: DataFrame, epochs: DataFrame) -> DataFrame:
    """Result of each combination, as settlement_evidence() takes it.

    preparations: id, condition_id, legs (array of 64-digit positions), block_number, log_index; of several the first
    counts, and different definitions conflict. A leg that pays nothing decides the combination; otherwise all legs
    need a result, and the payout is folded exactly for the unit 10**36.
    """
    from augury.operators import audits, oracle

    order = F.struct("block_number", "log_index", "id")
    first = preparations.groupBy("condition_id").agg(F.count_distinct(F.to_json(F.array("legs"))).alias("definitions"), F.min_by("legs", order).alias("legs"))
    each = first.select("condition_id", F.posexplode("legs").alias("ordinal", "leg"))
    results = native.select(F.col("condition_id").alias("__c"), "module_readiness", "module_numerators")
    each = each.join(results, F.concat(F.lit("0x"), F.substring("leg", 1, 62)) == F.col("__c"), "left")
    number = F.get("module_numerators", F.when(F.col("leg").endswith("01"), 1).otherwise(0)).try_cast("decimal(38,0)")
    ready = F.col("module_readiness") == "READY"
    stats = each.groupBy("condition_id").agg(
        F.count_if(F.col("__c").isNull()).alias("missing"), F.max(F.coalesce(ready & (number == 0), F.lit(False))).alias("terminal_zero"),
        *[F.max(F.coalesce(F.col("module_readiness") == s, F.lit(False))).alias(s) for s in ("CONFLICTING_MODULE_SETTLEMENTS", "INVALID_MODULE_PAYOUT", "INCOMPLETE_MODULE_PROVENANCE", "MODULE_IMPLEMENTATION_UNVERIFIED", "MODULE_IMPLEMENTATION_UNSUPPORTED")],
        F.transform(F.array_sort(F.collect_list(F.struct("ordinal", number.alias("n")))), lambda s: s["n"]).alias("numbers"),
    )
    own = epochs.where(F.col("module_address") == COMBO[0]).agg(F.max("implementation").alias("__own"))  # one row
    rows = first.join(stats, "condition_id", "left").crossJoin(F.broadcast(own))
    rows = rows.withColumn("paid", F.when(~F.col("terminal_zero") & (F.col("missing") == 0) & F.forall("numbers", lambda x: x.isNotNull()), oracle.combo_payout(F.col("numbers"))))
    state = (
        F.when(F.col("definitions") != 1, "CONFLICTING_COMBO_PREPARATION").when(~audits.valid_legs(F.col("legs")), "INVALID_COMBO_PREPARATION")
        .when(F.col("CONFLICTING_MODULE_SETTLEMENTS"), "CONFLICTING_MODULE_SETTLEMENTS").when(F.col("INVALID_MODULE_PAYOUT"), "INVALID_MODULE_PAYOUT").when(F.col("INCOMPLETE_MODULE_PROVENANCE"), "INCOMPLETE_MODULE_PROVENANCE")
        .when(F.col("__own").isNull() | F.col("MODULE_IMPLEMENTATION_UNVERIFIED"), "MODULE_IMPLEMENTATION_UNVERIFIED").when((F.col("__own") != COMBO[1]) | F.col("MODULE_IMPLEMENTATION_UNSUPPORTED"), "MODULE_IMPLEMENTATION_UNSUPPORTED")
        .when(F.col("terminal_zero") | (F.col("missing") == 0), "READY").otherwise("MISSING_COMBO_LEG_RESULT")
    )
    text = lambda hi, lo: F.regexp_replace(F.concat(F.lpad(hi.cast("string"), 19, "0"), F.lpad(lo.cast("string"), 18, "0")), "^0+(?=[0-9])", "")
    unit = F.lit(10**18).cast("decimal(19,0)")
    # What is left of the unit for the other side, limb by limb.
    borrow = F.when(F.col("paid.up.lo") > 0, 1).otherwise(0)
    other = text((unit - F.col("paid.up.hi") - borrow).cast("decimal(38,0)"), F.when(F.col("paid.up.lo") > 0, unit - F.col("paid.up.lo")).otherwise(0).cast("decimal(38,0)"))
    zero = F.coalesce("terminal_zero", F.lit(False))
    numerators = F.when(zero, F.array(F.lit("0"), F.lit(str(10**36)))).when(F.col("paid").isNotNull(), F.array(text(F.col("paid.down.hi"), F.col("paid.down.lo")), other))
    return rows.select("condition_id", state.alias("module_readiness"), numerators.alias("module_numerators"), F.lit(str(10**36)).alias("module_denominator"), F.lit("COMBO_LEG_RESOLUTIONS").alias("settlement_basis"), zero.alias("terminal_zero"))


def leg_checks(legs: DataFrame) -> DataFrame:
    """Legs (leg_id, condition_id, outcome_index, position: decimal text) with the position's word and whether it is that
    of its condition and outcome."""
    word = hexes.from_decimal(F.col("position"))
    module = F.col("condition_id").rlike(_MODULE) & F.col("outcome_index").between(0, 1)
    return legs.select("leg_id", F.coalesce(word, F.lit("")).alias("word"), F.coalesce(module & (word == hexes.position(F.col("condition_id"), F.col("outcome_index"))), F.lit(False)).alias("valid"))


_PAID = StructType([StructField("payout", StringType()), StructField("reason", StringType())])


def _paid(amount: pd.Series, numerator: pd.Series, denominator: pd.Series, basis: pd.Series, slot: pd.Series, zero: pd.Series) -> pd.DataFrame:
    """Products of two 256-bit numbers fit no column type, so they are taken in Python, a batch at a time."""
    out = []
    for a, n, d, by, k, none in zip(amount, numerator, denominator, basis, slot, zero):
        if a is None or not (a.isascii() and a.isdigit()) or int(a) >= 2**256:
            out.append((None, "amount is no 256-bit number"))
            continue
        a, n, d = int(a), int(n), int(d)
        combo = by == "COMBO_LEG_RESOLUTIONS"
        if not 0 <= n <= d or not d:
            out.append((None, "invalid payout fraction"))
        elif combo and none:
            out.append((str(a if k == 1 else 0), None))
        # The contract multiplies the up factor for the second side and takes what is left.
        elif a * (d - n if combo and k == 1 else n) >= 2**256:
            out.append((None, "product is over 256 bits"))
        else:
            out.append((str(a * n // d), None))
    return pd.DataFrame(out, columns=["payout", "reason"], dtype=object)


def payout_for_amount(evidence: DataFrame, positions: DataFrame) -> DataFrame:
    """Payout of held amounts (market_id, token_id, amount: whole number or its decimal text) as decimal text:
    floor(amount * numerator / denominator) of READY markets, exact for 256 bits; where nothing pays, a reason."""
    ready = evidence.where("readiness = 'READY'").select("market_id", "settlement_basis", "terminal_zero", F.explode("payouts").alias("p")).select("market_id", "settlement_basis", "terminal_zero", "p.*")
    paid = ready.groupBy("market_id", "token_id").agg(F.count("*").alias("__n"), F.first(F.struct("numerator", "denominator", "settlement_basis", "outcome_index", "terminal_zero")).alias("f"))
    rows = positions.join(paid, ["market_id", "token_id"], "left").join(evidence.select("market_id", "readiness"), "market_id", "left")
    why = F.when(F.col("readiness").isNull(), "unknown market").when(F.col("readiness") != "READY", F.col("readiness")).when(F.coalesce("__n", F.lit(0)) != 1, "unknown token")
    marked = rows.withColumn("__why", why)
    one = F.col("__why").isNull()
    f = lambda c, of: F.when(one, of).otherwise(F.lit(c))  # noqa: E731  rows that cannot pay take no part in the arithmetic
    got = F.pandas_udf(_paid, _PAID)(F.col("amount").cast("string"), f("0", F.col("f.numerator")), f("1", F.col("f.denominator")), F.col("f.settlement_basis"), F.col("f.outcome_index"), F.coalesce("f.terminal_zero", F.lit(False)))
    out = marked.withColumn("__paid", got)
    return out.select("market_id", "token_id", "amount", F.when(one, F.col("__paid.payout")).alias("payout"), F.coalesce("__why", "__paid.reason").alias("reason"))
