"""Who owns conditions and tokens of the registry: rows that may be written, promotions of local shells, and the write.

rows: condition_id, yes_token, no_token, gamma_market_id, category, normalized (whether strict rules made the row).
markets: market_id, condition_id, identity_kind, gamma_market_id, category, slug. tokens: token_id, market_id, condition_id,
id, outcome, outcome_index. Conditions are compared in lower case. Of rows that repeat a condition the greatest counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.operators import tables
from augury.sources.shared import written

CANONICAL, STRUCTURAL = "canonical_gamma", "protocol_structural"
#: Marks of shells that a strict identity may replace: fixed values.
SHELL_CATEGORY, SHELL_SLUG = "orderfilled-placeholder", "trade-indexer-placeholder-"
MARKET = ["market_id", "condition_id", "identity_kind", "gamma_market_id", "category", "slug"]
TOKEN = ["token_id", "market_id", "condition_id", "id", "outcome", "outcome_index"]


def _text(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))


def _shell(prefix: str = "") -> Column:
    low = lambda c: F.lower(_text(F.col(prefix + c)))
    return (low("identity_kind") == STRUCTURAL) | ((low("gamma_market_id") == "") & ((low("category") == SHELL_CATEGORY) | low("slug").startswith(SHELL_SLUG)))


def _one_each(rows: DataFrame) -> DataFrame:
    """One row for each condition, with whether it is strict."""
    low = rows.withColumn("condition_id", F.lower("condition_id"))
    one = low.groupBy("condition_id").agg(F.max(F.struct("normalized", "gamma_market_id", "yes_token", "no_token", "category")).alias("r")).select("condition_id", "r.*")
    strict = F.coalesce(F.col("normalized"), F.lit(False)) & (_text(F.col("gamma_market_id")) != "") & (_text(F.col("yes_token")) != "") & (_text(F.col("no_token")) != "") & (F.col("yes_token") != F.col("no_token"))
    return one.withColumn("strict", F.coalesce(strict, F.lit(False)))


def filter_ownership(rows: DataFrame, markets: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted rows, evidence of conflicts, promotions).

    A condition that is there already must be canonical with the row's id, or a shell that a strict row may replace
    (promotion market_identity). A token that several rows claim stays with its owner if that is one of them, the others
    are rejected; a token of another condition can be taken from a shell only (promotion token_rehome). One conflict
    rejects the whole row, with its promotions.
    """
    own = _one_each(rows)
    held = markets.select(*[F.col(c).alias(f"m_{c}") for c in MARKET]).withColumn("condition_id", F.lower("m_condition_id"))
    known = own.join(held, "condition_id").where(~((F.lower(_text(F.col("m_identity_kind"))) == CANONICAL) & (_text(F.col("m_gamma_market_id")) == _text(F.col("gamma_market_id")))))
    known = known.withColumn("may", F.col("strict") & _shell("m_"))
    blank = F.lit("")
    promoted = known.where("may").select(F.lit("market_identity").alias("kind"), blank.alias("token_id"), F.col("m_market_id").alias("from_market_id"), F.col("condition_id").alias("from_condition_id"), F.col("condition_id").alias("to_condition_id"))
    evidence = known.where("not may").select(F.lit("condition_identity_conflict").alias("kind"), blank.alias("token_id"), F.col("condition_id").alias("existing"), F.col("condition_id").alias("attempted"))
    claims = own.select("condition_id", "strict", F.explode(F.array_distinct(F.array("yes_token", "no_token"))).alias("token_id"))
    # Partial minima and maxima tell whether a token is claimed by several conditions, however many claim it.
    shared = claims.groupBy("token_id").agg((F.min("condition_id") != F.max("condition_id")).alias("several"))
    owner = tokens.select("token_id", F.col("market_id").alias("m_market_id"), F.lower("condition_id").alias("held_by")).join(
        markets.select(F.col("market_id").alias("m_market_id"), F.lower("condition_id").alias("held_market"), *[F.col(c).alias(f"m_{c}") for c in ("identity_kind", "gamma_market_id", "category", "slug")]), "m_market_id", "left")
    each = claims.join(shared, "token_id").join(owner, "token_id", "left")
    foreign = F.col("held_by").isNotNull() & ((F.col("held_by") != F.col("condition_id")) | ~F.col("held_market").eqNullSafe(F.col("condition_id")))
    lost = F.col("several") & ~F.col("held_by").eqNullSafe(F.col("condition_id"))
    moves = ~F.col("several") & foreign
    rehome = moves & F.col("strict") & _shell("m_")
    evidence = evidence.unionByName(each.where(lost | (moves & ~rehome)).select(F.lit("token_ownership_conflict").alias("kind"), "token_id", F.when(F.col("several"), F.coalesce("held_by", F.lit("batch"))).otherwise(F.coalesce("held_market", "held_by")).alias("existing"), F.col("condition_id").alias("attempted")))
    promoted = promoted.unionByName(each.where(rehome).select(F.lit("token_rehome").alias("kind"), "token_id", F.col("m_market_id").alias("from_market_id"), F.col("held_by").alias("from_condition_id"), F.col("condition_id").alias("to_condition_id")))
    evidence = written(evidence, "evidence")
    rejected = evidence.select(F.col("attempted").alias("condition_id")).distinct()
    accepted = own.join(rejected, "condition_id", "left_anti")
    return accepted, evidence, promoted.join(rejected.withColumnRenamed("condition_id", "to_condition_id"), "to_condition_id", "left_anti")


def write_registry(accepted: DataFrame, promotions: DataFrame, markets: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(markets, tokens, failures) after writing accepted rows.

    Known conditions keep their ids; new ones get the ids after the highest, in the order of their conditions. A promotion is
    a compare and swap: it counts if the market or token still belongs to what it names, or is where it should go already;
    otherwise its row is refused (CHANGED_SINCE) and writes nothing. Afterwards both tokens of each written row must be
    exactly as expected: failures has those that are not (NOT_INSTALLED).
    """
    now = tokens.select("token_id", F.col("market_id").alias("now_market"), F.lower("condition_id").alias("now_condition"))
    homes = markets.select(F.lower("condition_id").alias("to_condition_id"), F.col("market_id").alias("home"))
    swaps = promotions.join(now, "token_id", "left").join(homes, "to_condition_id", "left")
    as_named = (F.col("now_market") == F.col("from_market_id")) & (F.col("now_condition") == F.col("from_condition_id"))
    as_wanted = (F.col("now_market") == F.col("home")) & (F.col("now_condition") == F.col("to_condition_id"))
    valid = F.when(F.col("kind") == "market_identity", F.col("home") == F.col("from_market_id")).otherwise(as_named | as_wanted)
    stale = written(swaps.where(~F.coalesce(valid, F.lit(False))).select(F.col("to_condition_id").alias("condition_id")).distinct(), "stale")
    rows = accepted.join(stale, "condition_id", "left_anti")
    there = markets.select(F.lower("condition_id").alias("condition_id"), "market_id")
    top = markets.agg(F.coalesce(F.max("market_id"), F.lit(0)).alias("__top"))
    fresh = rows.join(there, "condition_id", "left_anti").select("condition_id")
    new = tables.ranked(fresh, ["condition_id"], "__n").crossJoin(F.broadcast(top)).select("condition_id", (F.col("__top") + F.col("__n") + 1).alias("market_id"))
    ids = written(rows.join(there.unionByName(new), "condition_id"), "registered")
    changed = ids.select("market_id", F.lit(CANONICAL).alias("n_kind"), F.col("gamma_market_id").alias("n_gamma"), F.col("category").alias("n_category"))
    kept = markets.join(changed, "market_id", "left").select("market_id", "condition_id", F.coalesce("n_kind", "identity_kind").alias("identity_kind"), F.when(F.col("n_kind").isNotNull(), F.col("n_gamma")).otherwise(F.col("gamma_market_id")).alias("gamma_market_id"), F.when(F.col("n_kind").isNotNull(), F.col("n_category")).otherwise(F.col("category")).alias("category"), "slug")
    added = ids.join(new.select("condition_id"), "condition_id", "left_semi").select("market_id", "condition_id", F.lit(CANONICAL).alias("identity_kind"), "gamma_market_id", "category", F.lit(None).cast("string").alias("slug"))
    slot = lambda token, side, index: F.struct(F.col(token).alias("token_id"), (-(2 * F.col("market_id") - 1 + index)).alias("id"), F.lit(side).alias("outcome"), F.lit(index).alias("outcome_index"))
    wanted = ids.select("market_id", "condition_id", F.explode(F.array(slot("yes_token", "YES", 0), slot("no_token", "NO", 1))).alias("t")).select("t.token_id", "market_id", "condition_id", "t.id", "t.outcome", "t.outcome_index")
    moved = promotions.where("kind = 'token_rehome'").select("token_id", F.col("to_condition_id").alias("condition_id")).withColumn("__moves", F.lit(True))
    # A token is inserted if it is not there, and changed if it is its condition's or a promotion moves it.
    current = tokens.select("token_id", F.lower("condition_id").alias("__condition")).join(wanted.join(moved, ["token_id", "condition_id"], "left"), "token_id", "left")
    replaced = current.where((F.col("__condition") == F.col("condition_id")) | F.col("__moves")).select(*TOKEN)
    inserted = wanted.join(tokens.select("token_id"), "token_id", "left_anti").select(*TOKEN)
    after = written(tokens.join(replaced.select("token_id"), "token_id", "left_anti").select(*TOKEN).unionByName(replaced).unionByName(inserted), "tokens")
    exact = after.select(F.col("token_id").alias("t"), F.struct("market_id", F.lower("condition_id").alias("condition_id"), "outcome", "outcome_index").alias("__is"))
    checked = wanted.join(exact, wanted["token_id"] == F.col("t"), "left")
    bad = checked.where(~F.col("__is").eqNullSafe(F.struct("market_id", "condition_id", "outcome", "outcome_index"))).select("condition_id", "token_id", F.lit("NOT_INSTALLED").alias("failure"))
    failures = stale.select("condition_id", F.lit("").alias("token_id"), F.lit("CHANGED_SINCE").alias("failure")).unionByName(bad)
    return kept.unionByName(added), after, failures
