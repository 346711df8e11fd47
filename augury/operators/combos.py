"""Official combinations: identities that trades, activity evidence and details agree on, and how they are installed.

fills: position (64 hex digits), tx_hash, block_time. activity: id, tx_hash, position, is_combo, condition_id, title,
outcome. details: id, position, condition_id, module_id, legs (array of title and outcome).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.operators import audits, registry, tables

MODULE = 3
DETAILED, PENDING = "activity_and_combo_detail", "exact_activity_combo_detail_pending"


def legs_title(legs: Column) -> Column:
    """Titles of legs, each with its outcome unless the title says it, joined by AND."""
    one = lambda x: F.when(F.contains(F.lower(x["title"]), F.lower(x["outcome"])) | (F.coalesce(x["outcome"], F.lit("")) == ""), x["title"]).otherwise(F.concat(x["title"], F.lit(": "), x["outcome"]))
    return F.array_join(F.transform(F.filter(legs, lambda x: F.coalesce(x["title"], F.lit("")) != ""), one), " AND ")


def resolve(fills: DataFrame, activity: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved, unresolved with reason) conditions.

    Every transaction and position of a condition needs an activity of exactly these two (the first by id counts) that is marked a combination,
    names the condition of the position, no outcome and a title; all of a condition's titles must be one. Details of either position
    are checked if they are there, and pending if not. Positions stay position_0 and position_1: which of them is yes is not
    known. Positions that do not decode are unresolved by themselves.
    """
    parts = audits.decode_position(F.col("position"))
    rows = fills.select("position", "tx_hash", "block_time", parts["valid"].alias("valid"), parts["condition"].alias("condition_id"))
    odd = rows.where("not coalesce(valid, false)").select(F.coalesce("position", F.lit("")).alias("condition_id"), F.lit("NOT_A_COMBO_POSITION").alias("reason")).distinct()
    keys = rows.where("valid").groupBy("condition_id", "tx_hash", "position").agg(F.min("block_time").alias("block_time"))
    first = activity.groupBy("tx_hash", "position").agg(F.min_by(F.struct("is_combo", F.lower("condition_id").alias("named"), "title", "outcome"), "id").alias("a"))
    seen = keys.join(first, ["tx_hash", "position"], "left")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    # The number in front orders reasons: the least one is a condition's.
    wrong = F.when(F.col("a").isNull(), "1 NO_EXACT_ACTIVITY").when(~F.coalesce("a.is_combo", F.lit(False)), "2 NOT_MARKED_AS_COMBO").when(~F.col("a.named").eqNullSafe(F.col("condition_id")), "3 CONDITION_CONFLICT").when(~blank(F.col("a.outcome")), "4 LOGICAL_OUTCOME").when(blank(F.col("a.title")), "5 NO_TITLE")
    title = registry.collapsed(F.col("a.title"))
    each = seen.groupBy("condition_id").agg(
        F.min(wrong).alias("wrong"), F.min(title).alias("title"), F.max(title).alias("other"), F.min("block_time").alias("created_at"), F.count_distinct("tx_hash").alias("transactions"), F.count_distinct("position").alias("assets"),
    )
    of = audits.decode_position(F.col("position"))
    told = details.withColumn("own", of["condition"]).where("own is not null").groupBy("own").agg(F.min_by(F.struct("module_id", F.lower("condition_id").alias("named"), "legs"), "id").alias("d"))
    both = each.join(told.withColumnRenamed("own", "condition_id"), "condition_id", "left")
    bad_detail = F.when(F.col("d").isNull(), None).when(~F.col("d.module_id").eqNullSafe(F.lit(MODULE)), "7 DETAIL_MODULE").when(~F.col("d.named").eqNullSafe(F.col("condition_id")), "8 DETAIL_CONDITION").when(F.coalesce(F.size("d.legs"), F.lit(0)) < 1, "9 DETAIL_WITHOUT_LEGS")
    reason = F.coalesce("wrong", F.when(F.col("title") != F.col("other"), "6 TITLES_DISAGREE"), bad_detail)
    good, bad = tables.split(both.withColumn("reason", F.substring(reason, 3, 40)))
    head = F.substring("condition_id", 3, 62)
    resolved = good.select(
        "condition_id", F.concat(head, F.lit("00")).alias("position_0"), F.concat(head, F.lit("01")).alias("position_1"), "title", F.coalesce(legs_title(F.col("d.legs")), F.lit("")).alias("legs_title"), "created_at", "transactions", "assets",
        F.when(F.col("d").isNull(), PENDING).otherwise(DETAILED).alias("evidence"),
    )
    return resolved, bad.select("condition_id", "reason").unionByName(odd)


def install(resolved: DataFrame, markets: DataFrame, tokens: DataFrame) -> DataFrame:
    """What installing each resolved combination does: CREATED, PROMOTED (an exact legacy combination), KEPT, or
    TOKEN_OWNED_ELSEWHERE and IDENTITY_CONFLICT, which change nothing.

    markets: condition_id, identity_kind, gamma_market_id, question_id, yes_token, no_token; tokens: token_id, condition_id.
    """
    pair = resolved.select("condition_id", F.explode(F.array("position_0", "position_1")).alias("token_id"))
    held = tokens.select("token_id", F.lower("condition_id").alias("owner"))
    foreign = pair.join(held, "token_id").where("owner <> condition_id").select("condition_id").distinct().withColumn("foreign", F.lit(True))
    there = markets.select(F.lower("condition_id").alias("condition_id"), "identity_kind", "gamma_market_id", "question_id", "yes_token", "no_token")
    rows = resolved.join(foreign, "condition_id", "left").join(there, "condition_id", "left")
    empty = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    exact = empty("gamma_market_id") & empty("question_id") & F.col("yes_token").eqNullSafe(F.col("position_0")) & F.col("no_token").eqNullSafe(F.col("position_1"))
    result = (
        F.when(F.col("foreign"), "TOKEN_OWNED_ELSEWHERE").when(F.col("identity_kind").isNull(), "CREATED").when((F.col("identity_kind") == "legacy_combo") & exact, "PROMOTED")
        .when((F.col("identity_kind") == "official_combo") & exact, "KEPT").otherwise("IDENTITY_CONFLICT")
    )
    slug = F.concat(F.lit("official-combo-"), F.substring("condition_id", 3, 16))
    return rows.select("condition_id", "title", slug.alias("slug"), result.alias("result"))


def token_rows(installed: DataFrame, resolved: DataFrame) -> DataFrame:
    """Both tokens of each installed combination: condition_id, token_id, outcome (position_0 or position_1), outcome_index."""
    done = resolved.join(installed.where(F.col("result").isin("CREATED", "PROMOTED", "KEPT")).select("condition_id"), "condition_id", "left_semi")
    return done.select("condition_id", F.posexplode(F.array("position_0", "position_1")).alias("outcome_index", "token_id")).withColumn("outcome", F.concat(F.lit("position_"), F.col("outcome_index").cast("string")))
