"""Qualification of a desired catalogue at one cut: tokens by lane, markets, reasons by number, gates and written outputs.

desired: market, token. owners: market, cohort, identity_ok. unadmitted: market, reason. nodes: plant, cohort,
applied_offset, durable_offset, errors (array). states: market, token, plant, lane, connection, epoch, shard, written,
book_seen, baseline_connection, baseline_offset, baseline_durable, receipt_offset, eligibility (array), ready, status.
lanes: the few (plant, lane) that there are. gateway: market, ready, reasons (array), qualified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.sources import sinks

STAGES = ["assigned", "session_assigned", "written", "book_seen", "baseline_durable", "ready_reported", "qualified"]
PARENT = "GATEWAY_PARENT_OUTSIDE_CAPTURED_PLANT_PREFIX"


def _all(*found: tuple[Column, str | Column]) -> Column:
    """The reasons that hold, in order."""
    listed = F.array(*[F.when(test, F.lit(name) if isinstance(name, str) else name) for test, name in found])
    return F.filter(listed, lambda x: x.isNotNull())


def token_rows(desired: DataFrame, owners: DataFrame, unadmitted: DataFrame, nodes: DataFrame, states: DataFrame, lanes: DataFrame) -> DataFrame:
    """Every desired token on every lane, with the stages it has reached, all reasons against it in order, and the first.

    A token qualifies if it is reported ready, written, with a book of its current connection whose baseline is durable
    within the node's cut, and no reason speaks against it. Several states of a token on a lane are a reason; the one with
    the greatest connection is shown.
    """
    key = ["market", "token", "plant", "lane"]
    fields = [c for c in states.columns if c not in key]
    one = states.groupBy(*key).agg(F.count("*").alias("copies"), F.max(F.struct(*fields)).alias("s"))
    grid = desired.join(owners, "market", "left").join(unadmitted.withColumnRenamed("reason", "held"), "market", "left").crossJoin(F.broadcast(lanes))
    rows = grid.join(nodes.select("plant", "cohort", "applied_offset", "durable_offset", F.col("errors").alias("node_errors")), ["plant", "cohort"], "left").join(one, key, "left")
    ok = lambda c: F.coalesce(c, F.lit(False))
    s = lambda c: F.col(f"s.{c}")
    assigned, there = F.col("cohort").isNotNull(), F.col("s").isNotNull()
    current = ok(there & s("connection").isNotNull() & s("epoch").isNotNull())
    written = current & ok(s("written"))
    book = current & ok(s("book_seen")) & ok(s("baseline_connection") == s("connection"))
    durable = book & ok(s("baseline_durable")) & ok((s("receipt_offset") == s("baseline_offset")) & (s("baseline_offset") <= F.col("applied_offset")) & (F.col("applied_offset") <= F.col("durable_offset")))
    pending = ~ok(s("baseline_durable")) & ok(s("baseline_offset") > F.coalesce("applied_offset", F.lit(-1)))
    ready = ok(s("ready"))
    own = _all(
        (assigned & ~ok(F.col("identity_ok")), "ASSIGNED_IDENTITY_MISMATCH"), (F.col("held").isNotNull(), F.col("held")), (~assigned, "DESIRED_UNASSIGNED"), (ok(F.col("copies") > 1), "DUPLICATE_ACTIVE_STATE"), (~there, "NO_CURRENT_ACTIVE_ROUTE"),
        (current & ~written, "SUBSCRIPTION_WRITE_EVIDENCE_MISSING"), (current & ~book, "CURRENT_NATIVE_BASELINE_MISSING"), (book & ~durable & pending, "CAPTURE_PENDING_DURABLE"), (book & ~durable & ~pending, "BASELINE_DURABILITY_EVIDENCE_INVALID"),
    )
    late = _all((there & ~ready, F.coalesce(s("status"), F.lit("NOT_READY"))), (ready & ~(written & book & durable), "READY_EVIDENCE_CONTRADICTION"))
    none = F.array().cast("array<string>")
    reasons = F.array_distinct(F.concat(F.coalesce("node_errors", none), own, F.coalesce(s("eligibility"), none), late))
    out = rows.select(*key, assigned.alias("assigned"), current.alias("session_assigned"), written.alias("written"), book.alias("book_seen"), durable.alias("baseline_durable"), ready.alias("ready_reported"), s("connection").alias("connection"), s("epoch").alias("epoch"), s("shard").alias("shard"), ok(F.col("copies") > 1).alias("duplicate"), reasons.alias("reasons"))
    return out.withColumn("qualified", F.col("ready_reported") & F.col("written") & F.col("book_seen") & F.col("baseline_durable") & (F.size("reasons") == 0)).withColumn("primary_reason", F.coalesce(F.get("reasons", F.lit(0)), F.lit("READY")))


def market_rows(tokens: DataFrame, gateway: DataFrame, lanes: DataFrame) -> DataFrame:
    """Each desired market with its complete lanes: both tokens qualify there on one connection, shard and epoch. Columns
    complete and missing (lanes as plant:lane), any_complete_source, both_plants, all_lanes, and what its gateway says."""
    name = F.concat_ws(":", F.col("plant").cast("string"), F.col("lane").cast("string"))
    route = F.struct("connection", "shard", "epoch")
    per = tokens.groupBy("market", "plant", "lane").agg(((F.count("*") == 2) & F.min("qualified") & (F.min(route) == F.max(route))).alias("pair"))
    per = per.withColumn("pair", F.coalesce("pair", F.lit(False)))
    n_lanes, n_plants = (lanes.agg(F.count("*"), F.count_distinct("plant")).first())
    out = per.groupBy("market").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("pair"), name))), ",").alias("complete"), F.array_join(F.array_sort(F.collect_list(F.when(~F.col("pair"), name))), ",").alias("missing"),
        F.max("pair").alias("any_complete_source"), (F.count_distinct(F.when(F.col("pair"), F.col("plant"))) == n_plants).alias("both_plants"), (F.count_if("pair") == n_lanes).alias("all_lanes"),
    )
    g = gateway.select("market", F.col("ready").alias("gateway_ready_reported"), F.col("reasons").alias("gateway_reasons"), F.col("qualified").alias("gateway_qualified"))
    return out.join(g, "market", "left").fillna(False, ["gateway_ready_reported", "gateway_qualified"])


def reason_counts(tokens: DataFrame) -> DataFrame:
    """By plant, lane and reason: tokens of which it is the first reason, and tokens that have it at all."""
    first = tokens.groupBy("plant", "lane", F.col("primary_reason").alias("reason")).agg(F.count("*").alias("n_primary"))
    every = tokens.select("plant", "lane", F.explode("reasons").alias("reason")).groupBy("plant", "lane", "reason").agg(F.count("*").alias("n_all"))
    return first.join(every, ["plant", "lane", "reason"], "full_outer").fillna(0, ["n_primary", "n_all"])


def stage_counts(tokens: DataFrame) -> DataFrame:
    """By plant and lane: tokens that have reached each stage."""
    return tokens.groupBy("plant", "lane").agg(F.count("*").alias("tokens"), *[F.count_if(c).alias(c) for c in STAGES])


def gates(desired: DataFrame, owners: DataFrame, explained: DataFrame, unadmitted: DataFrame, nodes: DataFrame, tokens: DataFrame, markets: DataFrame, lanes: DataFrame) -> DataFrame:
    """The twelve gates with PASS or FAIL. explained: markets whose retirement has evidence."""
    one = lambda df, *aggs: df.agg(*aggs)
    twice = lambda df, key: df.groupBy(key).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias(f"twice_{key}"))
    facts = one(desired, F.count("*").alias("n_tokens"), F.count_distinct("market").alias("n_markets"))
    retired = owners.select("market").distinct().join(desired.select("market").distinct(), "market", "left_anti").join(explained.select("market").distinct(), "market", "left_anti")
    unassigned = desired.select("market").distinct().join(owners.select("market"), "market", "left_anti")
    met = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(f"n_{c}")
    for part in (
        one(lanes, F.count("*").alias("n_lanes")), one(tokens, F.count("*").alias("n_rows"), F.count_if("duplicate").alias("n_duplicate")), twice(desired, "token"), twice(owners, "market"), one(owners, F.count_if(~F.col("identity_ok")).alias("n_mismatch")),
        one(retired, F.count("*").alias("n_retired")), one(unassigned, F.count("*").alias("n_unassigned")), one(nodes, F.count_if(F.size("errors") > 0).alias("n_bad_nodes")), one(unadmitted, F.count("*").alias("n_unadmitted")),
        one(markets, *[met(c) for c in ("any_complete_source", "both_plants", "all_lanes", "gateway_qualified")], F.count_if(F.coalesce(F.array_contains("gateway_reasons", PARENT), F.lit(False))).alias("n_parent")),
    ):
        facts = facts.crossJoin(part)  # one row each
    n = F.col
    tests = {
        "denominator_rows_complete": n("n_rows") == n("n_tokens") * n("n_lanes"), "unique_market_and_token_identity": (n("twice_market") == 0) & (n("twice_token") == 0) & (n("n_duplicate") == 0), "routing_plan_matches_catalog": n("n_mismatch") == 0,
        "all_desired_assigned": n("n_unassigned") == 0, "retired_assignments_explained": n("n_retired") == 0, "same_revision_fresh_exact_node_cuts": n("n_bad_nodes") == 0, "gateway_parent_prefixes_closed": n("n_parent") == 0, "discovery_identity_resolution": n("n_unadmitted") == 0,
        "all_desired_have_complete_source": n("n_any_complete_source") == n("n_markets"), "all_desired_both_plants": n("n_both_plants") == n("n_markets"), "all_desired_four_lanes": n("n_all_lanes") == n("n_markets"), "all_desired_gateway_qualified": n("n_gateway_qualified") == n("n_markets"),
    }
    return facts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("gate"), F.when(test, "PASS").otherwise("FAIL").alias("result")) for name, test in tests.items()])).alias("g")).select("g.*")


def write_report(tokens: DataFrame, markets: DataFrame, reasons: DataFrame, found: DataFrame, path: str) -> DataFrame:
    """Write all four tables and read them back; returns the receipts (table, n, digest)."""
    return sinks.write_outputs({"token_state_at_cut": tokens, "market_gap_attribution": markets, "reasons": reasons, "gates": found}, path)
