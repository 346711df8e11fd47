"""Reconciliation: ordered streams, receipts by segment, owners, stages, lanes, routes, windows of repair, pending entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from augury.operators import registry, tables


def recent_days(spark: SparkSession, path: str, day: str, today: int, second: int, window: int) -> DataFrame:
    """Rows of a table partitioned by a day number: today's, and yesterday's only if the window of so many seconds before
    the given second of today reaches into it, or today has none. Other days are pruned."""
    df = spark.read.parquet(path)
    now = df.where(F.col(day) == today)
    both = second < window or not now.limit(1).count()
    return df.where(F.col(day).isin(today, today - 1)) if both else now


def receive_order(rows: DataFrame) -> DataFrame:
    """Per connection (connection, recv_seq, id): rows whose number does not follow the one before, and repeated ids."""
    w = Window.partitionBy("connection").orderBy("recv_seq", "id")
    broken = rows.withColumn("__b", F.coalesce(F.col("recv_seq") != F.lag("recv_seq").over(w) + 1, F.lit(False))).groupBy("connection").agg(F.count("*").alias("records"), F.count_if("__b").alias("breaks"))
    twice = rows.groupBy("connection", "id").agg(F.count("*").alias("__n")).groupBy("connection").agg(F.sum(F.col("__n") - 1).alias("repeats"))
    return broken.join(twice, "connection")


def sampled(df: DataFrame, keys: list[str], seed: int, k: int) -> DataFrame:
    """The k rows whose keys have the least hash with the seed: the same ones in every run and however the rows lie. A
    report of k rows: each task hands on k."""
    order = F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys]), 256)
    return df.withColumn("__h", order).orderBy("__h", *keys).limit(k).drop("__h")


def merged_order(rows: DataFrame) -> DataFrame:
    """Rows (stream, offset, created and more) with `at`, by which a merge of the streams emits them: the time of a row,
    or of one before it in its stream that is later. Sorting by (at, stream, offset) keeps every stream's own order."""
    w = Window.partitionBy("stream").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("at", F.max("created").over(w))


def token_pairs(markets: DataFrame, tokens: DataFrame) -> DataFrame:
    """Whether each market (market_id, yes_token, no_token) owns exactly its two tokens in tokens (token_id, market_id,
    outcome_index): the first in slot 0, the second in slot 1."""
    owned = tokens.groupBy("market_id").agg(F.count("*").alias("owned"), *[F.max(F.when(F.col("outcome_index") == k, F.col("token_id"))).alias(f"__{k}") for k in (0, 1)])
    both = markets.join(owned, "market_id", "left")
    exact = (F.col("owned") == 2) & (F.col("__0") == F.col("yes_token")) & (F.col("__1") == F.col("no_token"))
    return both.select("market_id", F.coalesce("owned", F.lit(0).cast("long")).alias("owned"), F.coalesce(exact, F.lit(False)).alias("verified"))


def in_segments(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows (stream, offset and more) with the segment (stream, segment, first, last) that holds their offset, null for
    none. Segments of a stream do not overlap, so the last one that begins before a row is the only candidate: one sort
    by stream and offset instead of a range join."""
    marks = segments.select("stream", F.col("first").alias("offset"), F.struct("segment", "last").alias("__s"), F.lit(0).alias("__k"))
    both = rows.withColumn("__k", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    w = Window.partitionBy("stream").orderBy("offset", "__k").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__f", F.last("__s", ignorenulls=True).over(w)).where("__k = 1")
    return found.withColumn("segment", F.when(F.col("offset") <= F.col("__f.last"), F.col("__f.segment"))).drop("__s", "__k", "__f")


def gap_attribution(gaps: DataFrame, segments: DataFrame, states: DataFrame) -> DataFrame:
    """Gaps (stream, offset, token, at) with the archive segment that holds them, the token's latest state (token, at,
    ready, reason) at that moment, and what they are put down to."""
    placed = in_segments(gaps, segments)
    both = placed.withColumn("__k", F.lit(1)).unionByName(states.select("token", "at", F.struct("ready", "reason").alias("__s"), F.lit(0).alias("__k")), allowMissingColumns=True)
    w = Window.partitionBy("token").orderBy("at", "__k").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("__f", F.last("__s", ignorenulls=True).over(w)).where("__k = 1")
    cause = F.when(F.col("segment").isNull(), "NOT_ARCHIVED").when(F.col("__f").isNull(), "NO_STATE").when(~F.col("__f.ready"), F.col("__f.reason")).otherwise("UNEXPLAINED")
    return seen.select("stream", "offset", "token", "segment", cause.alias("cause"))


def without_disposition(raw: DataFrame, dispositions: DataFrame, keys: list[str]) -> DataFrame:
    """Raw rows that no disposition mentions."""
    return raw.join(dispositions.select(*keys).distinct(), keys, "left_anti")


def merge_owners(existing: DataFrame, recent: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(owners, conflicts) of keys (key, owner): what exists goes before what is recent; a key with two owners is a
    conflict and keeps the existing one."""
    a, b = existing.select("key", F.col("owner").alias("__a")), recent.groupBy("key").agg(F.min("owner").alias("__b"), F.max("owner").alias("__c"))
    both = a.join(b, "key", "full_outer")
    differs = F.coalesce((F.col("__a") != F.col("__b")) | (F.col("__a") != F.col("__c")), F.lit(False)) | F.coalesce(F.col("__b") != F.col("__c"), F.lit(False))
    return both.select("key", F.coalesce("__a", "__b").alias("owner")), both.where(differs).select("key", "__a", F.col("__b").alias("first"), F.col("__c").alias("last")).withColumnRenamed("__a", "owner")


def failure_versions(ledger: DataFrame, k: int) -> DataFrame:
    """The k sources whose open failures of normalisation were checked or seen longest ago, with each failure's
    occurrences, in the order of its key. ledger: source, failure_key, kind, status, occurrences, checked_at, first_seen."""
    open_ = ledger.where((F.col("status") == "open") & (F.col("kind") == "normalize_error") & (F.col("source") != ""))
    per = open_.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("failure_key", "occurrences"))).alias("__v"), F.min(F.coalesce("checked_at", "first_seen")).alias("oldest"))
    return per.orderBy("oldest", "source").limit(k).select("source", "oldest", F.map_from_entries("__v").alias("versions"))


def stage_sets(rows: DataFrame) -> DataFrame:
    """Tokens of each lane that are missing a stage: expected but not written, written but without a book, expected but not
    ready. rows: token, lane, expected, written, seen, ready."""
    ok = lambda c: F.coalesce(F.col(c), F.lit(False))
    sets = F.array(
        F.when(ok("expected") & ~ok("written"), F.lit("EXPECTED_NOT_WRITTEN")), F.when(ok("written") & ~ok("seen"), F.lit("WRITTEN_NOT_SEEN")), F.when(ok("expected") & ~ok("ready"), F.lit("EXPECTED_NOT_READY")),
    )
    return rows.select("token", "lane", F.explode(F.filter(sets, lambda x: x.isNotNull())).alias("stage"))


def active_states(states: DataFrame, routes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(active, candidates) of token states (token, shard, connection, id): a state is active only if the route of its token
    (token, shard, connection) names the same shard and connection; several active ones are flagged as duplicates."""
    r = routes.select("token", F.col("shard").alias("__shard"), F.col("connection").alias("__connection"))
    marked = states.join(r, "token", "left").withColumn("__on", F.coalesce((F.col("shard") == F.col("__shard")) & (F.col("connection") == F.col("__connection")), F.lit(False))).drop("__shard", "__connection")
    active = marked.where("__on").drop("__on")
    copies = active.groupBy("token").agg((F.count("*") > 1).alias("duplicate"))
    return active.join(copies, "token"), marked.where("not __on").drop("__on")


def merged_lanes(*lanes: DataFrame) -> DataFrame:
    """Rows of several lanes (lane, key, at and more): the latest row of each key, then the highest lane, with the set of
    lanes that had it. Partial before the shuffle."""
    both = lanes[0]
    for other in lanes[1:]:
        both = both.unionByName(other)
    rest = [c for c in both.columns if c not in ("lane", "key")]
    last = F.max_by(F.struct(*rest), F.struct("at", "lane")).alias("__r")
    return both.groupBy("key").agg(last, F.array_sort(F.collect_set("lane")).alias("lanes")).select("key", "__r.*", "lanes")


def compare_windows(expected: DataFrame, stored: DataFrame, keys: list[str], place: str, size: int) -> DataFrame:
    """Per window of `size` places: expected and stored rows, keys missing, superfluous and changed, a digest of the
    expected rows that does not depend on their order, and whether the window is verified."""
    values = [c for c in expected.columns if c not in keys]
    side = lambda df, n: df.select(*keys, F.floor(F.col(place) / size).alias(f"__w{n}"), F.sha2(F.to_json(F.struct(*[F.col(c).cast("string") for c in values]), {"ignoreNullFields": "false"}), 256).alias(f"__h{n}"))
    both = side(expected, 0).join(side(stored, 1), keys, "full_outer")
    here, there = F.col("__h0").isNotNull(), F.col("__h1").isNotNull()
    digest = F.sum(F.conv(F.substring("__h0", 1, 8), 16, 10).cast("long")).alias("digest")
    out = both.groupBy(F.coalesce("__w0", "__w1").alias("window")).agg(
        F.count_if(here).alias("expected"), F.count_if(there).alias("stored"), F.count_if(here & ~there).alias("missing"), F.count_if(there & ~here).alias("superfluous"), F.count_if(here & there & (F.col("__h0") != F.col("__h1"))).alias("changed"), digest,
    )
    return out.withColumn("verified", (F.col("missing") == 0) & (F.col("superfluous") == 0) & (F.col("changed") == 0))


def validate_pending(pending: DataFrame, answers: DataFrame, now: int, retry: int) -> DataFrame:
    """What becomes of pending entries (market, assets: candidate tokens, may be null) by the catalogue's answers (as
    catalog_identity() takes them): excluded, upserted, or still pending with an error and the time of the next try."""
    eligible, excluded, unresolved = registry.catalog_identity(answers)
    named = answers.select("id", F.col("conditionId").alias("market"))
    out = pending.join(eligible.select("market", F.col("assets").alias("__found")), "market", "left")
    out = out.join(excluded.join(named, "id").select("market", F.lit(True).alias("__out")).distinct(), "market", "left").join(unresolved.join(named, "id").groupBy("market").agg(F.min("reason").alias("__why")), "market", "left")
    differs = F.coalesce(F.size("assets") > 0, F.lit(False)) & (F.array_sort(F.array_distinct("assets")) != F.array_sort(F.array_distinct("__found")))
    error = F.when(F.col("__out"), F.lit(None)).when(F.col("__found").isNull(), F.coalesce("__why", F.lit("NO_ANSWER"))).when(differs, "NATIVE_GAMMA_TOKEN_MISMATCH")
    action = F.when(F.col("__out"), "EXCLUDE").when(error.isNull(), "UPSERT").otherwise("RETRY")
    return out.select("market", action.alias("action"), error.alias("error"), F.when(action == "RETRY", F.lit(now + retry)).alias("next_retry"))


def replaceable_shell(kind: Column, gamma_id: Column, category: Column, slug: Column) -> Column:
    """Whether a stored market may be replaced by one from the catalogue: structural, or a placeholder without its id."""
    low = lambda c: F.lower(F.coalesce(registry.collapsed(c), F.lit("")))
    return (low(kind) == "protocol_structural") | ((low(gamma_id) == "") & ((low(category) == "orderfilled-placeholder") | low(slug).startswith("trade-indexer-placeholder-")))


def strict_row(*needed: Column, tokens: tuple[Column, Column]) -> Column:
    """Whether a normalised row has all its ids and two different tokens."""
    full = F.lit(True)
    for c in (*needed, *tokens):
        full = full & registry.collapsed(c.cast("string")).isNotNull()
    return full & (tokens[0] != tokens[1])


#: How a promotion that is known already takes a new one.
PROMOTION_RULES = {"first_seen": "least", "last_seen": "greatest", "occurrences": "sum", "payload": "replace", "status": "keep"}


def merge_promotions(ledger: DataFrame, seen: DataFrame) -> DataFrame:
    """Ledger of promotions (condition_id, payload, first_seen, last_seen, occurrences, status) after a scan."""
    return tables.merge_table(ledger, seen, ["condition_id"], PROMOTION_RULES)
