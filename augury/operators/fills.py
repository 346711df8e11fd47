"""Trade fills: scan and decode event logs, join them to token owners, keep what cannot be resolved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.functions import hexes
from augury.operators import tables
from augury.sources.shared import written
from augury.sources import fixtures

LEGACY, CURRENT = "legacy", "v2026"
#: Blocks below the head that are not yet final.
CONFIRMATIONS = 20
#: Outcome of the exchange whose fills have none: its address is the last of the current layout's.
COMBO_EXCHANGE = fixtures.CURRENT[-1]
EXCLUDED_KINDS = ("legacy_placeholder", "legacy_ghost", "invalid_shell")
EXCLUDED_CATEGORIES = ("orderfilled-placeholder", "ghost", "[ghost]", "invalid-identity-shell")


def plan_windows(spark, cursor: int, through: int, size: int) -> DataFrame:
    """Block windows (from_block, to_block) after the cursor up to and with `through`."""
    ids = spark.range(cursor + 1, through + 1, size)
    return ids.select(F.col("id").alias("from_block"), F.least(F.col("id") + size - 1, F.lit(through)).alias("to_block"))


def advance(cursors: DataFrame, seen: DataFrame) -> DataFrame:
    """Control table (key, last_block) that never goes back."""
    return tables.merge_table(cursors, seen, ["key"], {"last_block": "greatest"})


def safe_rows(df: DataFrame, confirmations: int = CONFIRMATIONS) -> DataFrame:
    """Rows at least so many blocks below the newest one."""
    head = df.agg(F.max("block_number").alias("__head"))
    return df.crossJoin(F.broadcast(head)).where(F.col("block_number") <= F.col("__head") - confirmations).drop("__head")


def scan_logs(logs: DataFrame, from_block: int, to_block: int, starts: dict[str, int], topics: list[str]) -> DataFrame:
    """Logs of a block window from known contracts, each only from its first block, in canonical order."""
    active = [(F.col("address") == a) & (F.col("block_number") >= b) for a, b in starts.items()]
    known = active[0]
    for one in active[1:]:
        known = known | one
    return logs.where(F.col("block_number").between(from_block, to_block) & F.col("topic0").isin(topics) & known).orderBy("block_number", "log_index", "tx_hash")


def attach_block_time(df: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with block_time, rows without): a block with more than one hash or time, or none, gives its rows no time."""
    known = blocks.groupBy("block_number").agg(F.min("block_time").alias("block_time"), F.max("block_time").alias("__t"), F.min("block_hash").alias("__a"), F.max("block_hash").alias("__b"))
    known = known.withColumn("__ok", (F.col("block_time") == F.col("__t")) & F.col("__a").eqNullSafe(F.col("__b")))
    joined = df.join(known, "block_number", "left")
    reason = F.when(F.col("__ok").isNull(), "block without time").when(~F.col("__ok"), "conflicting block")
    joined = joined.withColumn("reason", reason).drop("__t", "__a", "__b", "__ok")
    return tables.split(joined)


def _decoded(logs: DataFrame) -> DataFrame:
    """Logs with decoded columns and the first reason against them; each step is a projection, so that no expression
    is repeated in another."""
    rows = logs.withColumns({"contract": F.concat(F.lit("0x"), hexes.body(F.col("address"), 40)), "__data": hexes.body(F.col("data"), 0)})
    contract, topic = F.col("contract"), F.col("topic0")
    version = F.when((topic == fixtures.LEGACY_TOPIC) & contract.isin(*fixtures.LEGACY), LEGACY).when((topic == fixtures.CURRENT_TOPIC) & contract.isin(*fixtures.CURRENT), CURRENT)
    rows = rows.withColumns({"event_version": version, **{f"__w{i}": hexes.word(F.col("__data"), i) for i in range(5)}})
    w = [F.col(f"__w{i}") for i in range(5)]
    old, zero = F.col("event_version") == LEGACY, F.lit(hexes.ZERO)
    buy = F.when(old, (w[0] == zero) & (w[1] != zero)).otherwise(w[0] == zero)
    sell = F.when(old, (w[1] == zero) & (w[0] != zero)).otherwise(w[0] == F.lit("0" * 63 + "1"))
    amounts = {name: hexes.unsigned(w[i]) for i, name in ((2, "maker_amount"), (3, "taker_amount"), (4, "fee"))}
    rows = rows.withColumns({"side": F.when(buy, "BUY").when(sell, "SELL"), **amounts})
    bought = F.col("side") == "BUY"
    rows = rows.withColumns({
        "token_id": F.when(old & ~bought, w[0]).otherwise(w[1]),
        "__usdc": F.when(bought, F.col("maker_amount")).otherwise(F.col("taker_amount")),
        "__token": F.when(bought, F.col("taker_amount")).otherwise(F.col("maker_amount")),
    })
    length = F.length("__data")
    reason = (
        F.when(F.col("n_topics") != 4, "four topics required")
        .when(F.col("event_version").isNull(), "unknown topic and address")
        .when((length % 64 != 0) | ~hexes.digits(F.col("__data")), "data is not words")
        .when(length != 64 * F.when(old, 5).otherwise(7), "wrong number of words")
        .when(F.col("side").isNull() | (F.col("token_id") == zero), "invalid side or asset")
        .when(F.col("maker_amount").isNull() | F.col("taker_amount").isNull() | F.col("fee").isNull(), "amount is too wide")
        .when(F.col("__token") <= 0, "token amount must be positive")
    )
    return rows.withColumn("reason", reason)


def with_ratio(df: DataFrame, name: str, a: str, b: str) -> DataFrame:
    """Adds a / b with ten digits, rounded down, for whole numbers DECIMAL(38,0); null where the rest does not fit."""
    x, y, ten = F.col(a), F.col(b), F.lit(10**10).cast("decimal(11,0)")

    def long_way(x: Column, y: Column) -> Column:
        # The remainder is exact, so dividing what is left of it leaves no rounding.
        whole = ((x - x % y) / y).cast("decimal(38,0)")
        wide = F.try_multiply(x % y, ten).cast("decimal(38,0)")
        digits = ((wide - wide % y) / y).cast("decimal(20,0)")
        return (whole.cast("decimal(20,10)") + (digits / ten).cast("decimal(20,10)")).cast("decimal(20,10)")

    # Short numbers, which most are: five digits at a time in 63 bits.
    m, n, half = x.cast("bigint"), y.cast("bigint"), F.lit(10**5).cast("bigint")
    quotient = lambda p, q: F.call_function("div", p, q)
    first = (m % n) * half
    short = quotient(m, n) * half * half + quotient(first, n) * half + quotient(first % n * half, n)
    fits = x.between(0, 9 * 10**17) & y.between(1, 9 * 10**12) & (x < y * F.lit(9 * 10**7))
    return df.withColumn(name, F.when(fits, (short.cast("decimal(20,0)") / ten).cast("decimal(20,10)")).otherwise(hexes.rarely(long_way, x, y)))


def decode_fills(logs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fills, rejected logs with the first reason) from both event layouts."""
    good, bad = tables.split(_decoded(logs))
    good = with_ratio(good, "price", "__usdc", "__token")
    fills = good.select(
        "contract", "event_version", hexes.body(F.col("tx_hash")).alias("tx_hash"), "log_index", "block_number", hexes.body(F.col("topic1")).alias("order_hash"),
        hexes.address(F.col("topic2")).alias("maker"), hexes.address(F.col("topic3")).alias("taker"), "token_id", "side",
        "price", (F.col("__token") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(30,10)").alias("size"),
        "maker_amount", "taker_amount", "fee",
    )
    return fills, bad.select(*logs.columns, "reason")


def canonical_owner() -> Column:
    """Whether a token row joined to its market (m_*) may own fills."""
    lower = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    return (
        F.col("active") & (F.col("market_id") > 0) & (lower("condition_id") != "") & (lower("condition_id") == lower("m_condition_id"))
        & ~F.col("m_identity_kind").isin(*EXCLUDED_KINDS) & ~lower("m_category").isin(*EXCLUDED_CATEGORIES)
        & ~lower("m_slug").startswith("trade-indexer-placeholder-") & ~lower("m_slug").startswith("ghost-market-") & (lower("condition_id") != "0x" + hexes.ZERO)
    )


def owners(markets: DataFrame, tokens: DataFrame) -> DataFrame:
    """Token owners: tokens of canonical markets."""
    m = markets.select(F.col("market_id").alias("m_id"), *[F.col(c).alias(f"m_{c}") for c in ("condition_id", "identity_kind", "category", "slug")])
    found = tokens.join(m, F.col("market_id") == F.col("m_id")).where(canonical_owner())
    return found.select("token_id", "market_id", "condition_id", "outcome", "outcome_index", F.col("m_identity_kind").alias("identity_kind"))


def resolve_fills(fills: DataFrame, owned: DataFrame) -> DataFrame:
    """Fills with their owners and whether these resolve them: an owner with another outcome index than 0 or 1 does not."""
    o = owned.select("token_id", "market_id", "condition_id", "outcome_index", "identity_kind")
    return fills.join(o, "token_id", "left").withColumn("resolved", F.coalesce(F.col("outcome_index").isin(0, 1), F.lit(False)))


def resolved_facts(joined: DataFrame) -> DataFrame:
    """Facts from resolve_fills()."""
    combo = (F.col("contract") == COMBO_EXCHANGE) | (F.col("identity_kind") == "official_combo")
    return joined.where("resolved").select(
        "tx_hash", "log_index", "market_id", "condition_id", "token_id", F.when(combo, 0).otherwise(F.col("outcome_index") + 1).alias("outcome_code"),
        "maker", "taker", F.when(F.col("side") == "BUY", 1).otherwise(2).alias("side_code"), "price", "size", "block_number", "order_hash", "contract",
        "maker_amount", "taker_amount", "fee",
    )


def project_fills(fills: DataFrame, owned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts, unresolved fills)."""
    joined = resolve_fills(fills, owned)
    return resolved_facts(joined), joined.where("not resolved").select(*fills.columns)


def append_new(existing: DataFrame, facts: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(facts to append, rejected ones): keys that exist are skipped, keys that repeat within the batch are errors."""
    copies = facts.groupBy(*key).agg(F.count("*").alias("__n"))
    marked = facts.join(copies, key)
    fresh = marked.where("__n = 1").drop("__n").join(existing.select(*key), key, "left_anti")
    return fresh, marked.where("__n > 1").withColumn("reason", F.lit("duplicate key in batch")).drop("__n")


def write_facts(facts: DataFrame, path: str, blocks: int = 1_000_000) -> None:
    """Fact table: partitioned by block range, sorted for market and token reads, with bloom filters for point reads."""
    out = written(facts.withColumn("block_bucket", F.floor(F.col("block_number") / blocks)), "facts")  # ranges are sampled first
    writer = out.repartitionByRange("block_bucket", "market_id").sortWithinPartitions("market_id", "token_id", "block_number", "log_index", "tx_hash").write
    for c in ("tx_hash", "maker", "taker"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.mode("append").partitionBy("block_bucket").parquet(path)


def append_once(facts: DataFrame, path: str, batch: int, key: list[str], blocks: int = 1_000_000) -> DataFrame:
    """Append a batch's facts that no earlier batch has, in folders by block range and batch; returns its line of the ledger
    (batch, projected, appended, known, repeated).

    Only the block ranges that the batch touches are read, of lower batch numbers: a batch that runs again finds what it
    found before and replaces what it wrote. Keys that repeat within the batch are left out and counted. facts is read
    several times and should be a written table.
    """
    spark = facts.sparkSession
    rows = facts.withColumn("block_bucket", F.floor(F.col("block_number") / blocks))
    copies = rows.groupBy("block_bucket", *key).agg(F.count("*").alias("__n"))
    single = rows.join(copies.where("__n = 1").drop("__n"), ["block_bucket", *key], "left_semi")
    touched = [r[0] for r in rows.select("block_bucket").distinct().collect()]  # block ranges of one batch
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields], "batch int"])
    spark.createDataFrame([], schema).drop("block_bucket", "batch").write.mode("ignore").parquet(f"{path}/block_bucket=-1/batch=-1")
    known = spark.read.schema(schema).parquet(path).where(F.col("block_bucket").isin(touched) & (F.col("batch") < batch) & (F.col("batch") >= 0))
    fresh = single.join(known.select("block_bucket", *key), ["block_bucket", *key], "left_anti").withColumn("batch", F.lit(batch))
    fresh.repartition("block_bucket", "market_id").sortWithinPartitions("block_bucket", "market_id", "token_id", "block_number", "log_index").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("block_bucket", "batch").parquet(path)
    own = spark.read.schema(schema).parquet(path).where(F.col("block_bucket").isin(touched) & (F.col("batch") == batch)).agg(F.count("*").alias("appended"))
    counts = copies.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("projected"), F.count_if(F.col("__n") == 1).alias("single"))
    return counts.crossJoin(own).select(F.lit(batch).alias("batch"), "projected", "appended", (F.col("single") - F.col("appended")).alias("known"), (F.col("projected") - F.col("single")).alias("repeated"))


def rollup_gaps(unresolved: DataFrame) -> DataFrame:
    """Unresolved fills by token: first and last place seen, and how often."""
    place = F.struct("block_number", "log_index", "tx_hash")
    out = unresolved.groupBy("token_id").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count("*").alias("seen_count"))
    return out.select(
        "token_id", F.lit("open").alias("status"), F.col("a.block_number").alias("first_seen_block"), F.col("b.block_number").alias("last_seen_block"),
        F.col("a.tx_hash").alias("first_tx_hash"), F.col("b.tx_hash").alias("last_tx_hash"), F.col("a.log_index").alias("first_log_index"), F.col("b.log_index").alias("last_log_index"), "seen_count",
    )


GAP_RULES = {
    "status": "replace", "first_seen_block": "least", "last_seen_block": "greatest", "first_tx_hash": "keep", "last_tx_hash": "replace",
    "first_log_index": "keep", "last_log_index": "replace", "seen_count": "greatest",
}


def merge_gaps(gaps: DataFrame, delta: DataFrame) -> DataFrame:
    return tables.merge_table(gaps, delta, ["token_id"], GAP_RULES)


def replayable_gaps(gaps: DataFrame, owned: DataFrame, limit: int | None = None) -> DataFrame:
    """Open gaps whose token has an owner now, oldest first; a limit bounds one batch of the work."""
    found = gaps.where("status = 'open'").join(owned.select("token_id"), "token_id", "left_semi").orderBy("first_seen_block", "token_id")
    return found.limit(limit) if limit else found


def replay_gaps(gaps: DataFrame, fills: DataFrame, owned: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(facts, gaps): the whole history of newly owned tokens is projected; a gap closes if no fill of it stays open."""
    ready = replayable_gaps(gaps, owned, limit)
    history = fills.join(ready.select("token_id"), "token_id", "left_semi")
    facts, still = project_fills(history, owned)
    closed = ready.select("token_id").join(still.select("token_id").distinct(), "token_id", "left_anti").withColumn("__closed", F.lit(True))
    out = gaps.join(closed, "token_id", "left").withColumn("status", F.when(F.col("__closed"), "resolved").otherwise(F.col("status"))).drop("__closed")
    return facts, out
