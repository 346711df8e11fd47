"""Decoders of resolution events: topics and data words of whole log tables, by column expressions.

Logs have topic0..topic3, data (0x and words), address and the position columns. `names` says which event a topic0 is:
event signatures are hashes that the caller knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.functions import hexes
from augury.operators import tables


def dynamic_bytes(data: Column, index: int) -> Column:
    """Bytes (as hexadecimal digits) of the dynamic field whose offset is the index-th word; null if it lies outside."""
    at = (2 * hexes.small(hexes.word(data, index))).cast("int")
    length = (2 * hexes.small(F.substring(data, at + 1, F.lit(64)))).cast("int")
    return F.when(at + 64 + length <= F.length(data), F.substring(data, at + 65, length))


def dynamic_words(data: Column, index: int) -> Column:
    """Words of the dynamic array whose offset is the index-th word; null if it lies outside."""
    at = (2 * hexes.small(hexes.word(data, index))).cast("int")
    n = hexes.small(F.substring(data, at + 1, F.lit(64))).cast("int")
    words = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(data, at + 1 + 64 * i, F.lit(64)))
    return F.when(n == 0, F.array().cast("array<string>")).when(at + 64 + 64 * n <= F.length(data), words)


def signed(hex64: Column) -> Column:
    """Two's complement word as DECIMAL(38,0); null where it does not fit."""
    flipped = F.translate(hex64, "0123456789abcdef", "fedcba9876543210")
    return F.when(hex64.rlike("^[89a-f]"), -(hexes.unsigned(flipped) + 1)).otherwise(hexes.unsigned(hex64)).cast("decimal(38,0)")


def readable(hex_bytes: Column) -> Column:
    """Text of bytes; NUL shows as \\x00, so that the text can be stored anywhere."""
    return F.replace(F.decode(F.unhex(hex_bytes), "UTF-8"), F.lit("\u0000"), F.lit("\\x00"))


def _named(logs: DataFrame, names: dict[str, str]) -> DataFrame:
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return logs.withColumns({"event": F.try_element_at(label, F.col("topic0")), "__data": hexes.body(F.col("data"), 0)})


#: Events of the oracle contract, and for each the word that holds a price, if any.
REQUESTS = {"RequestPrice": ("request", None), "ProposePrice": ("propose", 3), "DisputePrice": ("dispute", 3), "Settle": ("settle", 3)}


def decode_oracle_requests(logs: DataFrame, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(lifecycle events, rejects): status, parties, ancillary bytes and text, signed price, payout."""
    rows = _named(logs, names)
    pick = lambda of: F.coalesce(*[F.when(F.col("event") == e, of(*v)) for e, v in REQUESTS.items()])
    rows = rows.withColumns({
        "status": pick(lambda s, _: F.lit(s)), "ancillary_hex": dynamic_bytes(F.col("__data"), 2),
        "price": F.when(F.col("event") != "RequestPrice", signed(hexes.word(F.col("__data"), 3))), "payout": F.when(F.col("event") == "Settle", hexes.unsigned(hexes.word(F.col("__data"), 4))),
    })
    reason = F.when(F.col("status").isNull(), "unknown event").when(F.col("ancillary_hex").isNull(), "ancillary data out of range").when((F.col("event") != "RequestPrice") & F.col("price").isNull(), "price is too wide")
    good, bad = tables.split(rows.withColumn("reason", reason))
    has = lambda n, *events: F.when(F.col("event").isin(*events), hexes.address(F.col(f"topic{n}")))
    out = good.select(
        "tx_hash", "log_index", "block_number", F.lower("address").alias("oracle"), "status", hexes.address(F.col("topic1")).alias("requester"),
        has(2, "ProposePrice", "DisputePrice", "Settle").alias("proposer"), has(3, "DisputePrice", "Settle").alias("disputer"),
        F.concat(F.lit("0x"), "ancillary_hex").alias("ancillary_hex"), readable(F.col("ancillary_hex")).alias("text"), "price", "payout",
    )
    return out, bad.select(*logs.columns, "reason")


def decode_ctf(logs: DataFrame, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(condition preparations and resolutions, rejects): status, condition, oracle, question, slots, payout numerators."""
    rows = _named(logs, names).withColumn("slots", hexes.small(hexes.word(F.col("__data"), 0)))
    rows = rows.withColumn("numerators", F.when(F.col("event") == "ConditionResolution", dynamic_words(F.col("__data"), 1)))
    reason = (
        F.when(~F.coalesce(F.col("event").isin("ConditionPreparation", "ConditionResolution"), F.lit(False)), "unknown event").when(F.col("slots").isNull(), "no slot count")
        .when((F.col("event") == "ConditionResolution") & F.col("numerators").isNull(), "payouts out of range").when(F.size("numerators") != F.col("slots"), "payouts do not match slots")
    )
    good, bad = tables.split(rows.withColumn("reason", reason))
    topic = lambda n: F.concat(F.lit("0x"), hexes.body(F.col(f"topic{n}")))
    out = good.select("tx_hash", "log_index", "block_number", F.when(F.col("event") == "ConditionPreparation", "request").otherwise("settle").alias("status"), topic(1).alias("condition_id"), hexes.address(F.col("topic2")).alias("oracle"), topic(3).alias("question_id"), "slots", "numerators")
    return out, bad.select(*logs.columns, "reason")


def decode_prepared(logs: DataFrame) -> DataFrame:
    """Mapping of requests to questions and markets."""
    topic = lambda n: F.concat(F.lit("0x"), hexes.body(F.col(f"topic{n}")))
    return logs.select(topic(3).alias("request_id"), topic(2).alias("question_id"), topic(1).alias("market_key"), F.lower("address").alias("operator"))


def decode_adapter_events(logs: DataFrame, names: dict[str, str], first_era: str) -> tuple[DataFrame, DataFrame]:
    """(adapter events, rejects) of both eras: initialisation with ancillary bytes, reset, resolution and settlement.
    The adapter of the first era names its settlement apart and marks emergency reports and early resolutions."""
    rows = _named(logs, names).withColumn("__old", F.lower("address") == first_era)
    event, old = F.col("event"), F.col("__old")
    label = (
        F.when(event == "QuestionInitialized", "initialized").when(event == "QuestionReset", "reset").when(event == "QuestionResolved", "resolved").when(old & (event == "QuestionSettled"), "settled")
    )
    price = F.when(((label == "settled") & old) | ((label == "resolved") & ~old), signed(hexes.body(F.col("topic2"))))
    rows = rows.withColumns({"status": label, "price": price, "ancillary_hex": F.when(label == "initialized", dynamic_bytes(F.col("__data"), 0))})
    flag = lambda n: hexes.body(F.col(f"topic{n}")) != hexes.ZERO
    rows = rows.withColumns({"emergency": F.when(old & (F.col("status") == "resolved"), flag(2)), "early": F.when(F.col("status") == "settled", flag(3))})
    reason = F.when(F.col("status").isNull(), "unknown event").when((F.col("status") == "initialized") & F.col("ancillary_hex").isNull(), "ancillary data out of range")
    good, bad = tables.split(rows.withColumn("reason", reason))
    payload = F.to_json(F.struct("status", "price", "emergency", "early"))
    out = good.select("tx_hash", "log_index", "block_number", F.lower("address").alias("adapter"), "status", F.concat(F.lit("0x"), hexes.body(F.col("topic1"))).alias("question_id"), "price", "emergency", "early", "ancillary_hex", payload.alias("payload"))
    return out, bad.select(*logs.columns, "reason")


#: Events of modules: whether they carry two results, and from which words or array they come.
_RESULTS = {"ConditionResolved": 0, "ResultReported": 0}


def decode_module_events(logs: DataFrame, names: dict[str, str], modules: dict[str, int], combo_module: str, unit: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(module events, rejects): the event must belong to its module, the condition's first byte must be the module's
    id, results must be two that sum to a unit."""
    rows = _named(logs, names).withColumn("module", F.lower("address"))
    ids = F.create_map(*[F.lit(x) for pair in modules.items() for x in pair])
    event = F.col("event")
    place = F.when(event == "ResultReported", F.col("topic2")).when(event.isin("ConditionResolved", "CombinatorialConditionPrepared", "MigrationConditionRegistered", "MigrationResolved"), F.col("topic1"))
    data = F.col("__data")
    results = F.when(event.isin(*_RESULTS), dynamic_words(data, 0)).when(event == "MigrationResolved", F.array(hexes.word(data, 2), hexes.word(data, 3)))
    rows = rows.withColumns({"module_id": F.try_element_at(ids, F.col("module")), "condition": F.when(place.isNotNull(), F.substring(hexes.body(place), 1, 62)), "results": results, "legs": F.when(event == "CombinatorialConditionPrepared", dynamic_words(data, 0))})
    rows = rows.withColumn("payouts", F.transform("results", hexes.unsigned))
    combo = F.col("module") == combo_module
    resolved = event.isin(*_RESULTS, "MigrationResolved")
    sum_ = F.aggregate("payouts", F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))
    reason = (
        F.when(event.isNull() | F.col("module_id").isNull(), "unknown event or module")
        .when((combo & ~event.isin("CombinatorialConditionPrepared", "Upgraded")) | (~combo & (event == "CombinatorialConditionPrepared")), "event is not of this module")
        .when(place.isNotNull() & (F.conv(F.substring("condition", 1, 2), 16, 10).cast("int") != F.col("module_id")), "condition of another module")
        .when(resolved & F.coalesce((F.size("payouts") != 2) | (sum_ != unit) | sum_.isNull(), F.lit(True)), "results do not sum to a unit")
    )
    good, bad = tables.split(rows.withColumn("reason", reason))
    condition = F.when(F.col("condition") != "", F.concat(F.lit("0x"), "condition"))
    return good.select("tx_hash", "log_index", "block_number", "module", "event", condition.alias("condition_id"), F.transform("payouts", lambda x: x.cast("string")).alias("payouts"), "legs"), bad.select(*logs.columns, "reason")


def enrich_requests(requests: DataFrame, questions: DataFrame, translations: DataFrame, translated: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(requests with adapter and question, conflicts): the ancillary bytes name the question, if one question has
    them; for some adapters the question is translated once more. Keys are hashed for the join and compared whole."""
    by_hash = questions.withColumn("__h", F.sha2("ancillary_hex", 256))
    unique = by_hash.groupBy("__h").agg(F.count_distinct("question_id").alias("__n"), F.min("question_id").alias("question_id"), F.min("adapter").alias("adapter"), F.min("ancillary_hex").alias("__a"))
    joined = requests.withColumn("__h", F.sha2("ancillary_hex", 256)).join(unique, "__h", "left")
    same = F.col("__a") == F.col("ancillary_hex")
    conflict = joined.where(same & (F.col("__n") > 1)).select(*requests.columns)
    found = joined.where(~F.coalesce(same & (F.col("__n") > 1), F.lit(False))).join(translations.select(F.col("request_id").alias("question_id"), F.col("question_id").alias("__to")), "question_id", "left")
    final = F.when(F.col("adapter").isin(*translated), F.coalesce("__to", "question_id")).otherwise(F.col("question_id"))
    return found.select(*requests.columns, "adapter", final.alias("question_id")), conflict


def reconcile_orphans(events: DataFrame, markets: DataFrame) -> DataFrame:
    """Events with a market where theirs was missing: by condition, or by question, if each names one market and they do
    not disagree. Events have market_id, condition_id, question_id."""
    for key in ("condition_id", "question_id"):
        unique = markets.where(F.col(key).isNotNull()).groupBy(F.lower(key).alias(f"__{key}")).agg(F.count("*").alias("__n"), F.min("market_id").alias(f"__by_{key}")).where("__n = 1").drop("__n")
        events = events.join(unique, F.lower(key) == F.col(f"__{key}"), "left").drop(f"__{key}")
    a, b = F.col("__by_condition_id"), F.col("__by_question_id")
    agreed = F.when(a.isNull() | b.isNull() | (a == b), F.coalesce(a, b))
    return events.withColumn("market_id", F.coalesce("market_id", agreed)).drop("__by_condition_id", "__by_question_id")
