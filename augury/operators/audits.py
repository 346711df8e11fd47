"""Frames, delivery and tape audits, gates, rollups of operations tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from augury.operators import tables

LEVEL = "array<struct<price: string, size: string>>"
FRAME = f"event_type string, market string, asset_id string, bids {LEVEL}, asks {LEVEL}, price_changes array<struct<asset_id: string, price: string, size: string, side: string>>, timestamp string"


def explode_frames(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages with their place in the frame, rejected frames) from rows (pos, raw): a frame is one JSON object or an
    array of them; a frame with anything else in it is rejected whole; PING, PONG and blank frames are ignored."""
    text = F.trim("raw")
    rows = raw.where(~F.upper(F.coalesce(text, F.lit(""))).isin("", "PING", "PONG"))
    array = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    rows = rows.select("*", F.from_json(array, ArrayType(StructType.fromDDL(FRAME))).alias("__m"))
    bad = F.col("__m").isNull() | F.exists("__m", lambda x: x.isNull() | x["event_type"].isNull())
    good, rejected = tables.split(rows.withColumn("reason", F.when(bad, "not a frame")))
    out = good.select(*raw.columns, F.posexplode("__m").alias("message_index", "m")).drop("raw")
    return out.select(*[c for c in raw.columns if c != "raw"], "message_index", "m.*"), rejected.select(*raw.columns, "reason")


def canonical_decimal(text: Column) -> Column:
    """A plain non-negative decimal without trailing zeros; null if it is none."""
    plain = text.rlike(r"^[0-9]{1,128}(\.[0-9]{1,128})?$")
    cut = F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(plain, F.regexp_replace(cut, r"^0+(?=[0-9])", ""))


def verify_delivery(received: DataFrame, stored: DataFrame, keys: list[str], content: str) -> DataFrame:
    """One row per received key: EQUAL, DIFFERENT or MISSING in what was stored."""
    s = stored.select(*keys, F.sha2(F.col(content).cast("binary"), 256).alias("__s")).distinct()
    joined = received.select(*keys, F.sha2(F.col(content).cast("binary"), 256).alias("__r")).join(s, keys, "left")
    status = F.when(F.col("__s").isNull(), "MISSING").when(F.col("__s") == F.col("__r"), "EQUAL").otherwise("DIFFERENT")
    return joined.select(*keys, status.alias("status"))


def audit_tape(tape: DataFrame, assets: DataFrame) -> DataFrame:
    """Violations of a tape (market, pos, kind, market_seq, book_epoch, asset): numbers that do not follow, records that
    leave their reset's epoch, records before any reset, and assets outside the market's scope."""
    w = tables.Window.partitionBy("market").orderBy("pos")
    epoch = F.last(F.when(F.col("kind") == "RESET", F.col("book_epoch")), ignorenulls=True).over(w)
    rows = tape.withColumns({"__seq": F.lag("market_seq").over(w), "__epoch": epoch})
    scope = assets.select(F.col("market").alias("m"), F.col("asset").alias("a"), F.lit(True).alias("__known"))
    rows = rows.join(scope, (F.col("market") == F.col("m")) & (F.col("asset") == F.col("a")), "left")
    why = tables.reasons(
        (F.col("__seq").isNull() | (F.col("market_seq") == F.col("__seq") + 1), "SEQUENCE"), (F.col("__epoch").isNotNull(), "BEFORE_RESET"),
        (F.col("__epoch").isNull() | (F.col("book_epoch") == F.col("__epoch")), "EPOCH"), (F.col("__known").isNotNull(), "UNKNOWN_ASSET"),
    )
    return rows.withColumn("reasons", why).where(F.size("reasons") > 0).select("market", "pos", F.array_join("reasons", ",").alias("reasons"))


def cut_reasons(producer: Column, revision: Column, times: list[Column], start: int, end: int, wanted_revision: int) -> Column:
    """Why a node's cut is not valid: producer, revision, time window, and an order of clocks that must not fall."""
    ordered = [(a <= b, f"CLOCK_{i}") for i, (a, b) in enumerate(zip(times, times[1:]))]
    return tables.reasons((producer.isNotNull(), "PRODUCER"), (revision == wanted_revision, "REVISION"), (times[0].between(start, end), "WINDOW"), *ordered)


def gates(checks: DataFrame) -> DataFrame:
    """One row from a table (gate, bad): each gate passes if nothing is bad; all must."""
    out = checks.groupBy("gate").agg(F.sum("bad").cast("long").alias("bad"))
    return out.select("gate", "bad", (F.col("bad") == 0).alias("passed")).unionByName(out.agg(F.lit("ALL").alias("gate"), F.sum("bad").cast("long").alias("bad"), F.min(F.col("bad") == 0).alias("passed")))


def stage_durations(trace: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per record and named stage with both ends: id, stage, took."""
    each = F.array(*[F.struct(F.lit(name).alias("stage"), (F.col(b) - F.col(a)).alias("took")) for name, (a, b) in pairs.items()])
    return trace.select("id", F.explode(each).alias("s")).select("id", "s.stage", "s.took").where("took is not null")


def queue_inventory(committed: DataFrame, done: DataFrame, key: str, parts: int) -> DataFrame:
    """What is committed and not done, dealt by hash of the key: rows, bytes and oldest time of each part."""
    pending = committed.join(done.select(key), key, "left_anti")
    part = F.pmod(F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(parts))
    return pending.groupBy(part.alias("part")).agg(F.count("*").alias("pending"), F.sum("bytes").cast("long").alias("bytes"), F.min("at").alias("oldest"))


def incremental_scan(rows: DataFrame, watermark: int, overlap: int, complete: bool) -> tuple[DataFrame, DataFrame]:
    """(rows created or updated since the watermark less the overlap, next watermark): it moves only after a complete
    scan in which every row had a time."""
    seen = F.greatest("created", "updated")
    selected = rows.where(seen.isNull() | (seen >= watermark - overlap))
    known = F.min(seen.isNotNull())
    state = rows.agg(F.when(F.lit(complete) & F.coalesce(known, F.lit(False)), F.greatest(F.max(seen), F.lit(watermark))).otherwise(F.lit(watermark)).alias("watermark"))
    return selected, state


def authorized(events: DataFrame, allowed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events whose requester may use their oracle, others)."""
    keys = ["oracle", "requester"]
    return events.join(allowed.select(*keys).distinct(), keys, "left_semi"), events.join(allowed.select(*keys).distinct(), keys, "left_anti")


def revalidation(eligible: DataFrame, census: DataFrame, cursor: int) -> DataFrame:
    """Eligible ids above the cursor that the last census did not have."""
    return eligible.where(F.col("id") > cursor).join(census.select("id").distinct(), "id", "left_anti")


def ancillary_fields(text: Column) -> dict[str, Column]:
    """Fields of an ancillary text: market id, title (up to the description), p1 and p2; null where absent."""
    pick = lambda pattern: F.nullif(F.trim(F.regexp_extract(text, pattern, 1)), F.lit(""))
    return {
        "market_id": pick(r"(?i)market_id:\s*([0-9]+)"), "title": pick(r"(?is)q:\s*title:\s*(.*?),\s*description:"),
        "p1": pick(r"(?i)\bp1:\s*([0-9.]+)"), "p2": pick(r"(?i)\bp2:\s*([0-9.]+)"),
    }


def price_text(units: Column) -> Column:
    """A number of 1e-18 units as plain decimal text."""
    whole = units.cast("decimal(38,0)")
    digits = F.lpad(F.abs(whole).cast("string"), 19, "0")
    digits = F.when(F.length(F.abs(whole).cast("string")) > 19, F.abs(whole).cast("string")).otherwise(digits)
    plain = F.regexp_replace(F.regexp_replace(digits, r"^(.*)(.{18})$", "$1.$2"), r"\.?0+$", "")
    plain = F.when(plain == "", "0").otherwise(plain)
    return F.concat(F.when(whole < 0, "-").otherwise(""), plain)


def decode_position(position: Column) -> dict[str, Column]:
    """Parts of a combination position (64 hex digits): module (first byte), outcome bit, sibling; null if invalid."""
    good = position.rlike("^03[0-9a-f]{60}0[01]$")
    head = F.substring(position, 1, 62)
    last = F.substring(position, 63, 2)
    return {
        "valid": good, "condition": F.when(good, F.concat(F.lit("0x"), head)), "outcome": F.when(good, F.when(last == "01", 1).otherwise(0)),
        "sibling": F.when(good, F.concat(head, F.when(last == "01", "00").otherwise("01"))),
    }


def valid_legs(legs: Column) -> Column:
    """Whether leg positions (array of 64 hex digits) are 1 to 50, of modules 1 and 2, with outcome bits 0 and 1, strictly
    ascending, and of different conditions."""
    one = lambda x: F.coalesce(x.rlike("^0[12][0-9a-f]{60}0[01]$"), F.lit(False))
    conditions = F.transform(legs, lambda x: F.substring(x, 1, 62))
    rising = F.forall(F.sequence(F.lit(1), F.size(legs)), lambda i: (i == 1) | (F.get(legs, i - 2) < F.get(legs, i - 1)))
    return F.coalesce(F.size(legs).between(1, 50) & F.forall(legs, one) & (F.size(F.array_distinct(conditions)) == F.size(legs)) & F.when(F.size(legs) > 0, rising).otherwise(False), F.lit(False))


def stream_digests(frames: DataFrame, fan: int = 1024, depth: int = 3) -> DataFrame:
    """Digest of each stream's frames (stream, offset, frame) in their order, with first and last offset and their number.

    A tree over ranges of offsets: a node's digest is that of its children's with their numbers, so that two frames that
    change places change it, while no task reads more than `fan` entries of one stream at once. Repeated equal frames
    count once, different ones of an offset are both in it. Offsets must lie below fan ** depth.
    """
    digest = F.sha2(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", F.lpad(F.col("at").cast("string"), 20, "0"), "d"))), ","), 256)
    low, high, count = F.min("first").alias("first"), F.max("last").alias("last"), F.sum("frames").alias("frames")
    nodes = frames.select("stream", F.col("offset").alias("at"), F.sha2(F.col("frame").cast("binary"), 256).alias("d")).distinct()
    nodes = nodes.select("stream", "at", "d", F.col("at").alias("first"), F.col("at").alias("last"), F.lit(1).cast("long").alias("frames"))
    for _ in range(depth):
        nodes = nodes.groupBy("stream", F.floor(F.col("at") / fan).alias("up")).agg(digest.alias("d"), low, high, count).withColumnRenamed("up", "at")
    return nodes.groupBy("stream").agg(digest.alias("digest"), low, high, count).select("stream", "first", "last", "frames", "digest")
