"""Audit of captured frames by a second book builder, which shares nothing with the first but the rules.

Records of a capture: pos (order), kind (CONNECT, DISCONNECT, SOURCE_ASSIGNED, SOURCE_STATE_RELEASED, RAW), shard, lane,
connection, market (of assignments and releases) and raw (text of a frame). A source is a market on a shard and lane. A frame counts if
its connection is the last one that its shard and lane connected. A connection, an assignment or a release empties books;
a disconnection makes them not ready until their next snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LEVELS = "array<struct<price: string, size: string>>"
_MESSAGE = f"struct<event_type: string, market: string, asset_id: string, bids: {_LEVELS}, asks: {_LEVELS}, price_changes: array<struct<asset_id: string, side: string, price: string, size: string>>>"
SLOT, SOURCE = ["shard", "lane"], ["market", "shard", "lane"]


def plain(number: Column) -> Column:
    """A decimal as text without needless zeros."""
    return F.regexp_replace(F.regexp_replace(number.cast("decimal(28,10)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def live_records(records: DataFrame) -> DataFrame:
    """Records with `live`: whether their connection is the one that their shard and lane connected last."""
    w = Window.partitionBy(*SLOT).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("kind") == "CONNECT", F.col("connection")), ignorenulls=True).over(w)
    return records.withColumn("live", F.coalesce(last == F.col("connection"), F.lit(False)))


def messages(live: DataFrame, scope: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages of live frames in scope, frames by what became of them). scope: market, asset.

    Messages: pos, idx, the source, kind (book or price_change) and rows (asset, side, price, size). A frame is read up to its
    first message that cannot be interpreted; keepalives, and messages of other markets or kinds, are passed over.
    """
    text = F.trim("raw")
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    frames = live.where("kind = 'RAW' and live and raw <> 'PONG'").select("pos", *SLOT, F.from_json(listed, f"array<{_MESSAGE}>", {"mode": "PERMISSIVE"}).alias("m"))
    assets = scope.groupBy("market").agg(F.collect_set("asset").alias("assets"))
    each = frames.select("pos", *SLOT, F.col("m").isNull().alias("broken"), F.posexplode_outer("m").alias("idx", "m")).select("pos", *SLOT, "broken", "idx", "m", F.col("m.market").alias("market"))
    each = each.join(assets, "market", "left")
    side = lambda name, label: F.transform(F.coalesce(F.col(f"m.{name}"), F.array().cast(_LEVELS)), lambda x: F.struct(F.col("m.asset_id").alias("asset"), F.lit(label).alias("side"), x["price"].cast("decimal(28,10)").alias("price"), x["size"].cast("decimal(28,10)").alias("size")))
    changes = F.transform("m.price_changes", lambda x: F.struct(x["asset_id"].alias("asset"), x["side"].alias("side"), x["price"].cast("decimal(28,10)").alias("price"), x["size"].cast("decimal(28,10)").alias("size")))
    book, change = F.col("m.event_type") == "book", F.col("m.event_type") == "price_change"
    rows = F.when(book, F.concat(side("bids", "BUY"), side("asks", "SELL"))).when(change, changes)
    known = lambda a: F.coalesce(F.array_contains("assets", a), F.lit(False))
    each = each.withColumn("rows", rows)
    odd = F.exists("rows", lambda r: r["price"].isNull() | r["size"].isNull() | r["asset"].isNull() | ~known(r["asset"]))
    missing = F.when(book, F.col("m.bids").isNull() | F.col("m.asks").isNull() | F.col("m.asset_id").isNull() | ~known(F.col("m.asset_id"))).when(change, F.col("rows").isNull()).otherwise(F.col("m.event_type").isNull())
    each = each.withColumn("bad", F.col("broken") | (F.col("assets").isNotNull() & F.coalesce(missing | F.coalesce(odd, F.lit(False)), F.lit(False))))
    first = F.min(F.when(F.col("bad"), F.coalesce("idx", F.lit(0)))).over(Window.partitionBy("pos"))
    each = each.withColumn("stop", first)
    good = each.where("assets is not null and idx is not null and (stop is null or idx < stop)").where(book | change)
    good = good.select("pos", "idx", *SOURCE, F.col("m.event_type").alias("kind"), F.col("m.asset_id").alias("asset"), "rows")
    fate = each.groupBy("pos", *SLOT).agg(F.max("stop").alias("stop"))
    return good, fate.select("pos", *SLOT, F.when(F.col("stop").isNotNull(), "UNINTERPRETED").otherwise("INTERPRETED").alias("fate"))


def _barriers(live: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, pos, empties) of what ends the readiness of a source's books."""
    slots = live.where("kind = 'CONNECT' or (kind = 'DISCONNECT' and live)").select(*SLOT, "pos")
    own = live.where("kind = 'SOURCE_STATE_RELEASED' or (kind = 'SOURCE_ASSIGNED' and live)").select(*SOURCE, "pos")
    return sources.join(slots, SLOT).select(*SOURCE, "pos").unionByName(own)


def rebuilt(records: DataFrame, scope: DataFrame, cutoff: int) -> tuple[DataFrame, DataFrame]:
    """(books, counts) from the records up to the cutoff. books: source, asset, side, price, size of books that are ready.
    counts: by source snapshots, groups and groups that came before their books' snapshots."""
    live = live_records(records.where(F.col("pos") <= cutoff))
    found = messages(live, scope)[0]
    found = found.withColumn("at", F.struct("pos", "idx"))
    sources = found.select(*SOURCE).distinct()
    shots = found.where("kind = 'book'").select(*SOURCE, "asset", "at", F.lit(True).alias("shot"))
    touched = found.where("kind = 'price_change'").select(*SOURCE, "at", F.explode(F.array_distinct(F.transform("rows", lambda r: r["asset"]))).alias("asset"), F.lit(False).alias("shot"))
    ends = _barriers(live, sources).join(scope, "market").select(*SOURCE, "asset", F.struct("pos", F.lit(-1).alias("idx")).alias("at"), F.lit(None).cast("boolean").alias("shot"))
    w = Window.partitionBy(*SOURCE, "asset").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    walked = shots.unionByName(touched).unionByName(ends)
    walked = walked.withColumn("shot_at", F.max(F.when(F.col("shot"), F.col("at"))).over(w)).withColumn("end_at", F.max(F.when(F.col("shot").isNull(), F.col("at"))).over(w))
    walked = walked.withColumn("ready", F.coalesce(F.col("shot_at") > F.coalesce("end_at", F.struct(F.lit(-(2**62)).alias("pos"), F.lit(-1).alias("idx"))), F.lit(False)))
    groups = walked.where("shot = false").groupBy(*SOURCE, "at").agg(F.min("ready").alias("applies"))
    final = walked.groupBy(*SOURCE, "asset").agg(F.max_by(F.struct("ready", "shot_at"), "at").alias("x")).where("x.ready").select(*SOURCE, "asset", F.col("x.shot_at").alias("base"))
    written = found.join(groups, [*SOURCE, "at"], "left").where("kind = 'book' or applies").select(*SOURCE, "at", "kind", F.posexplode("rows").alias("k", "r"))
    written = written.select(*SOURCE, "at", "kind", "k", "r.asset", "r.side", "r.price", "r.size").join(final, [*SOURCE, "asset"])
    kept = written.where("at > base or (at = base and kind = 'book')")
    books = kept.groupBy(*SOURCE, "asset", "side", "price").agg(F.max_by("size", F.struct("at", "k")).alias("size")).where("size > 0")
    counts = sources.join(shots.groupBy(*SOURCE).agg(F.count("*").alias("snapshots")), SOURCE, "left").join(groups.groupBy(*SOURCE).agg(F.count_if("applies").alias("groups"), F.count_if(~F.col("applies")).alias("before_snapshot")), SOURCE, "left")
    ready = final.groupBy(*SOURCE).agg(F.count("*").alias("ready_books"))
    return books, counts.join(ready, SOURCE, "left").fillna(0, ["snapshots", "groups", "before_snapshot", "ready_books"])


def source_digests(books: DataFrame) -> DataFrame:
    """One digest of all ready books of each source, the same for equal books."""
    level = F.concat_ws(":", "asset", "side", plain(F.col("price")), plain(F.col("size")))
    return books.groupBy(*SOURCE).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(level)), ","), 256).alias("digest"))


def audit(rebuilt_digests: DataFrame, declared: DataFrame) -> DataFrame:
    """Each source with both digests and MATCH, MISMATCH, MISSING (not declared) or EXTRA (declared, but not rebuilt)."""
    both = rebuilt_digests.join(declared.withColumnRenamed("digest", "declared"), SOURCE, "full_outer")
    result = F.when(F.col("declared").isNull(), "MISSING").when(F.col("digest").isNull(), "EXTRA").when(F.col("digest") == F.col("declared"), "MATCH").otherwise("MISMATCH")
    return both.select(*SOURCE, "digest", "declared", result.alias("result"))


def raw_accounting(records: DataFrame, fates: DataFrame) -> DataFrame:
    """By shard and lane: frames, their characters, keepalives, frames of other connections, and what became of the rest."""
    raw = live_records(records).where("kind = 'RAW'")
    counts = raw.groupBy(*SLOT).agg(
        F.count("*").alias("frames"), F.sum(F.length("raw").cast("long")).alias("characters"), F.count_if(F.col("live") & (F.col("raw") == "PONG")).alias("keepalives"), F.count_if(~F.col("live")).alias("stale"),
        (F.count("*") - F.count_distinct("connection", "pos")).alias("repeated"),
    )
    done = fates.groupBy(*SLOT).agg(F.count_if(F.col("fate") == "INTERPRETED").alias("interpreted"), F.count_if(F.col("fate") == "UNINTERPRETED").alias("uninterpreted"))
    return counts.join(done, SLOT, "left").fillna(0)
