"""Queries over frames, deliveries, tapes, gates and operations tables, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from augury.operators import audits, book, tables
from augury.sources import fixtures as fx


def messages(spark, sf_dir):
    good = audits.explode_frames(fx.frame(spark, sf_dir, fx.frames))[0]
    price = audits.canonical_decimal(F.get("bids", 0)["price"])
    return good.select("pos", F.col("message_index").cast("long").alias("message_index"), "event_type", "market", *[F.coalesce(c, F.lit("")).alias(n) for c, n in ((F.col("asset_id"), "asset_id"), (price, "price"), (audits.canonical_decimal(F.get("bids", 0)["size"]), "size"))])


def bad_frames(spark, sf_dir):
    return audits.explode_frames(fx.frame(spark, sf_dir, fx.frames))[1].select("pos", "reason")


def delivery(spark, sf_dir):
    got = fx.frame(spark, sf_dir, fx.frames)
    stored = got.where("pos % 17 <> 3").withColumn("raw", F.when(F.col("pos") % 19 == 5, F.concat("raw", F.lit(" "))).otherwise(F.col("raw")))
    return audits.verify_delivery(got, stored, ["pos"], "raw")


def tape_violations(spark, sf_dir):
    tape = book.sequence_tape(fx.frame(spark, sf_dir, fx.book_events)).where("pos % 29 <> 4").withColumn("book_epoch", F.col("book_epoch") + F.when(F.col("pos") % 53 == 7, 1).otherwise(0))
    assets = fx.frame(spark, sf_dir, fx.book_events).select("market", "asset").distinct().where("(market * 2 + asset) % 23 <> 5")
    return audits.audit_tape(tape, assets)


def tape_gates(spark, sf_dir):
    bad = tape_violations(spark, sf_dir).select(F.explode(F.split("reasons", ",")).alias("gate")).withColumn("bad", F.lit(1))
    none = spark.range(1).select(F.explode(F.array(*[F.lit(g) for g in ("SEQUENCE", "BEFORE_RESET", "EPOCH", "UNKNOWN_ASSET", "DUPLICATE")])).alias("gate"), F.lit(0).alias("bad"))
    return audits.gates(bad.unionByName(none))


def cuts(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), (F.col("user_id") % 4).alias("u"))
    times = [F.col("id"), F.col("id") + F.col("u"), F.col("id") + 2]
    why = audits.cut_reasons(F.when(F.col("u") != 3, F.col("u")), F.col("id") % 5, times, 100, 900, 1)
    return e.select("id", F.array_join(why, ",").alias("reasons"))


def durations(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.prices)
    return audits.stage_durations(p, {"publish": ("observed_ms", "published_ms"), "receive": ("observed_ms", "received_ms"), "deliver": ("published_ms", "received_ms")})


def duration_quantiles(spark, sf_dir):
    return tables.exact_quantiles(durations(spark, sf_dir), ["stage"], "took", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def queue(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.prices).select("id", F.col("price").alias("bytes"), F.col("observed_ms").alias("at"))
    return audits.queue_inventory(p, p.where("id % 3 = 0"), "id", 4).withColumnRenamed("oldest", "oldest_ms")


def _scan(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.prices).select("id", F.col("id").alias("created"), F.when(F.col("asset") != 2, F.col("id") + F.col("price") % 50).alias("updated"))
    top = p.agg(F.max("id")).first()[0] or 0
    return audits.incremental_scan(p, top // 2, top // 10, True)


def scan_rows(spark, sf_dir):
    return _scan(spark, sf_dir)[0].select("id")


def scan_state(spark, sf_dir):
    return _scan(spark, sf_dir)[1]


def unauthorized(spark, sf_dir):
    e = fx.frame(spark, sf_dir, fx.lifecycle).select("id", (F.col("market") % 5).alias("oracle"), (F.col("value") % 7).alias("requester"))
    allowed = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((F.col("s_suppkey") % 5).alias("oracle"), (F.col("s_nationkey") % 7).cast("long").alias("requester"))
    return audits.authorized(e, allowed)[1].select("id", "oracle", "requester")


def to_revalidate(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id"))
    return audits.revalidation(c.where("id % 2 = 0"), c.where("id % 3 <> 0"), 20)


def ancillary(spark, sf_dir):
    return fx.frame(spark, sf_dir, fx.ancillary).select("id", *[F.coalesce(c, F.lit("")).alias(n) for n, c in audits.ancillary_fields(F.col("text")).items()])


def price_texts(spark, sf_dir):
    p = fx.frame(spark, sf_dir, fx.prices)
    units = F.col("price").cast("decimal(38,0)") * F.when(F.col("id") % 3 == 0, F.lit(10**12)).otherwise(F.lit(-(10**8))).cast("decimal(14,0)")
    return p.select("id", audits.price_text(units).alias("price"))


def decoded_positions(spark, sf_dir):
    parts = audits.decode_position(F.col("position"))
    return fx.frame(spark, sf_dir, fx.positions).select("id", parts["valid"].alias("valid"), F.coalesce(parts["condition"], F.lit("")).alias("condition"), F.coalesce(parts["outcome"], F.lit(-1)).alias("outcome"), F.coalesce(parts["sibling"], F.lit("")).alias("sibling"))


def legs(spark, sf_dir):
    """Leg lists of ten consecutive positions of an owner, sorted or not."""
    p = fx.frame(spark, sf_dir, fx.positions).withColumn("g", F.floor(F.col("id") / 40))
    lists = p.groupBy("owner", "g").agg(F.array_sort(F.collect_list("position")).alias("x"))
    return lists.select("owner", "g", F.size("x").cast("long").alias("legs"), audits.valid_legs(F.when(F.col("g") % 5 == 0, F.reverse("x")).otherwise(F.col("x"))).alias("valid"))


QUERIES = {
    "frame_messages": messages, "frame_rejects": bad_frames, "delivery_check": delivery, "tape_audit": tape_violations, "tape_gates": tape_gates, "cut_validity": cuts, "stage_durations": durations,
    "duration_quantiles": duration_quantiles, "queue_inventory": queue, "incremental_scan": scan_rows, "scan_watermark": scan_state, "unauthorized_events": unauthorized, "revalidation_set": to_revalidate,
    "ancillary_fields": ancillary, "price_text": price_texts, "combo_positions": decoded_positions, "combo_legs": legs,
}

_FRAMES = fx.cte(f=fx.frames) + """
    , a AS (SELECT pos, raw, CASE WHEN raw LIKE '[%' THEN raw ELSE '[' || raw || ']' END AS t FROM f WHERE raw <> 'PING'), ok AS (SELECT pos, raw, CASE WHEN json_valid(t) THEN t::JSON END AS j FROM a),
    m AS (SELECT pos, unnest(range(0, json_array_length(j)::BIGINT)) AS message_index, j FROM ok WHERE j IS NOT NULL), x AS (SELECT pos, message_index, j->message_index AS v FROM m),
    bad AS (SELECT pos FROM ok WHERE j IS NULL UNION SELECT pos FROM x WHERE v->>'event_type' IS NULL)
"""
_TAPE = fx.cte(ev=fx.book_events) + """
    , s AS (SELECT pos, market, asset, kind, row_number() OVER w AS seq, sum(CASE kind WHEN 'RESET' THEN 1 ELSE 0 END) OVER w AS e FROM ev WINDOW w AS (PARTITION BY market ORDER BY pos)),
    t AS (SELECT *, e + CASE WHEN pos % 53 = 7 THEN 1 ELSE 0 END AS epoch FROM s WHERE pos % 29 <> 4), l AS (SELECT *, lag(seq) OVER w AS pseq, last_value(CASE kind WHEN 'RESET' THEN epoch END IGNORE NULLS) OVER w AS re FROM t WINDOW w AS (PARTITION BY market ORDER BY pos)),
    v AS (SELECT market, pos, list_filter([CASE WHEN seq <> pseq + 1 THEN 'SEQUENCE' END, CASE WHEN re IS NULL THEN 'BEFORE_RESET' END, CASE WHEN epoch <> re THEN 'EPOCH' END, CASE WHEN (market * 2 + asset) % 23 = 5 THEN 'UNKNOWN_ASSET' END], lambda x: x IS NOT NULL) AS r FROM l)
"""
_DURATIONS = fx.cte(p=fx.prices) + ", d AS (SELECT id, 'publish' AS stage, published_ms - observed_ms AS took FROM p UNION ALL SELECT id, 'receive', received_ms - observed_ms FROM p UNION ALL SELECT id, 'deliver', received_ms - published_ms FROM p)"
_SCAN = fx.cte(p=fx.prices) + ", o AS (SELECT id, greatest(id, CASE WHEN asset <> 2 THEN id + price % 50 END) AS seen, (SELECT max(id) FROM p) AS top FROM p)"

ORACLE_SQL = {
    "frame_messages": _FRAMES + """
        SELECT pos, message_index, v->>'event_type' AS event_type, v->>'market' AS market, coalesce(v->>'asset_id', '') AS asset_id,
            coalesce(regexp_replace(regexp_replace(v->'bids'->0->>'price', '0+$', ''), '[.]$', ''), '') AS price, coalesce(regexp_replace(v->'bids'->0->>'size', '0+$', ''), '') AS size FROM x WHERE pos NOT IN (SELECT pos FROM bad)""",
    "frame_rejects": _FRAMES + "SELECT pos, 'not a frame' AS reason FROM bad",
    "delivery_check": fx.cte(f=fx.frames) + "SELECT pos, CASE WHEN pos % 17 = 3 THEN 'MISSING' WHEN pos % 19 = 5 THEN 'DIFFERENT' ELSE 'EQUAL' END AS status FROM f",
    "tape_audit": _TAPE + "SELECT market, pos, array_to_string(r, ',') AS reasons FROM v WHERE len(r) > 0",
    "tape_gates": _TAPE + """
        , g AS (SELECT unnest(r) AS gate, 1 AS bad FROM v UNION ALL SELECT unnest(['SEQUENCE', 'BEFORE_RESET', 'EPOCH', 'UNKNOWN_ASSET', 'DUPLICATE']), 0), k AS (SELECT gate, sum(bad)::BIGINT AS bad FROM g GROUP BY gate)
        SELECT gate, bad, bad = 0 AS passed FROM k UNION ALL SELECT 'ALL', sum(bad)::BIGINT, bool_and(bad = 0) FROM k""",
    "cut_validity": """
        SELECT event_id AS id, array_to_string(list_filter([CASE WHEN user_id % 4 = 3 THEN 'PRODUCER' END, CASE WHEN event_id % 5 <> 1 THEN 'REVISION' END, CASE WHEN event_id NOT BETWEEN 100 AND 900 THEN 'WINDOW' END,
            CASE WHEN user_id % 4 > 2 THEN 'CLOCK_1' END], lambda x: x IS NOT NULL), ',') AS reasons FROM events""",
    "stage_durations": _DURATIONS + "SELECT * FROM d",
    "duration_quantiles": _DURATIONS + ", k AS (SELECT stage, took, row_number() OVER (PARTITION BY stage ORDER BY took) - 1 AS i, count(*) OVER (PARTITION BY stage) AS n FROM d) SELECT stage, max(n) AS n, " + ", ".join(f"max(took) FILTER (i = floor((n - 1) * {q}::DOUBLE)) AS {c}" for c, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))) + ", max(took) AS max FROM k GROUP BY stage",
    "queue_inventory": fx.cte(p=fx.prices) + "SELECT ('0x' || substr(sha256(id::VARCHAR), 1, 8))::BIGINT % 4 AS part, count(*) AS pending, sum(price)::BIGINT AS bytes, min(observed_ms) AS oldest_ms FROM p WHERE id % 3 <> 0 GROUP BY 1",
    "incremental_scan": _SCAN + "SELECT id FROM o WHERE seen >= top // 2 - top // 10",
    "scan_watermark": _SCAN + "SELECT greatest(max(seen), max(top) // 2) AS watermark FROM o",
    "unauthorized_events": fx.cte(e=fx.lifecycle) + "SELECT id, market % 5 AS oracle, value % 7 AS requester FROM e WHERE (market % 5, value % 7) NOT IN (SELECT (s_suppkey % 5, (s_nationkey % 7)::BIGINT) FROM supplier)",
    "revalidation_set": "SELECT c_custkey AS id FROM customer WHERE c_custkey % 6 = 0 AND c_custkey > 20",
    "ancillary_fields": "SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 3 THEN '' ELSE (p_partkey * 7)::VARCHAR END AS market_id, CASE WHEN p_partkey % 5 = 3 THEN '' ELSE p_name || ' ?' END AS title, CASE WHEN p_partkey % 5 = 3 OR p_partkey % 3 = 0 THEN '' ELSE '0' END AS p1, CASE WHEN p_partkey % 5 = 3 OR p_partkey % 3 = 0 THEN '' ELSE '1.5' END AS p2 FROM part",
    "price_text": fx.cte(p=fx.prices) + """
        , d AS (SELECT id, CASE WHEN id % 3 = 0 THEN '' ELSE '-' END AS s, lpad(price::VARCHAR || CASE WHEN id % 3 = 0 THEN repeat('0', 12) ELSE repeat('0', 8) END, 30, '0') AS x FROM p)
        SELECT id, s || regexp_replace(ltrim(left(x, 11), '0') || CASE WHEN ltrim(left(x, 11), '0') = '' AND left(x, 12) <> '' THEN '' ELSE '' END || CASE WHEN substr(x, 12, 1) >= '0' THEN substr(x, 12, 1) END || '.' || right(x, 18), '[.]?0+$', '') AS price FROM d""",
    "combo_positions": fx.cte(p=fx.positions) + """
        , v AS (SELECT *, left(position, 2) = '03' AND right(position, 2) IN ('00', '01') AS ok FROM p)
        SELECT id, ok AS valid, CASE WHEN ok THEN '0x' || left(position, 62) ELSE '' END AS condition, CASE WHEN ok THEN right(position, 1)::INT ELSE -1 END AS outcome,
            CASE WHEN ok THEN left(position, 62) || CASE right(position, 1) WHEN '1' THEN '00' ELSE '01' END ELSE '' END AS sibling FROM v""",
    "combo_legs": fx.cte(p=fx.positions) + """
        SELECT owner, id // 40 AS g, count(*) AS legs, bool_and(left(position, 2) IN ('01', '02') AND right(position, 2) IN ('00', '01')) AND count(DISTINCT left(position, 62)) = count(*) AND (g % 5 <> 0 OR count(*) = 1) AS valid FROM p GROUP BY owner, g""",
}
