"""Replay audit, cut hashes, stream digests, combinations and facts appended once, on small inputs."""

import numpy as np

from augury.operators import audits, book, combos, coverage, fills, replay
from augury.sources import shared

RECORDS = "pos long, kind string, shard long, lane long, connection long, market string, raw string"


def snapshot(asset, bids, market="m"):
    levels = ",".join(f'{{"price":"{p}","size":"{s}"}}' for p, s in bids)
    return f'{{"event_type":"book","market":"{market}","asset_id":"{asset}","bids":[{levels}],"asks":[]}}'


def change(*rows, market="m"):
    return f'{{"event_type":"price_change","market":"{market}","price_changes":[' + ",".join(f'{{"asset_id":"{a}","side":"BUY","price":"{p}","size":"{s}"}}' for a, p, s in rows) + "]}"


def test_replay_follows_connections_and_broken_frames(spark):
    rows = [
        (1, "CONNECT", 7, None), (2, "RAW", 7, snapshot("a", [("0.10", "5")])), (3, "RAW", 7, change(("a", "0.1", "6.0"), ("b", "0.2", "1"))),  # b is not ready
        (4, "RAW", 7, f'[{snapshot("b", [("0.30", "1"), ("0.40", "0")])},{{"event_type":"book","market":"m"}},{change(("a", "0.9", "9"))}]'),  # broken in the middle
        (5, "RAW", 7, change(("a", "0.100", "7.50"), ("b", "0.2", "2"))), (6, "RAW", 9, change(("a", "0.5", "1"))), (7, "RAW", 7, "PONG"), (8, "RAW", 7, "{oops"), (9, "RAW", 7, "[]"),
        (10, "RAW", 7, change(("a", "0.7", "1"), market="other")), (11, "DISCONNECT", 7, None), (12, "RAW", 7, change(("a", "0.8", "1"))), (13, "RAW", 7, snapshot("a", [("0.6", "1")])),
        (14, "CONNECT", 8, None), (15, "RAW", 7, snapshot("a", [("0.7", "1")])), (16, "RAW", 8, snapshot("b", [("0.2", "3")])),
    ]
    records = spark.createDataFrame([(p, k, 0, 1, c, None, raw) for p, k, c, raw in rows], RECORDS)
    scope = spark.createDataFrame([("m", "a"), ("m", "b")], "market string, asset string")
    at = lambda cut: {(r["asset"], r["price"], r["size"]) for r in replay.rebuilt(records, scope, cut)[0].select("asset", replay.plain(replay.F.col("price")).alias("price"), replay.plain(replay.F.col("size")).alias("size")).collect()}
    assert at(3) == {("a", "0.1", "5")}
    assert at(10) == {("a", "0.1", "7.5"), ("b", "0.3", "1"), ("b", "0.2", "2")}
    assert at(12) == set() and at(13) == {("a", "0.6", "1")} and at(14) == set() and at(16) == {("b", "0.2", "3")}
    (counts,) = replay.rebuilt(records, scope, 16)[1].collect()
    assert (counts["snapshots"], counts["groups"], counts["before_snapshot"], counts["ready_books"]) == (4, 1, 2, 1)
    live = replay.live_records(records)
    (sums,) = replay.raw_accounting(records, replay.messages(live, scope)[1]).collect()
    assert (sums["frames"], sums["keepalives"], sums["stale"], sums["repeated"], sums["uninterpreted"]) == (13, 1, 2, 0, 2)
    declared = replay.source_digests(replay.rebuilt(records, scope, 10)[0])
    found = replay.audit(replay.source_digests(replay.rebuilt(records, scope, 16)[0]), declared)
    assert [r["result"] for r in found.collect()] == ["MISMATCH"]
    assert [r["result"] for r in replay.audit(declared, declared.limit(0)).collect()] == ["MISSING"] and [r["result"] for r in replay.audit(declared.limit(0), declared).collect()] == ["EXTRA"]


def test_stream_digest_depends_on_order_only(spark):
    rows = [(s, i, f"frame {i * 7 % 50}") for s in (1, 2) for i in range(300)]
    digest = lambda rs, n: {r["stream"]: tuple(r) for r in audits.stream_digests(spark.createDataFrame(rs, "stream long, offset long, frame string").repartition(n), fan=16).collect()}
    whole = digest(rows, 1)
    assert whole == digest(rows, 7) == digest(rows[::-1], 3) and whole[1][1:4] == (0, 299, 300) and whole[1][4] == whole[2][4]
    swapped = [(s, {10: 11, 11: 10}.get(i, i) if s == 1 else i, f) for s, i, f in rows]
    assert digest(swapped, 2)[1][4] != whole[1][4] and digest(swapped, 2)[2] == whole[2]
    assert digest(rows + rows[:5], 2) == whole and digest([*rows, (1, 4, "other")], 2)[1] != whole[1]


def test_equal_states_have_equal_hashes(spark):
    """A market that comes back to an earlier state has the hash it had."""
    rng = np.random.default_rng(2)
    level = lambda side, price, size: [(0, side, price, size)]
    events = [(0, 1, 0, "SNAPSHOT", level("BUY", 10, 5)), (1, 1, 0, "CHANGE", level("BUY", 20, 1)), (2, 1, 0, "CHANGE", level("BUY", 20, 0)), (3, 1, 0, "CHANGE", level("SELL", 30, 2)), (4, 1, None, "GAP", []), (5, 1, 0, "SNAPSHOT", level("BUY", 10, 5))]
    events += [(100 + i, 2, 0, "CHANGE" if i else "SNAPSHOT", level(str(rng.choice(["BUY", "SELL"])), int(rng.integers(1, 9)), int(rng.integers(0, 3)))) for i in range(60)]
    rows = book.applied(book.book_levels(spark.createDataFrame(events, "pos long, market long, asset long, kind string, levels array<struct<asset: long, side: string, price: long, size: long>>"))[0])
    got = {(r["market"], r["moment"]): (r["elements"], r["hash"]) for r in book.cut_hashes(rows).collect()}
    assert got[1, 0] == got[1, 2] == got[1, 5] and len({got[1, k] for k in (0, 1, 3, 4)}) == 4
    state, seen = {}, {}
    for pos, market, _, _, (entry,) in events[6:]:
        state[entry[1], entry[2]] = entry[3]
        now = frozenset((k, v) for k, v in state.items() if v)
        assert seen.setdefault(now, got[market, pos]) == got[market, pos] and got[market, pos][0] == len(now) + 1
    assert len(set(seen.values())) == len(seen)


def test_sources_stay_and_follow_each_other(spark):
    rows = [(1, 1, True), (2, 0, True), (3, 1, False), (4, 0, False), (5, 1, True), (6, 1, False)]
    table = spark.createDataFrame([(1, i, i, lane, 0, good) for i, lane, good in rows], "market long, ms long, id long, lane long, shard long, usable boolean")
    shown = lambda df: [(r["id"], r["kind"], r["lane"], r["reason"]) for r in df.orderBy("id").collect()]
    first = [(1, "RESET", 1, "HEALTHY_SOURCE_READY"), (4, "GAP", None, "TRANSPORT_UNQUALIFIED"), (5, "RESET", 1, "HEALTHY_SOURCE_READY"), (6, "GAP", None, "TRANSPORT_UNQUALIFIED")]
    assert shown(coverage.source_events(table)) == [first[0], (2, "RESET", 0, "HEALTHY_PRIMARY_READY"), *first[1:]]
    assert shown(coverage.source_events(table, prefer_primary=False)) == [first[0], (3, "RESET", 0, "TRANSPORT_UNQUALIFIED"), *first[1:]]


def test_markets_need_both_tokens_on_one_lane(spark):
    rows = [(0, 0, 1, 0, True), (0, 1, 2, 0, True), (0, 0, 2, 40, True), (1, 0, 1, 60, True), (1, 0, 2, 60, True), (0, 0, 1, 90, False)]
    changes = spark.createDataFrame([(*r[:4], r[4], i) for i, r in enumerate(rows)], "plant long, lane long, token long, ms long, ready boolean, id long")
    scope = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (2, 4)], "market long, token long")
    got = {r["market"]: tuple(r)[1:] for r in coverage.market_coverage(changes, scope, 0, 100).select("market", "tokens", "token_one_plant", "token_all_plants", "market_one_plant", "market_all_plants", "window").collect()}
    assert got == {1: (2, 200, 70, 60, 30, 100), 2: (2, 0, 0, 0, 0, 100)}
    (sums,) = coverage.coverage_summary(coverage.market_coverage(changes, scope, 0, 100)).collect()
    assert sums["market_one_plant_share"] == 0.3 and sums["token_one_plant_share"] == 0.5


def test_combinations_need_evidence_that_agrees(spark):
    position = lambda n, bit: "03" + f"{n:060x}" + f"0{bit}"
    named = lambda n: "0x03" + f"{n:060x}"
    fills_ = spark.createDataFrame([(position(n, 0), "t1", 5) for n in range(1, 8)] + [(position(1, 1), "t2", 3), (position(2, 1), "t2", 9), ("02" + "0" * 62, "t", 1), (None, "t", 1)], "position string, tx_hash string, block_time long")
    act = [(1, "t1", position(1, 0), True, named(1).upper(), " A  b", ""), (2, "t2", position(1, 1), True, named(1), "A b", None), (3, "t1", position(2, 0), True, named(2), "x", ""), (4, "t2", position(2, 1), True, named(2), "y", ""), (5, "t1", position(3, 0), False, named(3), "x", ""), (6, "t1", position(4, 0), True, named(9), "x", ""), (7, "t1", position(5, 0), True, named(5), "x", "Yes"), (8, "t1", position(6, 0), True, named(6), "x", "")]
    activity = spark.createDataFrame(act, "id long, tx_hash string, position string, is_combo boolean, condition_id string, title string, outcome string")
    details = spark.createDataFrame([(1, position(1, 1), named(1), 3, [("Rain", "Yes"), ("No snow", "no"), (None, "x")]), (2, position(6, 1), named(6), 2, [("a", "b")])], "id long, position string, condition_id string, module_id long, legs array<struct<title: string, outcome: string>>")
    good, bad = combos.resolve(fills_, activity, details)
    (one,) = good.collect()
    assert (one["condition_id"], one["title"], one["legs_title"], one["created_at"], one["transactions"], one["assets"], one["evidence"]) == (named(1), "A b", "Rain: Yes AND No snow", 3, 2, 2, combos.DETAILED)
    reasons = {r["condition_id"]: r["reason"] for r in bad.collect()}
    assert [reasons[named(n)] for n in range(2, 8)] == ["TITLES_DISAGREE", "NOT_MARKED_AS_COMBO", "CONDITION_CONFLICT", "LOGICAL_OUTCOME", "DETAIL_MODULE", "NO_EXACT_ACTIVITY"]
    assert reasons[""] == "NOT_A_COMBO_POSITION" and len(reasons) == 8


def test_facts_are_appended_once(spark, tmp_path):
    path = str(tmp_path / "facts")
    fact = lambda i, block: (f"t{i}", i, block, 1, "w")
    table = lambda rows: spark.createDataFrame(rows, "tx_hash string, log_index long, block_number long, market_id long, token_id string")
    append = lambda rows, n: tuple(fills.append_once(table(rows), path, n, ["tx_hash", "log_index"], blocks=100).first())
    assert append([fact(i, 10 * i) for i in range(20)], 0) == (0, 20, 20, 0, 0)
    second = [fact(i, 10 * i) for i in range(15, 30)] + [fact(40, 5)] * 2
    assert append(second, 1) == (1, 17, 10, 5, 2) == append(second, 1)  # again after a failure
    assert append([], 2) == (2, 0, 0, 0, 0)
    assert sorted(r["log_index"] for r in spark.read.parquet(path).collect()) == list(range(30))
    plan = spark.read.parquet(path).where("block_bucket in (1, 2)")._jdf.queryExecution().toString()
    assert "PartitionFilters: [block_bucket" in plan
    shared.removed(shared.written(table([fact(1, 1)])))
