"""Event decoders on hand-made logs."""

from augury.operators import decoders

LOG = "address string, topic0 string, topic1 string, topic2 string, topic3 string, data string, tx_hash string, log_index long, block_number long"
NAMES = {f"0x{i}": n for i, n in enumerate(("RequestPrice", "ProposePrice", "DisputePrice", "Settle", "ConditionPreparation", "ConditionResolution", "QuestionInitialized", "QuestionReset", "QuestionResolved", "QuestionSettled", "ConditionResolved", "CombinatorialConditionPrepared", "MigrationResolved", "Upgraded"))}
TOPIC = {n: t for t, n in NAMES.items()}
w = lambda x: f"{x % 2**256:064x}"
text = b"q: title: Rain?, description: x. market_id: 7 p1: 0, p2: 1\x00!"
blob = lambda b: w(len(b)) + b.hex().ljust(-(-len(b) // 32) * 64, "0")


def logs(spark, *rows):
    return spark.createDataFrame([(a, TOPIC.get(n, n), *["0x" + t if t else None for t in topics], "0x" + data, f"t{i}", i, 9) for i, (a, n, topics, data) in enumerate(rows)], LOG)


def test_requests(spark):
    parties = (w(1), w(2), w(3))
    head = w(0) + w(5) + w(32 * 5)
    rows = logs(
        spark, ("0xAB", "RequestPrice", (w(1), None, None), w(0) + w(5) + w(32 * 6) + w(0) * 3 + blob(text)), ("0xab", "Settle", parties, head + w(-(10**18)) + w(77) + blob(text)),
        ("0xab", "ProposePrice", parties, w(0) + w(5) + w(10**6) + w(1)), ("0xab", "0xdead", parties, head), ("0xab", "DisputePrice", parties, w(0) + w(5) + w(32 * 4) + w(2**200) + blob(b"")),
    )
    good, bad = decoders.decode_oracle_requests(rows, NAMES)
    got = {r["status"]: r for r in good.collect()}
    assert got["request"]["text"] == text.decode().replace("\x00", "\\x00") and got["request"]["oracle"] == "0xab" and got["request"]["proposer"] is None
    assert int(got["settle"]["price"]) == -(10**18) and int(got["settle"]["payout"]) == 77 and got["settle"]["disputer"] == "0x" + "3".zfill(40)
    assert sorted(r["reason"] for r in bad.collect()) == ["ancillary data out of range", "price is too wide", "unknown event"]


def test_conditions(spark):
    t = (w(11), w(12), w(13))
    rows = logs(spark, ("0x1", "ConditionPreparation", t, w(2)), ("0x1", "ConditionResolution", t, w(2) + w(64) + w(2) + w(0) + w(2**255)), ("0x1", "ConditionResolution", t, w(3) + w(64) + w(2) + w(0) + w(1)), ("0x1", "ConditionResolution", t, w(2) + w(64) + w(5) + w(0)), ("0x1", "Settle", t, w(2)))
    good, bad = decoders.decode_ctf(rows, NAMES)
    got = {r["status"]: r for r in good.collect()}
    assert got["settle"]["numerators"] == [w(0), w(2**255)] and got["request"]["numerators"] is None and got["request"]["condition_id"] == "0x" + w(11)
    assert sorted(r["reason"] for r in bad.collect()) == ["payouts do not match slots", "payouts out of range", "unknown event"]


def test_adapters(spark):
    rows = logs(
        spark, ("0xold", "QuestionInitialized", (w(1), None, None), w(32) + blob(b"hi")), ("0xold", "QuestionResolved", (w(1), w(1), None), ""), ("0xold", "QuestionSettled", (w(1), w(-5), w(0)), ""),
        ("0xnew", "QuestionResolved", (w(1), w(10**18), None), ""), ("0xnew", "QuestionSettled", (w(1), w(1), w(1)), ""), ("0xnew", "QuestionReset", (w(4), None, None), ""),
    )
    good, bad = decoders.decode_adapter_events(rows, NAMES, "0xold")
    got = {(r["adapter"], r["status"]): r for r in good.collect()}
    assert got["0xold", "initialized"]["ancillary_hex"] == b"hi".hex() and got["0xold", "resolved"]["emergency"] and got["0xold", "resolved"]["price"] is None
    assert int(got["0xold", "settled"]["price"]) == -5 and got["0xold", "settled"]["early"] is False and int(got["0xnew", "resolved"]["price"]) == 10**18
    assert [r["reason"] for r in bad.collect()] == ["unknown event"]


def test_modules(spark):
    c = lambda m, n: f"{m:02x}{n:060x}00"
    pair = lambda a, b: w(32) + w(2) + w(a) + w(b)
    rows = logs(
        spark, ("0xm1", "ConditionResolved", (c(1, 5), None, None), pair(400_000, 600_000)), ("0xm1", "ConditionResolved", (c(2, 5), None, None), pair(400_000, 600_000)), ("0xm1", "ConditionResolved", (c(1, 5), None, None), pair(1, 2)),
        ("0xm3", "CombinatorialConditionPrepared", (c(3, 8), None, None), w(32) + w(2) + c(1, 1) + c(2, 2)), ("0xm1", "CombinatorialConditionPrepared", (c(1, 8), None, None), w(32) + w(0)), ("0xm3", "ConditionResolved", (c(3, 8), None, None), pair(0, 10**6)),
        ("0xm1", "MigrationResolved", (c(1, 6), w(1), None), w(0) + w(0) + w(10**6) + w(0)), ("0xzz", "Upgraded", (w(1), None, None), ""), ("0xm1", "Upgraded", (w(1), None, None), ""),
    )
    good, bad = decoders.decode_module_events(rows, NAMES, {"0xm1": 1, "0xm2": 2, "0xm3": 3}, "0xm3")
    got = {(r["module"], r["event"]): r for r in good.collect()}
    assert got["0xm1", "ConditionResolved"]["payouts"] == ["400000", "600000"] and got["0xm1", "ConditionResolved"]["condition_id"] == "0x" + c(1, 5)[:62]
    assert got["0xm3", "CombinatorialConditionPrepared"]["legs"] == [c(1, 1), c(2, 2)] and got["0xm1", "MigrationResolved"]["payouts"] == ["1000000", "0"] and ("0xm1", "Upgraded") in got
    assert sorted(r["reason"] for r in bad.collect()) == ["condition of another module", "event is not of this module", "event is not of this module", "results do not sum to a unit", "unknown event or module"]


def test_links(spark):
    requests = spark.createDataFrame([(1, "0xaa"), (2, "0xbb"), (3, "0xcc"), (4, "0xdd")], "id long, ancillary_hex string")
    questions = spark.createDataFrame([("0xaa", "q1", "n"), ("0xbb", "q2", "p"), ("0xcc", "q3", "p"), ("0xcc", "q4", "p")], "ancillary_hex string, question_id string, adapter string")
    found, conflict = decoders.enrich_requests(requests, questions, spark.createDataFrame([("q1", "Q1"), ("q2", "Q2")], "request_id string, question_id string"), ("n",))
    assert {tuple(r)[0:1] + tuple(r)[2:] for r in found.collect()} == {(1, "n", "Q1"), (2, "p", "q2"), (4, None, None)} and [r["id"] for r in conflict.collect()] == [3]
    markets = spark.createDataFrame([(1, "0xA", "x"), (2, "0xb", "y"), (3, "0xc", "z"), (4, "0xc", None)], "market_id long, condition_id string, question_id string")
    events = spark.createDataFrame([(1, None, "0xa", None), (2, None, "0xa", "y"), (3, None, "0xC", "z"), (4, 9, "0xa", "x"), (5, None, None, "none"), (6, None, "0xB", "y")], "id long, market_id long, condition_id string, question_id string")
    assert {r["id"]: r["market_id"] for r in decoders.reconcile_orphans(events, markets).collect()} == {1: 1, 2: None, 3: 3, 4: 9, 5: None, 6: 2}
