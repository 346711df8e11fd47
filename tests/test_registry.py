"""Registry changes, rule binding and gateway checks on small tables."""

import hashlib

from augury.operators import coverage, registry


def test_upsert(spark):
    markets = spark.createDataFrame([(7, "c1", "old"), (9, "c2", "x")], "market_id long, condition_id string, category string")
    tokens = spark.createDataFrame([(7, "10", -13, 0), (7, "11", -14, 1), (9, "20", -17, 0), (9, "21", -18, 1)], "market_id long, token_id string, id long, outcome_index int")
    rows = spark.createDataFrame([("c1", "10", "11", "new"), ("c3", "30", "31", "n"), ("c3", "30", "31", "n"), ("c4", "20", "41", "n"), ("c5", "50", "51", "n"), ("c6", "51", "61", "n")], "condition_id string, yes_token string, no_token string, category string")
    m, t, conflicts = registry.upsert_registry(rows, markets, tokens)
    assert {tuple(r) for r in m.collect()} == {(7, "c1", "new"), (9, "c2", "x"), (10, "c3", "n")}
    assert {tuple(r) for r in t.where("market_id = 10").collect()} == {(10, "30", -19, 0), (10, "31", -20, 1)} and t.count() == 6
    assert {r["condition_id"]: r["reason"] for r in conflicts.collect()} == {"c4": "token belongs to another condition", "c5": "token claimed twice in batch", "c6": "token claimed twice in batch"}


def test_recovery(spark):
    good = '{"id":"1","conditionId":"C1","clobTokenIds":"[\\"1\\",\\"2\\"]","outcomes":["Yes","No"]}'
    latest = spark.createDataFrame([("a", 1, good), ("b", 2, good), ("c", 1, "{oops"), ("d", 1, good.replace("C1", "C9"))], "failure_key string, generation long, payload string")
    ledger = spark.createDataFrame([("a", 1, "open"), ("b", 1, "open"), ("c", 1, "open"), ("d", 1, "open")], "failure_key string, generation long, status string")
    markets = spark.createDataFrame([("0xc1",)], "condition_id string")
    got = {r["failure_key"]: r["status"] for r in registry.recover_failures(ledger, latest, markets).collect()}
    assert got == {"a": "resolved", "b": "open", "c": "open", "d": "open"}


def test_rules(spark):
    url = registry.RULE_URL % "btc"
    text = f"Resolves up if the time-weighted average is greater than or equal to the start, see {url}"
    values = lambda **x: tuple(({"asset": "BTC", "start_ms": 300_000, "end_ms": 600_000, "slug": "btc-updown-5m-300", "source": url, "description": text, "version": "v2", "condition_id": "0x" + "A" * 64, "labels": ["Down", "up"], "tokens": ["5", "6"]} | x).values())
    rows = [values(), values(end_ms=1), values(slug="x"), values(labels=["Up", "Up"]), values(tokens=["5", "5"]), values(description=None), values(version="v3")]
    frame = spark.createDataFrame(rows, "asset string, start_ms long, end_ms long, slug string, source string, description string, version string, condition_id string, labels array<string>, tokens array<string>")
    bound, others = registry.bind_rules(frame)
    (got,) = bound.collect()
    assert (got["up_token"], got["down_token"]) == ("6", "5") and got["rule_version"].endswith(hashlib.sha256(text.encode()).hexdigest()[:16]) and others.count() == 6


def test_gateway(spark):
    markets = spark.createDataFrame([(i,) for i in range(6)], "market long")
    gateway = spark.createDataFrame([(0, True, False, 5, 5, "P", "s", "t", 3, 3), (1, True, True, 5, 5, "P", "s", "t", 3, 3), (2, True, False, 5, 4, "P", "s", "t", 3, 3), (3, True, False, 5, 5, "P", "old", "t", 3, 3), (4, True, False, 5, 5, "P", "s", "t", 9, 3)], "market long, ready boolean, crossed boolean, market_seq long, source_seq long, plant string, session string, stream string, parent_seq long, parent_offset long")
    plants = spark.createDataFrame([("P", i, "s", "t", 4, 4) for i in range(6)], "plant string, market long, session string, stream string, committed_seq long, applied_offset long")
    got = {r["market"]: r["reasons"] for r in coverage.gateway_checks(markets, gateway, plants).collect()}
    assert got == {0: [], 1: ["GATEWAY_PAIR_NOT_READY"], 2: ["COMMITTED_SOURCE_EVIDENCE_MISSING"], 3: ["GATEWAY_SOURCE_SESSION_MISMATCH"], 4: ["GATEWAY_PARENT_OUTSIDE_CAPTURED_PLANT_PREFIX"], 5: ["GATEWAY_PAIR_NOT_READY"]}


def test_probes_stay_ambiguous_until_a_new_session(spark):
    rows = [("PING", 0), ("PONG", 5), ("PONG", 6), ("PING", 10), ("PONG", 12), ("PING", 20), ("PONG", 99), ("PING", 100), ("PING", 101), ("PONG", 102), ("PING", 110), ("PONG", 111)]
    rows = [(i, 1, 0, k, ms) for i, (k, ms) in enumerate(rows)] + [(100 + i, 1, 1, "PING" if i % 2 == 0 else "PONG", 200 + i) for i in range(8)]
    answers, sessions = registry.probe_health(spark.createDataFrame(rows, "id long, connection long, session long, kind string, ms long"), 50)
    assert [(r["id"], r["late"], r["healthy"]) for r in answers.orderBy("id").collect()] == [(1, False, False), (4, False, False), (6, True, False), (101, False, False), (103, False, False), (105, False, True), (107, False, True)]
    assert {r["session"]: (r["answers"], r["unmatched"], r["ambiguous"]) for r in sessions.collect()} == {0: (3, 3, True), 1: (4, 0, False)}


def test_malformed_fields_are_rejected(spark):
    base = {"id": 1, "conditionId": "AB", "clobTokenIds": ["1", "2"], "outcomes": ["No", "Yes"]}
    import json

    rows = [base, base | {"outcomePrices": "not json"}, base | {"clobTokenIds": "{}"}, base | {"outcomes": ["YES", "yes"]}, base | {"outcomes": ["Singh", "Singh"]}, base | {"tags": [{"slug": "tech"}, {"label": "Old  News"}, "tech"], "outcomePrices": []}, base | {"outcomePrices": ["0.1"]}, base | {"events": [{"slug": "e", "category": "Pop"}]}]
    good, bad = registry.normalize_markets(spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "id long, payload string"))
    got = {r["id"]: r for r in good.collect()}
    assert {r["id"]: r["reason"] for r in bad.collect()} == {1: "prices are no list", 2: "tokens are no list", 3: "outcomes are the same label", 6: "two prices required"}
    assert got[0]["yes_token"] == "2" and got[0]["condition_id"] == "0xab" and got[0]["is_closed"] and got[4]["yes_token"] == "1"
    assert got[5]["tags"] == ["tech", "old news"] and got[5]["category"] == "tech" and got[7]["category"] == "pop" and got[7]["event_slug"] == "e"
