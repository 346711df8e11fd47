"""Ownership, promotions and the registry write; qualification of a cut."""

from augury.operators import ownership, qualification, tables

ROWS = "condition_id string, yes_token string, no_token string, gamma_market_id string, category string, normalized boolean"
MARKETS = "market_id long, condition_id string, identity_kind string, gamma_market_id string, category string, slug string"
TOKENS = "token_id string, market_id long, condition_id string, id long, outcome string, outcome_index int"


def test_registry_write(spark):
    rows = [
        ("C1", "10", "11", "g1", "new", True), ("c2", "20", "21", "g2", "new", True), ("c3", "30", "31", "g3", "new", True), ("c4", "40", "20", "g4", "n", True), ("c5", "50", "51", "g5", "n", True),
        ("c6", "60", "61", "g6", "n", False), ("c9", "90", "91", "g9", "n", True), ("c8", "70", "81", "g8", "n", True), ("c9", "90", "91", "g9", "n", True), ("c7", "12", "13", "g7", "n", True),
    ]
    markets = [(1, "c1", "canonical_gamma", "g1", "old", "s"), (2, "c2", "legacy_placeholder", " ", "OrderFilled-Placeholder", "s"), (3, "c3", "canonical_clob", "x", "old", "s"), (5, "p5", "protocol_structural", None, None, None), (6, "p6", "protocol_structural", None, None, None)]
    token = lambda t, m, c, i: (t, m, c, -(2 * m - 1 + i), "YES" if i == 0 else "NO", i)
    tokens = [token("10", 1, "c1", 0), token("11", 1, "c1", 1), token("20", 2, "c2", 0), token("50", 5, "p5", 0), token("60", 6, "p6", 0), token("70", 5, "p5", 1), token("12", 3, "c3", 0)]
    m, t = spark.createDataFrame(markets, MARKETS), spark.createDataFrame(tokens, TOKENS)
    good, evidence, moves = ownership.filter_ownership(spark.createDataFrame(rows, ROWS), m, t)
    assert {r["condition_id"] for r in good.collect()} == {"c1", "c2", "c5", "c8", "c9"}
    assert {(r["kind"][:5], r["token_id"], r["existing"], r["attempted"]) for r in evidence.collect()} == {("condi", "", "c3", "c3"), ("token", "20", "c2", "c4"), ("token", "60", "p6", "c6"), ("token", "12", "c3", "c7")}
    assert {(r["kind"], r["token_id"], r["from_market_id"], r["to_condition_id"]) for r in moves.collect()} == {("market_identity", "", 2, "c2"), ("token_rehome", "50", 5, "c5"), ("token_rehome", "70", 5, "c8")}
    since = t.withColumn("condition_id", ownership.F.when(ownership.F.col("token_id") == "70", "else").otherwise(ownership.F.col("condition_id")))
    after, now, failures = ownership.write_registry(good, moves, m, since)
    assert [(r["condition_id"], r["failure"]) for r in failures.collect()] == [("c8", "CHANGED_SINCE")]
    got = {r["condition_id"]: (r["market_id"], r["identity_kind"], r["gamma_market_id"]) for r in after.collect()}
    assert got == {"c1": (1, "canonical_gamma", "g1"), "c2": (2, "canonical_gamma", "g2"), "c3": (3, "canonical_clob", "x"), "p5": (5, "protocol_structural", None), "p6": (6, "protocol_structural", None), "c5": (7, "canonical_gamma", "g5"), "c9": (8, "canonical_gamma", "g9")}
    held = {r["token_id"]: (r["market_id"], r["condition_id"], r["id"], r["outcome"]) for r in now.collect()}
    assert held["50"] == (7, "c5", -13, "YES") and held["51"] == (7, "c5", -14, "NO") and held["21"] == (2, "c2", -4, "NO") and held["70"][1] == "else" and held["90"][0] == 8 and len(held) == 11
    nothing = ownership.write_registry(good.limit(0), moves.limit(0), m, t)
    assert nothing[0].count() == 5 and nothing[1].count() == 7 and nothing[2].count() == 0


def test_ranks(spark):
    rows = spark.createDataFrame([(i * 7 % 50,) for i in range(50)] + [(None,), (3,)], "x long").repartition(5)
    assert [r["x"] for r in tables.ranked(rows, ["x"], "n").orderBy("n").collect()] == [None, 0, 1, 2, 3, 3, *range(4, 50)]
    assert tables.ranked(rows.limit(0), ["x"], "n").count() == 0


def test_reasons_of_a_token(spark):
    desired = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "market long, token long")
    owners = spark.createDataFrame([(1, 0, True)], "market long, cohort long, identity_ok boolean")
    held = spark.createDataFrame([(2, "HELD")], "market long, reason string")
    nodes = spark.createDataFrame([(0, 0, 50, 60, []), (1, 0, 50, 60, ["LATE"])], "plant int, cohort long, applied_offset long, durable_offset long, errors array<string>")
    lanes = spark.createDataFrame([(0, 0), (1, 0)], "plant int, lane int")
    fields = "market long, token long, plant int, lane int, connection string, epoch long, shard long, written boolean, book_seen boolean, baseline_connection string, baseline_offset long, baseline_durable boolean, receipt_offset long, eligibility array<string>, ready boolean, status string"
    state = lambda token, plant, **x: tuple({"market": 1, "token": token, "plant": plant, "lane": 0, "connection": "k", "epoch": 1, "shard": 3, "written": True, "book_seen": True, "baseline_connection": "k", "baseline_offset": 40, "baseline_durable": True, "receipt_offset": 40, "eligibility": [], "ready": True, "status": "X"} | x for _ in (0,))[0].values()
    states = spark.createDataFrame([tuple(state(10, 0)), tuple(state(11, 0)), tuple(state(10, 1, baseline_offset=55, receipt_offset=55, baseline_durable=False, ready=False, eligibility=["CROSSED", "LATE"])), tuple(state(11, 1, receipt_offset=41)), tuple(state(11, 1, receipt_offset=41))], fields)
    rows = qualification.token_rows(desired, owners, held, nodes, states, lanes)
    got = {(r["token"], r["plant"]): (r["qualified"], r["reasons"]) for r in rows.collect()}
    assert got == {
        (10, 0): (True, []), (11, 0): (True, []), (10, 1): (False, ["LATE", "CAPTURE_PENDING_DURABLE", "CROSSED", "X"]), (11, 1): (False, ["LATE", "DUPLICATE_ACTIVE_STATE", "BASELINE_DURABILITY_EVIDENCE_INVALID", "READY_EVIDENCE_CONTRADICTION"]),
        (20, 0): (False, ["HELD", "DESIRED_UNASSIGNED", "NO_CURRENT_ACTIVE_ROUTE"]), (20, 1): (False, ["HELD", "DESIRED_UNASSIGNED", "NO_CURRENT_ACTIVE_ROUTE"]),
    }
    gateway = spark.createDataFrame([(1, True, [], True)], "market long, ready boolean, reasons array<string>, qualified boolean")
    markets = qualification.market_rows(rows, gateway, lanes)
    assert {r["market"]: (r["complete"], r["missing"], r["any_complete_source"], r["both_plants"], r["gateway_qualified"]) for r in markets.collect()} == {1: ("0:0", "1:0", True, False, True), 2: ("", "0:0,1:0", False, False, False)}
    gates = {r["gate"]: r["result"] for r in qualification.gates(desired, owners, owners, held, nodes, rows, markets, lanes).collect()}
    assert len(gates) == 12 and {g for g, r in gates.items() if r == "PASS"} == {"denominator_rows_complete", "routing_plan_matches_catalog", "retired_assignments_explained", "gateway_parent_prefixes_closed"}
