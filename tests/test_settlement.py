"""Golden inventory of settlement states."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from augury.functions import hexes
from augury.operators import settlement

NOW = datetime(2026, 1, 3)


def inventory(spark):
    hex64 = lambda n: "0x" + f"{n:064x}"
    markets = {n: [n, "canonical_gamma", hex64(n), False, True, datetime(2020, 1, 1)] for n in range(1, 18)}
    markets[3][3:] = [True, False, None]
    markets[5][1:3] = ["official_combo", "0x03" + "0" * 60]
    markets[6][2] = "0xlegacy"
    tokens = [(n, str(n * 100 + slot), slot, f"position_{slot}", m[2]) for n, m in markets.items() if n != 9 for slot in (0, 1)]
    payouts = dict.fromkeys((1, 9, 10, 11), "[1,0]") | {2: "[7,7]", 7: "[0,0]", 8: "broken JSON", 12: "[-1,2]", 13: "[true,0]", 14: "[1e0,0]", 15: "[01,0]", 16: f"[{2**256},0]", 17: f"[{2**256 - 1},1]"}
    at = datetime(2026, 1, 1)
    events = [(n, markets[n][2], None, "settle", settlement.CONDITIONS, "0x" + "e" * 40, "0x" + "f" * 64, 100, 3, hex64(n), None if n == 10 else at, p) for n, p in payouts.items()]
    events.append((111, markets[11][2], None, "settle", settlement.CONDITIONS, "0x" + "e" * 40, "0x" + "f" * 64, 101, 3, "0x" + "a" * 64, at, "[0,1]"))
    events.append((104, markets[4][2], 4, "settle", settlement.ADJUDICATORS[2], "0x" + "e" * 40, "0x" + "f" * 64, 99, 2, "0x" + "b" * 64, at, "5"))
    return (
        spark.createDataFrame([tuple(m) for m in markets.values()], "id long, identity_kind string, condition_id string, active boolean, closed boolean, end_date timestamp"),
        spark.createDataFrame(tokens, "market_id long, token_id string, outcome_index int, outcome string, condition_id string"),
        spark.createDataFrame(events, "id long, condition_id string, market_id long, event_status string, source_oracle string, source_adapter string, adapter_question_id string, block_number long, log_index long, tx_hash string, event_time timestamp, payout string"),
    )


def test_readiness_of_all_markets(spark):
    evidence = settlement.settlement_evidence(*inventory(spark), F.lit(NOW))
    got = {r["market_id"]: r for r in evidence.collect()}
    want = {1: "READY", 2: "READY", 3: "PENDING", 4: "MISSING_CTF_SETTLEMENT", 5: "MISSING_COMBO_PREPARATION", 6: "UNSUPPORTED_MARKET_IDENTITY", 9: "TOKEN_MAPPING_CONFLICT", 10: "INCOMPLETE_CTF_PROVENANCE", 11: "CONFLICTING_CTF_SETTLEMENTS"}
    assert {n: r["readiness"] for n, r in got.items()} == want | dict.fromkeys((7, 8, 12, 13, 14, 15, 16, 17), "INVALID_CTF_PAYOUT")
    assert [(p["token_id"], p["numerator"], p["denominator"]) for p in got[2]["payouts"]] == [("200", "7", "14"), ("201", "7", "14")]
    assert got[3]["payouts"] is None and got[4]["uma_settles"] == 1
    assert sum(r["markets"] for r in settlement.coverage_summary(evidence).collect()) == 17


@pytest.mark.parametrize("numbers", [["1", "0"], ["9" * 78, "1"], [str(2**256 - 1)] * 256, ["0", "0"], [str(10**20), str(10**40), str(10**60)]])
def test_exact_totals(spark, numbers):
    got = spark.createDataFrame([(numbers,)], "x array<string>").select(settlement.total(F.col("x"))).first()[0]
    assert int(got) == sum(map(int, numbers)) and str(int(got)) == got


def test_native_modules(spark):
    a, b = settlement.MODULES
    good = settlement.MODULES[a][1]
    tx, at = "0x" + "1" * 64, datetime(2026, 1, 1)
    c = lambda n, k=1: f"0x0{k}" + f"{n:060x}"
    rows = [(1, a, c(1), "[1000000, 0]", tx, at), (2, a, c(2), "[1,2]", tx, at), (3, a, c(3), "[0,1000000]", None, at), (4, a, c(4), "[0,1000000]", tx, at), (5, a, c(4), "[0,1000000]", tx, at), (6, b, c(5, 2), "[500000,500000]", tx, at), (7, b, c(6, 1), "[0,1000000]", tx, at)]
    events = spark.createDataFrame([(i, m, x, "ConditionResolved", p, t, 10, i, w) for i, m, x, p, t, w in rows], "id long, module_address string, condition_id string, event_name string, payouts string, tx_hash string, block_number long, log_index long, event_time timestamp")
    seen = "module_address string, implementation string, block_number long, log_index long"
    epochs = settlement.module_epochs(spark.createDataFrame([(a, good.upper().replace("0X", "0x"), 5, 0)], seen), spark.createDataFrame([(a, "0xother", 5, 9), (b, "0xnew", 7, 1), (a, "0xold", 1, 1)], seen))
    got = {r["condition_id"]: r["module_readiness"] for r in settlement.native_results(events, epochs).collect()}
    assert got == {c(1): "READY", c(2): "INVALID_MODULE_PAYOUT", c(3): "INCOMPLETE_MODULE_PROVENANCE", c(4): "CONFLICTING_MODULE_SETTLEMENTS", c(5, 2): "MODULE_IMPLEMENTATION_UNSUPPORTED"}


def test_combinations(spark):
    leg = lambda m, n, o: f"{m:02x}{n:060x}0{o}"
    c = lambda n: "0x03" + f"{n:060x}"
    a, b = leg(1, 1, 0), leg(1, 2, 1)
    rows = [(1, c(1), [a, b], 5, 1), (2, c(2), [a, leg(1, 3, 0)], 5, 2), (3, c(3), [a, leg(1, 9, 0)], 5, 3), (4, c(4), [b, a], 5, 4), (5, c(5), [a, b], 5, 5), (6, c(5), [a], 6, 6), (7, c(6), [leg(1, 3, 0), leg(1, 9, 0)], 5, 7)]
    prepared = spark.createDataFrame(rows, "id long, condition_id string, legs array<string>, block_number long, log_index long")
    native = spark.createDataFrame([("0x" + x[:62], "READY", p, "1000000") for x, p in ((a, ["333333", "666667"]), (b, ["1", "999999"]), (leg(1, 3, 0), ["0", "1000000"]))], "condition_id string, module_readiness string, module_numerators array<string>, module_denominator string")
    epochs = spark.createDataFrame([settlement.COMBO], "module_address string, implementation string")
    got = {r["condition_id"]: r for r in settlement.combo_results(prepared, native, epochs).collect()}
    assert {k: r["module_readiness"] for k, r in got.items()} == {c(1): "READY", c(2): "READY", c(3): "MISSING_COMBO_LEG_RESULT", c(4): "INVALID_COMBO_PREPARATION", c(5): "CONFLICTING_COMBO_PREPARATION", c(6): "READY"}
    down = 10**36 * 333333 // 10**6 * 999999 // 10**6
    assert [int(x) for x in got[c(1)]["module_numerators"]] == [down, 10**36 - down]
    assert got[c(2)]["module_numerators"] == got[c(6)]["module_numerators"] == ["0", str(10**36)]
    none = settlement.combo_results(prepared, native, epochs.limit(0)).where(F.col("condition_id") == c(1)).first()
    assert none["module_readiness"] == "MODULE_IMPLEMENTATION_UNVERIFIED"


def test_amounts(spark):
    evidence = settlement.settlement_evidence(*inventory(spark), F.lit(NOW))
    held = spark.createDataFrame([(2, "200", 15), (1, "101", 5), (2, "999", 1), (3, "300", 1), (99, "1", 1)], "market_id long, token_id string, amount long")
    got = {(r["market_id"], r["token_id"]): (r["payout"], r["reason"]) for r in settlement.payout_for_amount(evidence, held).collect()}
    assert got == {(2, "200"): ("7", None), (1, "101"): ("0", None), (2, "999"): (None, "unknown token"), (3, "300"): (None, "PENDING"), (99, "1"): (None, "unknown market")}


def test_amounts_are_exact_in_256_bits(spark):
    """Halves, thirds and combinations of the unit 10^36 against Python's integers."""
    unit, big = 10**36, 2**256 - 1
    paid = {1: (1, 2, "CTF_CONDITION_RESOLUTION", False), 2: (big, big, "CTF_CONDITION_RESOLUTION", False), 3: (unit // 3, unit, "COMBO_LEG_RESOLUTIONS", False), 4: (0, unit, "COMBO_LEG_RESOLUTIONS", True), 5: (3, 2, "CTF_CONDITION_RESOLUTION", False)}
    kind = "market_id long, readiness string, payouts array<struct<token_id string, outcome_index int, outcome string, numerator string, denominator string>>, settlement_basis string, terminal_zero boolean"
    rows = [(m, "READY", [("a", 0, "", str(n), str(d)), ("b", 1, "", str(max(d - n, 0)), str(d)), ("twice", 0, "", "1", str(d)), ("twice", 1, "", "1", str(d))], basis, zero) for m, (n, d, basis, zero) in paid.items()]
    held = [(m, t, str(x)) for m in paid for t in ("a", "b", "twice") for x in (0, 7, 10**36 // 2, 10**41 + 1, big)] + [(1, "a", str(2**256)), (1, "a", "-1"), (1, "a", None)]
    got = settlement.payout_for_amount(spark.createDataFrame(rows, kind), spark.createDataFrame(held, "market_id long, token_id string, amount string")).collect()
    assert len(got) == len(held)
    for r in got:
        n, d, basis, zero = paid[r["market_id"]]
        combo, x = basis.startswith("COMBO"), r["amount"]
        if r["token_id"] == "twice":
            assert r["reason"] == "unknown token"
        elif x is None or not x.isdigit() or int(x) > big:
            assert r["reason"] == "amount is no 256-bit number"
        elif r["market_id"] == 5 and r["token_id"] == "a":
            assert r["reason"] == "invalid payout fraction"
        elif combo and zero:
            assert r["payout"] == (x if r["token_id"] == "b" else "0")
        else:
            own = n if r["token_id"] == "a" else max(d - n, 0)
            checked = int(x) * (d - own if combo and r["token_id"] == "b" else own)
            assert (r["payout"], r["reason"]) == ((None, "product is over 256 bits") if checked > big else (str(int(x) * own // d), None))


def test_words_and_decimal_text(spark):
    import random

    random.seed(4)
    values = [0, 1, 255, 2**64, 2**256 - 1, *[random.getrandbits(random.choice([20, 90, 200, 256])) for _ in range(100)]]
    rows = [(str(v), f"{v:064x}") for v in values] + [(str(2**256), None), ("x", None), ("-1", None)]
    frame = spark.createDataFrame(rows, "text string, word string").select("*", hexes.from_decimal(F.col("text")).alias("a"), hexes.to_decimal(F.col("word")).alias("b"))
    assert all(r["a"] == r["word"] and r["b"] == (r["text"] if r["word"] else None) for r in frame.collect())
