"""Rules that the given tables do not exercise."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from augury.functions import hexes
from augury.operators import book, fills, oracle, prices, tables
from augury.sources import fixtures as fx

LOG = "address string, topic0 string, topic1 string, topic2 string, topic3 string, n_topics int, data string, tx_hash string, log_index long, block_number long"


def word(x):
    return f"{x:064x}"


def log(words, topic=fx.LEGACY_TOPIC, address=fx.LEGACY[0], topics=4):
    return (address, topic, "0x1", "0x" + word(2**160 + 5), "0x6", topics, "0x" + "".join(map(word, words)), "0xab", 1, 2)


def test_decode_both_layouts(spark):
    rows = [log([0, 77, 2_000_000, 4_000_000, 1]), log([77, 0, 4_000_000, 2_000_000, 1]), *[log([1, 88, 9, 10, 7, 9, 10], fx.CURRENT_TOPIC, a) for a in fx.CURRENT], log([0, 2**255, 1, 3, 0])]
    got, bad = fills.decode_fills(spark.createDataFrame(rows, LOG))
    got = sorted(map(tuple, got.select("side", "token_id", F.col("price").cast("string"), F.col("size").cast("string"), "taker", "maker").collect()))
    assert bad.count() == 0 and len(got) == 6
    assert got[0][:4] == ("BUY", word(77), "0.5000000000", "4.0000000000") and got[0][4:] == ("0x" + "6".zfill(40), "0x" + "5".zfill(40))
    assert got[1][:3] == ("BUY", word(2**255), "0.3333333333")
    assert ("SELL", word(77), "0.5000000000", "4.0000000000") in [g[:4] for g in got]
    assert [g[:3] for g in got[-1:]] == [("SELL", word(88), "1.1111111111")] or ("SELL", word(88), "1.1111111111") in [g[:3] for g in got]


def test_decode_rejects(spark):
    rows = [
        log([0, 77, 1, 1, 1], topics=3), log([0, 77, 1, 1, 1], fx.CURRENT_TOPIC), log([0, 77, 1, 1]), log([1, 77, 1, 1, 1]), log([0, 77, 1, 0, 1]), log([0, 77, 2**200, 1, 1]),
        (*log([0, 77, 1, 1, 1])[:6], "0xzz", "0xab", 1, 2), (None,) * 6 + (None, None, None, None),
    ]
    good, bad = fills.decode_fills(spark.createDataFrame(rows, LOG))
    assert good.count() == 0
    assert sorted(r["reason"] or "" for r in bad.collect()) == sorted(["four topics required", "unknown topic and address", "wrong number of words", "invalid side or asset", "token amount must be positive", "amount is too wide", "data is not words", "unknown topic and address"])


def test_ratio_rounds_down_exactly(spark):
    pairs = [(1, 3), (2, 3), (10**20, 7), (123_456_789, 10**12), (5, 5), (999, 1000), (10**9 - 1, 10**9)]
    frame = spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "a string, b string").select(F.col("a").cast("decimal(38,0)"), F.col("b").cast("decimal(38,0)"))
    for r in fills.with_ratio(frame.where("a < 1e12"), "x", "a", "b").collect():
        assert int(r["x"].scaleb(10)) == int(r["a"]) * 10**10 // int(r["b"])


def test_hex_values(spark):
    values = [0, 1, 2**63 - 1, 2**63, 2**64, 10**37, 2**126, 2**127, 2**255]
    frame = spark.createDataFrame([(word(v),) for v in values], "h string")
    for v, r in zip(values, frame.select(hexes.unsigned(F.col("h")).alias("u"), hexes.small(F.col("h")).alias("s")).collect()):
        assert r["s"] == (v if v < 2**63 else None) and (r["u"] == v if v < 5 * 2**124 else r["u"] is None)


@pytest.mark.parametrize("legs", [[], [1_000_000], [333_333, 666_667], [1, 1, 1, 1, 1], [999_999] * 50, [500_000, 0, 7], list(range(900_001, 900_051))])
def test_combo_payout_is_exact(spark, legs):
    down = up = 10**36
    for n in legs:
        down, up = down * n // 10**6, -(-up * n // 10**6)
    frame = spark.createDataFrame([(legs,)], "legs array<long>")
    p = frame.select(oracle.combo_payout(F.col("legs")).alias("p")).first()["p"]
    assert [int(p[k]["hi"]) * 10**18 + int(p[k]["lo"]) for k in ("down", "up")] == [down, up]
    assert Fraction(down, 10**36) <= Fraction(up, 10**36)


def test_payout_vectors(spark):
    texts = ["[1, 0]", "[0,0]", "[1]", "[01,2]", "[1,-2]", "[1,2,3]", "", None, "[1,x]", "[" + ",".join("1" * 256) + "]", "[" + ",".join("1" * 257) + "]"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(oracle.payout_vector(F.col("t"))).collect()]
    assert [None if g is None else len(g) for g in got] == [2, None, None, None, None, 3, None, None, None, 256, None]


def events(spark, rows):
    return spark.createDataFrame(rows, "pos long, market long, asset long, kind string, levels array<struct<asset: long, side: string, price: long, size: long>>")


def test_book_rules(spark):
    rows = events(spark, [
        (1, 1, None, "CHANGE", [(1, "BUY", 40, 5)]),  # before any baseline
        (2, 1, 1, "SNAPSHOT", [(1, "BUY", 50, 10), (1, "SELL", 60, 4)]),
        (3, 1, None, "CHANGE", [(1, "BUY", 51, 7), (1, "BUY", 51, 0)]),  # same level twice: the last wins
        (4, 1, None, "CHANGE", [(1, "BUY", 52, 7), (2, "BUY", 10, 1)]),  # touches an asset without a book
        (5, 1, None, "CHANGE", [(1, "BUY", 53, 7), (1, "BUY", 101, 1)]),  # one bad level rejects the group
        (6, 2, 9, "SNAPSHOT", []), (7, 2, None, "CHANGE", [(9, "SELL", 5, 5)]),  # an empty book is legal
        (8, 1, 1, "SNAPSHOT", [(1, "BUY", 1, 1), (1, "BUY", 1, 2)]),  # repeats a price
        (9, 3, None, "RESET", [(1, "BUY", 1, 1)]), (10, 3, None, "GAP", []), (11, 3, None, "CHANGE", [(1, "BUY", 2, 2)]),
        (12, 4, 1, "SNAPSHOT", [(2, "BUY", 9, 9)]),
    ])
    levels, bad = book.book_levels(rows)
    assert {(r["pos"], r["reason"]) for r in bad.collect()} == {(5, "invalid level"), (8, "duplicate snapshot price")}
    applied = book.applied(levels)
    got = {tuple(r) for r in book.book_at_cut(applied.where("market < 4"), 100).collect()}
    assert got == {(1, 1, "BUY", 50, 10, True), (1, 1, "SELL", 60, 4, True), (2, 9, "SELL", 5, 5, True), (3, 1, "BUY", 1, 1, False)}
    assert {tuple(r) for r in book.bbo(book.book_at_cut(applied, 100)).where("market = 1").collect()} == {(1, 1, 50, 60, 1, 1, False)}
    saved, none = book.checkpoint(applied.where("market < 4"), 3)
    assert [r["market"] for r in none.collect()] == []
    assert {tuple(r) for r in book.resume(applied.where("market < 4"), saved, 3, 100).collect()} == {g[:5] for g in got}


def test_merge_rules(spark):
    base = spark.createDataFrame([(1, "a", 5, 5, 1, True), (2, "b", 1, 1, 1, None)], "k long, t string, lo long, hi long, n long, f boolean")
    delta = spark.createDataFrame([(2, "", 0, 9, 4, True), (3, "c", 7, 7, 7, False), (None, "x", 1, 1, 1, False)], base.schema)
    got = tables.merge_table(base, delta, ["k"], {"t": "coalesce", "lo": "least", "hi": "greatest", "n": "sum", "f": "or"})
    assert {tuple(r) for r in got.collect()} == {(1, "a", 5, 5, 1, True), (2, "b", 0, 9, 5, True), (3, "c", 7, 7, 7, False), (None, "x", 1, 1, 1, False)}


def test_compare_and_prefix(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (3, "z"), (None, None)], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (2, "Y"), (4, "w"), (None, None)], "k long, v string")
    got = {(r["k"], r["status"]) for r in tables.compare_tables(a, b, ["k"], ["v"]).collect()}
    assert got == {(1, "same"), (2, "mismatched"), (3, "missing"), (4, "extra"), (None, "same")}
    ranges = spark.createDataFrame([("s", 1, 9), ("s", 11, 12), ("t", 1, 5), ("t", 4, 8)], "s string, a long, z long")
    assert {tuple(r) for r in tables.contiguous_prefix(ranges, ["s"], "a", "z").collect()} == {("s", 9, 2, 1, 0, 2), ("t", 8, 1, 0, 1, 0)}


def test_price_reasons(spark):
    rows = [(1, 0, 5, 6, 7, 1, 1, "feed"), (2, 0, 9, 6, 7, 1, 1, "feed"), (3, 0, 5, 8, 7, 1, 1, "feed"), (4, 0, 5, 6, 7, 1, 2, "feed"), (5, 0, 5, 6, 7, 1, 1, None)]
    frame = spark.createDataFrame(rows, "id long, asset long, observed_ms long, published_ms long, received_ms long, price long, exact long, feed string")
    good, bad = prices.valid_prices(frame)
    assert [r["id"] for r in good.collect()] == [1]
    assert {(r["id"], r["reason"]) for r in bad.collect()} == {(2, "published before observed"), (3, "received before published"), (4, "inexact"), (5, "other feed")}
