"""Plans and files that grow no faster than the input."""

from fractions import Fraction

import numpy as np
import pytest

from pyspark.sql import functions as F

from augury.functions import hexes
from augury.operators import book, fills, oracle, settlement
from augury.plans import fill_queries, market_queries, qualification_queries, settlement_queries
from augury.sources import fixtures as fx
from augury.sources import sinks
from augury.streaming import jobs

SMALL = "/root/testdata/sf0.001"


def test_decode_is_compiled(spark):
    plan = fills.decode_fills(fx.frame(spark, SMALL, fx.logs))[0]._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_ratio_of_short_and_long_numbers(spark):
    pairs = [(1, 3), (7, 2), (0, 5), (9 * 10**17, 10**11), (9 * 10**17, 9 * 10**12), (10**20 + 1, 10**12 + 7), (5, 10**25)]
    rows = spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "a string, b string").select(*[F.col(c).cast("decimal(38,0)").alias(c) for c in "ab"])
    got = {(int(r["a"]), int(r["b"])): Fraction(r["price"]) for r in fills.with_ratio(rows, "price", "a", "b").collect() if r["price"] is not None}
    wanted = {(a, b): Fraction(a * 10**10 // b, 10**10) for a, b in pairs}
    assert got == {k: v for k, v in wanted.items() if k in got} and len(got) >= 6


def test_words_of_any_text(spark):
    texts = ["0xAB", " 0Xab ", "f" * 64, "0x" + "1" * 70, "", None, "0x0x1"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(hexes.body(F.col("t")).alias("x")).collect()
    assert [r["x"] for r in rows] == ["ab".zfill(64), "ab".zfill(64), "f" * 64, "1" * 70, "0" * 64, "0" * 64, "0x1".zfill(64)]
    values = ["0" * 63 + "a", "0" * 48 + "8" + "0" * 15, "0" * 63 + "A", "0" * 62 + "g1", "0" * 32 + "3" + "f" * 31, "0" * 32 + "5" + "0" * 31, "1"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(hexes.unsigned(F.col("v"))).collect()]
    assert [None if v is None else int(v) for v in got] == [10, 2**63, None, None, 2**126 - 1, None, None]


def test_logs_are_decoded_once(spark):
    for name in ("safe_head", "block_windows", "block_times", "gap_merge"):
        assert not [f for f in fill_queries.QUERIES[name](spark, SMALL).inputFiles() if "lineitem" in f], name


def test_long_ranges_have_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "FILE_ROWS", 2_000)
    path = str(tmp_path / "in")
    assert jobs.write_in_order(spark.range(20_000), "id", path, 2) == 5
    seen = []
    jobs.drain(jobs.file_stream(spark, path, 5), str(tmp_path / "s"), each=lambda batch, _: seen.append(tuple(batch.agg(F.min("id"), F.max("id"), F.count("*")).first())))
    assert seen == [(0, 9_999, 10_000), (10_000, 19_999, 10_000)]
    assert jobs.write_in_order(spark.range(10), "id", str(tmp_path / "few"), 2) == 2


def test_observation_files_do_not_grow_with_bundles(spark, tmp_path):
    rows = spark.range(4_000).select(F.col("id").alias("position"), F.lit("a").alias("source"), (F.col("id") % 7).cast("string").alias("raw"))
    assert sinks.write_observations(rows, str(tmp_path / "o"), 10).count() == 400
    for kind in ("occurrences", "payloads"):
        assert len(list((tmp_path / "o" / kind).rglob("*.parquet"))) <= 4
        shared = spark.read.parquet(str(tmp_path / "o" / kind)).select("bundle", F.input_file_name().alias("f")).distinct()
        assert shared.count() == 400


def test_half_of_the_trusted_texts_train(spark, monkeypatch):
    from augury.llm import kneserney

    seen = []
    monkeypatch.setattr(kneserney, "fit", lambda trusted: seen.append(trusted.count()) or (_ for _ in ()).throw(InterruptedError))
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.lit("en").alias("lang"))
    try:
        kneserney.judged(docs, docs)
    except InterruptedError:
        pass
    assert 29_000 < seen[0] < 31_000


def test_training_texts_move_once(spark):
    from augury.llm import kneserney

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), "id").alias("text"), F.lit("en").alias("lang"))
    kneserney.judged(docs.mapInArrow(counted, docs.schema), docs.select("doc_id"))
    assert read.value == 4_000  # once to train and once to be scored


def test_fills_are_decoded_once_in_a_stream(spark, tmp_path):
    logs, owned = fx.frame(spark, SMALL, fx.logs), fills.owners(fx.frame(spark, SMALL, fx.markets), fx.frame(spark, SMALL, fx.tokens))
    logs.repartition(2).write.parquet(str(tmp_path / "logs"))
    found = jobs.fills_stream(jobs.file_stream(spark, str(tmp_path / "logs"), 1), owned, str(tmp_path / "s"))
    wanted = fills.project_fills(fills.decode_fills(logs)[0], owned)
    for got, want in zip(found, wanted):
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) != []
    assert {p.parent.name for p in (tmp_path / "s").rglob("*.parquet")} == {"batch=0", "batch=1"}
    assert len({p.parent for p in (tmp_path / "s").rglob("*.parquet")}) == 2  # one table for each batch


def test_report_computes_its_tokens_once(spark, monkeypatch):
    made = []
    one = qualification_queries.q.token_rows
    monkeypatch.setattr(qualification_queries.q, "token_rows", lambda *inputs: made.append(1) or one(*inputs))
    assert {r["table"]: r["n"] > 0 for r in qualification_queries.outputs(spark, SMALL).collect()} == dict.fromkeys(("token_state_at_cut", "market_gap_attribution", "reasons", "gates"), True)
    assert len(made) == 1


def test_long_sums_and_folds_repeat_no_step(spark):
    lists = [["1", "0"], ["9" * 77] * 256, [str(2**256 - 1), "1"], [], ["9" * 35] * 256, ["0" * 40 + "5", "1" + "0" * 40], None]
    sums = spark.createDataFrame([(x,) for x in lists], "n array<string>").select(settlement.total(F.col("n")).alias("t"))
    assert [r["t"] for r in sums.collect()] == [None if x is None else str(sum(map(int, x))) for x in lists]
    assert sums._jdf.queryExecution().analyzed().toString().count("lpad") < 5
    legs = [[1_000_000, 1], [333_333, 999_999, 7], [0, 5], [999_999] * 50]
    paid = spark.createDataFrame([(x,) for x in legs], "n array<bigint>").select(oracle.combo_payout(F.col("n").cast("array<decimal(38,0)>")).alias("p"))
    for numbers, row in zip(legs, paid.collect()):
        down = up = 10**36
        for n in numbers:
            down, up = down * n // 10**6, -(-up * n // 10**6)
        assert [int(row["p"][side]["hi"]) * 10**18 + int(row["p"][side]["lo"]) for side in ("down", "up")] == [down, up]
    assert paid._jdf.queryExecution().analyzed().toString().count("1000000") < 20


def test_settlements_and_tokens_are_not_held_whole(spark):
    plan = settlement_queries._evidence(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan  # distinct values are counted without copies of the rows
    assert plan.count("BroadcastHashJoin") <= 1  # ids of the last settlements


def test_states_are_hashed_in_tasks_of_so_many_rows(spark, monkeypatch):
    rows = market_queries._rows(spark, SMALL).cache()
    wanted = sorted(map(tuple, book.cut_hashes(rows).collect()))
    monkeypatch.setattr(book, "TASK_ROWS", rows.count() // 7)
    many = book.cut_hashes(rows)
    assert sorted(map(tuple, many.collect())) == wanted
    assert "hashpartitioning(market" in (plan := many._jdf.queryExecution().executedPlan().toString()) and ", REPARTITION_BY_NUM" in plan and "Join" not in plan
    rows.unpersist()


def test_all_trusted_texts_train_and_set_thresholds(spark, tmp_path):
    """Texts of trusted documents meet each other in the query's model, and the thresholds are those of all of them, each
    scored by a model of the other part."""
    from augury.llm import kneserney, queries

    rng = np.random.default_rng(3)
    prose = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma,", "Delta", "omega."], n))
    rows = [(i, prose(30), "en" if i % 3 else None) for i in range(60)] + [(i, prose(30), "fr") for i in range(100, 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(41, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    whole = kneserney.fit(docs.where("doc_id < 40"))
    first = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(kneserney.TRAINED * (1 << 30))
    parts = [docs.where("doc_id < 40").where(c) for c in (first, ~first)]
    models = [kneserney.fit(p) for p in parts]

    def own(text, model):
        table, alphabet = kneserney.unfolded(model), kneserney._alphabet(model["chars"])
        return -table[kneserney.codes(kneserney.symbols(text, alphabet))].astype(float).sum() / len(text)

    held = [(r["lang"], own(r["text"], other)) for p, other in zip(parts, models[::-1]) for r in p.collect()]
    assert len(held) == 40
    most = {lang: max(v for k, v in held if k == lang) for lang in ("en", None)} | {"fr": max(v for _, v in held)}
    got = queries.quality(docs, labels, keep=["doc_id", "lang"]).select("row.*", "perplexity", "threshold").collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(x[1] for x in rows if x[0] == r["doc_id"])
        assert np.log(r["perplexity"]) == pytest.approx(own(text, whole), abs=1e-4)
        assert np.log(r["threshold"]) == pytest.approx(most[r["lang"]], abs=2e-4)


def test_few_texts_without_trust_are_shuffled(spark):
    from augury.llm import kneserney

    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    ids = docs.where("doc_id % 100 = 7").select("doc_id")
    assert {r["doc_id"] for r in kneserney._of(docs, ids).collect()} == set(range(7, 20_000, 100))
    moved = kneserney._of(docs, ids.where("doc_id < 5000"))
    assert moved.count() == 50 and kneserney._of(docs, ids.limit(0)).count() == 0
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")  # the filter lies below the shuffle


def test_quality_stage_trains_on_all_trusted_texts(spark, monkeypatch, tmp_path):
    import corpus_pipeline
    from augury.llm import kneserney

    seen, fit = [], kneserney.fit
    monkeypatch.setattr(kneserney, "fit", lambda trusted: seen.append(trusted.count()) or fit(trusted.limit(0)))
    spark.range(400).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.range(500).selectExpr("id AS doc_id", "'text' AS text", "'en' AS lang")
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).count() == 500
    assert len(seen) == 3 and seen[0] + seen[1] == seen[2] == 400


def test_live_books_are_dealt_to_so_many_tasks(spark, tmp_path):
    rows = market_queries._rows(spark, SMALL).select("market", "asset", "base", "pos", "idx", "side", "price", "size").where("market < 40")
    files = jobs.write_in_order(rows, "pos", str(tmp_path / "in"), 3)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    jobs.drain(jobs.live_book_stream(jobs.file_stream(spark, str(tmp_path / "in"), files)), str(tmp_path / "s"), states=2)
    assert sorted(p.name for p in (tmp_path / "s" / "checkpoint" / "state" / "0").iterdir() if p.name.isdigit()) == ["0", "1"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
    last, wanted = {}, []
    for r in sorted(map(tuple, book.bbo_timeline(rows).collect())):
        if last.get(r[:2], (None, None)) != r[3:]:
            wanted.append(r)
        last[r[:2]] = r[3:]
    got = spark.read.schema("market long, asset long, pos long, best_bid long, best_ask long").parquet(str(tmp_path / "s" / "out"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted)) and len(wanted) > 20


def test_facts_of_a_batch_are_joined_and_written_once(spark, tmp_path, monkeypatch):
    logs, owned = fx.frame(spark, SMALL, fx.logs), fills.owners(fx.frame(spark, SMALL, fx.markets), fx.frame(spark, SMALL, fx.tokens))
    logs.repartition(1).write.parquet(str(tmp_path / "logs"))
    made, one = [], jobs.written
    for module in (jobs, fills):
        monkeypatch.setattr(module, "written", lambda df, name="table": made.append(name) or one(df, name))
    paths = jobs.facts_stream(jobs.file_stream(spark, str(tmp_path / "logs")), owned, str(tmp_path / "s"))
    assert made == ["resolved", "gaps"]
    facts, gaps = fills.project_fills(fills.decode_fills(logs)[0], owned)
    got = spark.read.parquet(paths["facts"]).select(*facts.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, facts.collect())) != []
    assert spark.read.parquet(paths["gaps"]).count() == gaps.select("token_id").distinct().count() > 0
