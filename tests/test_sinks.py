"""Sinks are read back and checked."""

from augury.sources import sinks


def test_tape(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i % 3}", i, i % 7, f"x{i}") for i in range(50)], "stream string, offset long, market long, frame string")
    receipt = {r["stream"]: (r["first"], r["last"], r["n"]) for r in sinks.write_tape(rows, str(tmp_path / "tape")).collect()}
    assert receipt == {"s0": (0, 48, 17), "s1": (1, 49, 17), "s2": (2, 47, 16)}
    assert sorted(p.name for p in (tmp_path / "tape").glob("bucket=*"))


def test_observations(spark, tmp_path):
    rows = spark.createDataFrame([(i, "a", "same" if i % 2 else f"own {i}") for i in range(20)] + [(20, "a", None), (10_000, "b", "same")], "position long, source string, raw string")
    got = {r["bundle"]: r for r in sinks.write_observations(rows, str(tmp_path / "o")).collect()}
    assert got[0]["occurrences"] == 21 and got[0]["saved_bytes"] == 4 * 9 and got[1]["saved_bytes"] == 0
    assert spark.read.parquet(str(tmp_path / "o/payloads")).count() == 1 + 10 + 1 + 1
