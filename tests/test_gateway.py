"""Stateful gateway streams over several micro-batches, a restart in the middle, and their rules."""

import pandas as pd

from augury.streaming import gateway, jobs

RECORDS = "plant long, seq long, kind string, session string, stream string, offset long, bytes long, digest string"
PROBES = "id long, connection long, session long, kind string, ms long"


def test_identities_are_remembered_within_bounds(spark, tmp_path):
    record = lambda seq, offset, digest="d", session="s1", stream="g1", size=10, plant=1: (plant, seq, "RECORD", session, stream, offset, size, digest)
    rows = [record(0, 1), (1, 1, "SESSION", "s1", "g1", 0, 0, "")]
    rows += [record(2, 1), record(3, 1), record(4, 1, "other"), record(5, 2), record(6, 3), record(7, 4), record(8, 1), record(9, 4), record(10, 5, stream="g0"), record(11, 5, session="s0")]
    rows += [record(12, 6, size=35), record(13, 1), (1, 14, "SESSION", "s2", "g2", 0, 0, ""), record(15, 4, session="s1"), record(16, 4, session="s2", stream="g2"), record(17, 4, session="s2", stream="g2")]
    want = ["STALE_SESSION", "SESSION", "ACCEPTED", "RETRY", "IDENTITY_CONTENT_CONFLICT", "ACCEPTED", "ACCEPTED", "ACCEPTED", "ACCEPTED", "RETRY", "RESET_REQUIRED_STREAM_GENERATION", "STALE_SESSION", "ACCEPTED", "ACCEPTED", "SESSION", "STALE_SESSION", "ACCEPTED", "RETRY"]
    folder = str(tmp_path)
    stream = lambda: gateway.accept_stream(jobs.file_stream(spark, f"{folder}/in", 1), window=3, most_bytes=40)
    for part in (rows[:7], rows[7:]):  # the second part after a restart from the checkpoint
        jobs.write_in_order(spark.createDataFrame(part, RECORDS), "seq", f"{folder}/in", 3, 1)
        jobs.drain(stream(), folder)
    got = {r["seq"]: r["status"] for r in spark.read.schema(gateway.ACCEPTED).parquet(f"{folder}/out").collect()}
    assert [got[i] for i in range(18)] == want


def test_health_expires_without_an_event(spark, tmp_path):
    ping, pong = "PING", "PONG"
    one = [(ping, 0), (pong, 1), (ping, 10), (pong, 11), (ping, 20), (pong, 21), (ping, 25), (pong, 26)]  # healthy at 21, expires at 26 + 100
    rows = [(i, 1, 0, k, ms) for i, (k, ms) in enumerate(one)]
    rows += [(20 + i, 2, 0, k, ms) for i, (k, ms) in enumerate([(ping, 0), (pong, 1), (ping, 2), (pong, 3), (ping, 4), (pong, 5), (ping, 6), (pong, 70), (ping, 80), (pong, 81)])]  # a probe without answer by 6 + 50
    rows += [(40 + i, 3, s, k, ms) for i, (s, k, ms) in enumerate([(0, ping, 0), (0, pong, 1), (0, ping, 2), (0, pong, 3), (0, ping, 4), (0, pong, 5), (0, ping, 6), (0, ping, 7), (0, pong, 8), (1, ping, 20), (1, pong, 21)])]  # overlapping pings
    rows += [(90, 9, 0, ping, 500)]
    rows = [(i, c, s, k, ms + 1000) for i, c, s, k, ms in rows]  # rows at the epoch are late for a stream
    table = spark.createDataFrame(rows, PROBES)
    want = {(1, 0, 21, True, "GOOD_PROBES"), (1, 0, 126, False, "PROOF_EXPIRED"), (2, 0, 5, True, "GOOD_PROBES"), (2, 0, 56, False, "DEADLINE"), (3, 0, 5, True, "GOOD_PROBES"), (3, 0, 7, False, "AMBIGUOUS")}
    want = {(c, s, ms + 1000, *rest) for c, s, ms, *rest in want}
    assert {tuple(r) for r in gateway.health_changes(table, 1500, 50, 100).collect()} == want
    folder = str(tmp_path)
    jobs.write_in_order(table, "ms", f"{folder}/in", 25, 1)
    jobs.drain(gateway.health_stream(jobs.file_stream(spark, f"{folder}/in", 2), 50, 100), folder)
    assert {tuple(r) for r in spark.read.schema(gateway.HEALTH).parquet(f"{folder}/out").collect()} == want


def test_soak_windows_pass_over_midnight(spark, tmp_path):
    hour = 3_600_000
    rows = [(1, i, i * hour or 1, 7) for i in range(30)] + [(1, 40, 60 * hour, 7), (1, 41, 61 * hour, 8), (2, 50, hour, 1), (2, 51, 30 * hour, 1), (3, 60, 200 * hour, 1)]
    folder = str(tmp_path)
    jobs.write_in_order(spark.createDataFrame(rows, "key long, id long, ms long, fingerprint long"), "ms", f"{folder}/in", 5, 1)
    jobs.drain(gateway.soak_stream(jobs.file_stream(spark, f"{folder}/in", 1), 2 * hour), folder)
    got = {(r["key"], r["from"] // hour, r["to"] // hour, r["samples"], r["closed_by"], r["verdict"]) for r in spark.read.schema(gateway.SOAK).parquet(f"{folder}/out").collect()}
    assert got == {(1, 0, 29, 30, "GAP", "PASS"), (1, 60, 60, 1, "FINGERPRINT", "NOT_COMPLETE"), (1, 61, 61, 1, "GAP", "NOT_COMPLETE"), (2, 1, 1, 1, "GAP", "NOT_COMPLETE"), (2, 30, 30, 1, "GAP", "NOT_COMPLETE")}


def test_accepted_records_read_their_state_once_a_batch():
    """Calls to the state of a plant do not grow with its records."""

    class State:
        def __init__(self):
            self.value, self.calls = None, 0

        def _counted(name):
            def call(self, *args):
                self.calls += 1
                return getattr(self, f"_{name}")(*args)

            return call

        exists, get, update, put, clear = map(_counted, ("exists", "get", "update", "put", "clear"))
        _exists = lambda self: self.value is not None
        _get = lambda self: self.value if self.value is not None else iter(())

        def _update(self, value):
            self.value = value

        _put = _update

        def _clear(self):
            self.value = None

    states = []

    class Handle:
        def __getattr__(self, name):  # any kind of state
            return lambda *args: states.append(State()) or states[-1]

    process = gateway._Accept(50, 10**6)
    process.init(Handle())
    rows = [(1, 0, "SESSION", "s", "g", 0, 0, "")] + [(1, i, "RECORD", "s", "g", i - i % 5, 10, "d") for i in range(1, 2_000)]
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORDS.split(", ")])
    found = []
    for part in (frame[:1_000], frame[1_000:]):
        found += pd.concat(process.handleInputRows((1,), iter([part]), None))["status"].tolist()
    assert found[:8] == ["SESSION", "ACCEPTED", "RETRY", "RETRY", "RETRY", "ACCEPTED", "RETRY", "RETRY"] and found[1_000:1_002] == ["ACCEPTED", "RETRY"]
    assert sum(s.calls for s in states) <= 10
