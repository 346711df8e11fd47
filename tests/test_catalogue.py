"""The catalogue's fold against a walk over all events in one order, in a batch and as a stream that restarts."""

import numpy as np
import pytest

from augury.operators import catalogue
from augury.operators.graphs import connected
from augury.streaming import jobs

EVENTS = "market long, seq long, action string, identity string, body string, assets array<string>, source string"


def walked(rows):
    """Changes by (market, seq), and states, with all owners of assets in one dictionary."""
    state, held, owner, changes, revision = {}, {}, {}, {}, {}
    for market, seq, action, identity, body, assets, source in rows:
        s, to, change = state.get(market), None, None
        if action == "RESOLVE":
            to, change = ("TERMINAL", "TERMINAL") if s != "TERMINAL" else (None, None)
        elif action == "NEW":
            to, change = ("PENDING_VALIDATION", "PENDING_VALIDATION") if s is None else (None, None)
        elif action == "EXCLUDE":
            to, change = ("EXCLUDED_SCOPE", "SCOPE_EXCLUDED") if s in ("PENDING_VALIDATION", "ELIGIBLE", "QUARANTINED") else (None, None)
        elif s in ("TERMINAL", "QUARANTINED") or (s == "EXCLUDED_SCOPE" and source != catalogue.REVALIDATED):
            pass
        elif market in held and held[market][0] != identity:
            to, change = "QUARANTINED", "IDENTITY_QUARANTINED"
        elif held.get(market) == (identity, body) and s == "ELIGIBLE":
            pass
        else:
            held[market] = identity, body
            if any(owner.get(a, market) != market for a in assets):
                to, change = "QUARANTINED", "TOKEN_OWNERSHIP_CONFLICT"
            else:
                to, change = "ELIGIBLE", "UPSERT"
                for a in assets:
                    owner.setdefault(a, market)
        if change:
            state[market], revision[market] = to, revision.get(market, 0) + 1
            changes[market, seq] = to, change, revision[market]
    return changes, {m: (s, *held.get(m, (None, None)), revision[m]) for m, s in state.items()}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = []
    for seq in range(900):
        market = int(rng.integers(0, 60))
        action = str(rng.choice(["UPSERT", "UPSERT", "UPSERT", "EXCLUDE", "NEW", "RESOLVE"], p=[0.3, 0.3, 0.25, 0.08, 0.05, 0.02]))
        identity = str(rng.choice(["x", "y"], p=[0.95, 0.05]))
        # Most entries have assets of their own; chains of entries share one with the next.
        assets = [f"a{market}", f"b{market // 2 if market < 20 else market}", *([f"c{(market + 1) // 2}"] if 10 <= market < 20 else [])]
        out.append((market, seq, action, identity, identity + str(rng.integers(0, 3)), assets, str(rng.choice([catalogue.REVALIDATED, "SCAN"]))))
    return [*out, (100, 900, "UPSERT", "x", "x1", None, None), (101, 901, "UPSERT", "x", "x1", [], "SCAN"), (102, 902, "EXCLUDE", None, None, None, None)]


def shown(changes):
    return {(r["market"], r["seq"]): (r["state"], r["change"], r["revision"]) for r in changes.collect()}


def states(entries):
    return {r["market"]: (r["state"], r["identity"], r["body"], r["revision"]) for r in entries.collect()}


def test_fold_equals_a_walk_in_order(spark, rows):
    want, ends = walked([(*r[:5], r[5] or [], r[6]) for r in rows])
    entries, changes = catalogue.fold(spark.createDataFrame(rows, EVENTS).repartition(5))
    assert shown(changes) == want and states(entries) == ends
    kinds = [c for _, c, _ in want.values()]
    assert min(kinds.count(k) for k in ("UPSERT", "TOKEN_OWNERSHIP_CONFLICT", "IDENTITY_QUARANTINED", "TERMINAL", "SCOPE_EXCLUDED")) > 2
    empty = catalogue.fold(spark.createDataFrame([], EVENTS))
    assert empty[0].count() == 0 and empty[1].count() == 0


def test_another_body_of_the_same_identity_is_a_change(spark):
    rows = [(1, 1, "UPSERT", "i", "b1", ["a"], "SCAN"), (1, 2, "UPSERT", "i", "b2", ["a"], "SCAN"), (1, 3, "UPSERT", "i", "b2", ["a"], "SCAN"), (1, 4, "UPSERT", "j", "b2", ["a"], "SCAN")]
    _, changes = catalogue.fold(spark.createDataFrame(rows, EVENTS))
    assert shown(changes) == {(1, 1): ("ELIGIBLE", "UPSERT", 1), (1, 2): ("ELIGIBLE", "UPSERT", 2), (1, 4): ("QUARANTINED", "IDENTITY_QUARANTINED", 3)}


def test_stream_continues_after_a_restart(spark, rows, tmp_path):
    folder = str(tmp_path)
    whole = spark.createDataFrame(rows, EVENTS)
    want, ends = walked([(*r[:5], r[5] or [], r[6]) for r in rows])
    jobs.write_in_order(whole.where("seq < 400"), "seq", f"{folder}/events", 2)
    jobs.catalog_stream(jobs.file_stream(spark, f"{folder}/events", 2), folder)
    jobs.write_in_order(whole.where("seq >= 400"), "seq", f"{folder}/events", 3)
    entries, changes = jobs.catalog_stream(jobs.file_stream(spark, f"{folder}/events", 2), folder)
    found = spark.read.schema(catalogue.CHANGE + ", batch int").parquet(changes)
    assert shown(found) == want and found.count() == len(want) and found.select("batch").distinct().count() >= 5
    assert states(jobs.last_entries(spark, entries)) == ends


def test_connected(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (None, 3)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up} and connected(spark.createDataFrame([], "a long, b long")).count() == 0
