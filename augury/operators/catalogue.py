"""States of catalogue entries, and who owns their assets, folded event by event.

Events: market, seq (unique, in order), action (UPSERT, NEW, EXCLUDE, RESOLVE), identity (what may not change), body (all
of an entry), assets and source. Entries that share assets decide about each other in the order of their events, so each
group of connected entries is folded by itself, whatever its number of entries; groups are dealt to tasks and only the states of the one
at hand are in memory. A group is as large as its shared assets make it, and inherently one sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.operators.graphs import connected
from augury.sources.shared import written

REVALIDATED = "GAMMA_KNOWN_ID_REVALIDATION"
#: What is known of an entry after its events; owned are the assets that it was the first to get.
STATE = "market long, state string, identity string, body string, revision long, owned array<string>"
CHANGE = "market long, seq long, state string, change string, revision long"


class Entry:
    """One entry: its state, identity and body, the number of its changes and the assets it owns."""

    __slots__ = ("state", "identity", "body", "revision", "owned")

    def __init__(self, state=None, identity=None, body=None, revision=0, owned=()):
        self.state, self.identity, self.body, self.revision, self.owned = state, identity, body, revision, list(owned)

    def take(self, market: int, action: str, identity: str, body: str, source: str, assets: list[str], owners: dict[str, int]) -> str | None:
        """The kind of change that an event makes, if it makes one."""
        if action == "RESOLVE":
            return self._now("TERMINAL", "TERMINAL") if self.state != "TERMINAL" else None
        if action == "NEW":
            return self._now("PENDING_VALIDATION", "PENDING_VALIDATION") if self.state is None else None
        if action == "EXCLUDE":
            return self._now("EXCLUDED_SCOPE", "SCOPE_EXCLUDED") if self.state not in (None, "TERMINAL", "EXCLUDED_SCOPE") else None
        if self.state in ("TERMINAL", "QUARANTINED") or (self.state == "EXCLUDED_SCOPE" and source != REVALIDATED):
            return None
        if self.body is not None and self.identity != identity:
            return self._now("QUARANTINED", "IDENTITY_QUARANTINED")
        if self.body == body and self.state == "ELIGIBLE":
            return None
        self.identity, self.body = identity, body
        if any(owners.get(a, market) != market for a in assets):
            return self._now("QUARANTINED", "TOKEN_OWNERSHIP_CONFLICT")
        for a in assets:
            if a not in owners:
                owners[a] = market
                self.owned.append(a)
        return self._now("ELIGIBLE", "UPSERT")

    def _now(self, state: str, change: str) -> str:
        self.state, self.revision = state, self.revision + 1
        return change


_FOLDED = ["market", "seq", "state", "change", "revision", "identity", "body", "owned"]


def _folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over rows sorted by (root, seq): a row for each change, and one (change null) for each entry of a finished group."""
    at, entries, owners = None, {}, {}

    def ended() -> list[tuple]:
        return [(m, None, e.state, None, e.revision, e.identity, e.body, e.owned) for m, e in entries.items() if e.state is not None]

    for frame in frames:
        out = []
        for root, market, seq, action, identity, body, source, assets, state, revision in zip(*(frame[c] for c in ("root", "market", "seq", "action", "identity", "body", "source", "assets", "state", "revision"))):
            if root != at:
                out += ended()
                at, entries, owners = root, {}, {}
            if action == "STATE":
                entries[market] = Entry(state, identity, body, int(revision), assets)
                owners |= {a: market for a in assets}
                continue
            entry = entries.setdefault(market, Entry())
            change = entry.take(market, action, identity, body, source, list(assets) if assets is not None else [], owners)
            if change:
                out.append((market, seq, entry.state, change, entry.revision, None, None, None))
        yield _frame(out)
    yield _frame(ended())


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_FOLDED).astype({"market": "Int64", "seq": "Int64", "revision": "Int64"})


def fold(events: DataFrame, prior: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, changes): entries that have events, with their state after them (STATE), and one row (CHANGE) for each event
    that moved an entry. prior has the entries before these events.

    UPSERT makes an entry eligible, but not a terminal or quarantined one, and an excluded one only if its source is a
    revalidation. Another identity than the entry's quarantines it; another body of the same identity is a change of its
    own; an asset that another entry owns quarantines it too. An asset belongs to the entry whose accepted
    UPSERT came first, for ever. EXCLUDE takes any entry that is there out of scope; NEW makes it pending if it is not
    there; RESOLVE is final.
    """
    blank = lambda c, t: F.lit(None).cast(t).alias(c)
    rows = events.select("market", "seq", "action", "identity", "body", "source", "assets", blank("state", "string"), blank("revision", "long"))
    known = None
    if prior is not None:
        known = prior.select("market", F.lit(-1).cast("long").alias("seq"), F.lit("STATE").alias("action"), "identity", "body", blank("source", "string"), F.col("owned").alias("assets"), "state", "revision")
    claims = rows.where("action = 'UPSERT'").select("market", F.explode("assets").alias("asset"))
    claims = claims if known is None else claims.unionByName(known.select("market", F.explode("assets").alias("asset")))
    first = claims.groupBy("asset").agg(F.min("market").alias("a"), F.max("market").alias("z")).where("a <> z")
    roots = connected(claims.join(first.select("asset", "a"), "asset").select("a", F.col("market").alias("b")))
    rooted = lambda df: df.join(roots.withColumnRenamed("node", "market"), "market", "left").withColumn("root", F.coalesce("root", "market"))
    both = rooted(rows)
    if known is not None:
        both = both.unionByName(rooted(known).join(both.select("root").distinct(), "root", "left_semi").select(*both.columns))
    dealt = both.repartition("root").sortWithinPartitions("root", "seq")
    folded = written(dealt.mapInPandas(_folded, CHANGE + ", identity string, body string, owned array<string>"), "catalogue")
    entries = folded.where("change is null").select("market", "state", "identity", "body", "revision", "owned")
    return entries, folded.where("change is not null").select("market", "seq", "state", "change", "revision")
