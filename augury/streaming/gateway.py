"""Stateful streams of a gateway: accepted records with a bounded window of identities, freshness of transports, soak windows.

State is typed and kept by key in RocksDB (transformWithState); what is due without a further event comes from timers on event
time, so that rows at or before the epoch count as late. Rows of a key must come in order from micro-batch to micro-batch; within one they are sorted.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _stateful(rows: DataFrame, keys: list[str], processor: StatefulProcessor, out: str, time: str | None = None) -> DataFrame:
    """The processor's output over a stream; with the name of a number of milliseconds, timers follow it."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if time is None:
        return rows.groupBy(*keys).transformWithStateInPandas(processor, out, "append", "none")
    marked = rows.withColumn("__at", F.timestamp_millis(time)).withWatermark("__at", "0 seconds")
    return marked.groupBy(*keys).transformWithStateInPandas(processor, out, "append", "EventTime")


def _sorted(parts: Iterator[pd.DataFrame], *by: str) -> pd.DataFrame:
    return pd.concat(list(parts)).sort_values(list(by))


ACCEPTED = "plant long, seq long, status string"


class _Accept(StatefulProcessor):
    """State of a plant: its session and stream, and the identities it remembers in the order of their arrival. They are
    read once and written once a micro-batch, not record by record: `window` bounds them."""

    def __init__(self, window: int, most_bytes: int):
        self.window, self.most_bytes = window, most_bytes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.now = handle.getValueState("now", "session string, stream string")
        self.queue = handle.getListState("queue", "stream string, offset long, bytes long, digest string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        session, stream = self.now.get() if self.now.exists() else (None, None)
        queue = deque(map(tuple, self.queue.get()))
        seen, held = {x[:2]: x[3] for x in queue}, sum(x[2] for x in queue)
        found = _sorted(rows, "seq")
        out = []
        for kind, own, of, offset, size, digest in zip(*(found[c].tolist() for c in ("kind", "session", "stream", "offset", "bytes", "digest"))):
            if kind == "SESSION":  # the new session forgets all numbers of the old one
                queue.clear()
                seen.clear()
                session, stream, held, status = own, of, 0, "SESSION"
            elif own != session:
                status = "STALE_SESSION"
            elif of != stream:
                status = "RESET_REQUIRED_STREAM_GENERATION"
            elif (place := (of, int(offset))) in seen:
                status = "RETRY" if seen[place] == digest else "IDENTITY_CONTENT_CONFLICT"
            else:
                status = "ACCEPTED"
                seen[place] = digest
                queue.append((*place, int(size), digest))
                held += int(size)
                while len(queue) > self.window or held > self.most_bytes:
                    gone = queue.popleft()
                    del seen[gone[:2]]
                    held -= gone[2]
            out.append(status)
        self.now.update((session, stream))
        if queue:
            self.queue.put(list(queue))
        else:
            self.queue.clear()
        yield pd.DataFrame({"plant": key[0], "seq": found["seq"].to_numpy(), "status": out})

    def close(self) -> None:
        pass


def accept_stream(records: DataFrame, window: int = 4096, most_bytes: int = 64 << 20) -> DataFrame:
    """What becomes of each record (plant, seq, kind, session, stream, offset, bytes, digest): SESSION, ACCEPTED, RETRY,
    IDENTITY_CONTENT_CONFLICT, STALE_SESSION or RESET_REQUIRED_STREAM_GENERATION.

    kind is SESSION or RECORD. A plant's record is a retry if its stream and offset are among the last ones accepted, of which `window`
    and most_bytes are remembered, and a conflict if its content differs; what is forgotten is accepted again. A new
    session forgets everything and names the stream that may follow.
    """
    return _stateful(records, ["plant"], _Accept(window, most_bytes), ACCEPTED)


HEALTH = "connection long, session long, ms long, healthy boolean, reason string"


class Transport:
    """Health of one connection. Times are milliseconds; `due` is when it changes without a further event."""

    FIELDS = "session long, pending long, ambiguous boolean, good long, proof long, healthy boolean"

    def __init__(self, deadline: int, age: int, needed: int, saved: tuple | None = None):
        self.deadline, self.age, self.needed = deadline, age, needed
        self.session, self.pending, self.ambiguous, self.good, self.proof, self.healthy = saved or (None, None, False, 0, None, False)

    def saved(self) -> tuple:
        return self.session, self.pending, self.ambiguous, self.good, self.proof, self.healthy

    def due(self) -> int | None:
        ends = [self.pending + self.deadline if self.pending is not None else None, self.proof + self.age if self.healthy else None]
        return min((e for e in ends if e is not None), default=None)

    def until(self, now: int) -> Iterator[tuple]:
        """What is due before a moment: a probe that was not answered in time, a proof that is too old."""
        while (at := self.due()) is not None and at < now:
            if self.pending is not None and at == self.pending + self.deadline:
                self.pending, self.good = None, 0
                yield from self._turn(at, False, "DEADLINE")
            else:
                yield from self._turn(at, False, "PROOF_EXPIRED")

    def _turn(self, at: int, healthy: bool, reason: str) -> Iterator[tuple]:
        if healthy != self.healthy:
            self.healthy = healthy
            yield self.session, at, healthy, reason

    def take(self, session: int, kind: str, ms: int) -> Iterator[tuple]:
        if session != self.session:
            if self.session is not None:
                yield from self._turn(ms, False, "NEW_SESSION")
            self.session, self.pending, self.ambiguous, self.good, self.proof = session, None, False, 0, None
        if kind == "PING":
            if self.pending is not None:  # two pongs of unknown pings cannot be told apart
                self.ambiguous, self.pending, self.good = True, None, 0
                yield from self._turn(ms, False, "AMBIGUOUS")
            elif not self.ambiguous:
                self.pending = ms
        elif self.pending is not None and not self.ambiguous:
            self.pending, self.good, self.proof = None, self.good + 1, ms
            if self.good >= self.needed:
                yield from self._turn(ms, True, "GOOD_PROBES")


class _Health(StatefulProcessor):
    def __init__(self, deadline: int, age: int, needed: int):
        self.rules = deadline, age, needed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("transport", Transport.FIELDS)

    def _kept(self, key: tuple, transport: Transport, out: list) -> Iterator[pd.DataFrame]:
        self.state.update(transport.saved())
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if (at := transport.due()) is not None:
            self.handle.registerTimer(at + 1)
        yield pd.DataFrame([(key[0], *x) for x in out], columns=["connection", "session", "ms", "healthy", "reason"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        transport, out = Transport(*self.rules, self.state.get() if self.state.exists() else None), []
        for ms, session, kind in _sorted(rows, "ms", "id")[["ms", "session", "kind"]].itertuples(index=False):
            out += transport.until(int(ms))
            out += transport.take(int(session), kind, int(ms))
        yield from self._kept(key, transport, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        transport = Transport(*self.rules, self.state.get())
        yield from self._kept(key, transport, list(transport.until(int(expiredTimerInfo.getExpiryTimeInMs()))))

    def close(self) -> None:
        pass


def health_stream(probes: DataFrame, deadline_ms: int = 2_000, age_ms: int = 30_000, needed: int = 3) -> DataFrame:
    """Changes of each connection's health from its probes (id, connection, session, kind, ms), timers included.

    A connection becomes healthy with `needed` pongs in a row, each within deadline_ms of its ping, and stops to be so when a ping
    goes without a pong for longer, when its last good pong is older than age_ms, when pings overlap (until a new
    session) or with a new session. A pong after its deadline answers nothing.
    """
    return _stateful(probes, ["connection"], _Health(deadline_ms, age_ms, needed), HEALTH, "ms")


def health_changes(probes: DataFrame, upto: int, deadline_ms: int = 2_000, age_ms: int = 30_000, needed: int = 3) -> DataFrame:
    """The same as a batch, with what is due before a moment."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        transport, out = Transport(deadline_ms, age_ms, needed), []
        for ms, session, kind in rows.sort_values(["ms", "id"])[["ms", "session", "kind"]].itertuples(index=False):
            out += transport.until(ms)
            out += transport.take(session, kind, ms)
        out += transport.until(upto)
        return pd.DataFrame([(key[0], *x) for x in out], columns=["connection", "session", "ms", "healthy", "reason"])

    return probes.groupBy("connection").applyInPandas(run, HEALTH)


SOAK = "key long, from long, to long, samples long, fingerprint long, closed_by string, crossed_midnight boolean, verdict string"
DAY_MS = 86_400_000


class _Soak(StatefulProcessor):
    def __init__(self, gap: int, least: int):
        self.gap, self.least = gap, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("window", "begin long, last long, samples long, fingerprint long")

    def _closed(self, key: tuple, begin: int, last: int, samples: int, fingerprint: int, by: str) -> tuple:
        crossed = last // DAY_MS > begin // DAY_MS
        return key[0], begin, last, samples, fingerprint, by, crossed, "PASS" if last - begin >= self.least and crossed else "NOT_COMPLETE"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        window, out = list(self.state.get()) if self.state.exists() else None, []
        for at, fingerprint in _sorted(rows, "ms", "id")[["ms", "fingerprint"]].astype("int64").itertuples(index=False):
            by = None if window is None else "GAP" if at - window[1] > self.gap else "FINGERPRINT" if fingerprint != window[3] else None
            if by:
                out.append(self._closed(key, *window, by))
            window = [at, at, 1, fingerprint] if window is None or by else [window[0], at, window[2] + 1, fingerprint]
        self.state.update(tuple(int(x) for x in window))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(window[1]) + self.gap + 1)
        yield pd.DataFrame(out, columns=[f.split()[0] for f in SOAK.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        window = self.state.get()
        self.state.clear()
        yield pd.DataFrame([self._closed(key, *window, "GAP")], columns=[f.split()[0] for f in SOAK.split(", ")])

    def close(self) -> None:
        pass


def soak_stream(samples: DataFrame, gap_ms: int = 180_000, least_ms: int = DAY_MS) -> DataFrame:
    """Closed observation windows of each key from samples (key, id, ms, fingerprint): a window ends with a gap or when
    the fingerprint changes; it passes if it lasted least_ms and went over a UTC midnight. Windows that still may go on
    are not among them."""
    return _stateful(samples, ["key"], _Soak(gap_ms, least_ms), SOAK, "ms")
