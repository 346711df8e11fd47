"""Stateful streams in several micro-batches, with DuckDB SQL that says what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from augury.sources import fixtures as fx
from augury.streaming import gateway, jobs

#: Identities and bytes that the accepted stream's query remembers; bounds of the health query in milliseconds.
WINDOW, MOST_BYTES, DEADLINE, AGE, GAP = 24, 900, 4 * 3_600_000, 9 * 3_600_000, 8 * 3_600_000


def _drained(spark, sf_dir, build, key, stream, schema):
    """What a stream gives over four micro-batches of a fixture in the order of key."""
    folder = jobs.work_dir(spark)
    files = jobs.write_in_order(fx.frame(spark, sf_dir, build), key, f"{folder}/in", 4)
    jobs.drain(stream(jobs.file_stream(spark, f"{folder}/in", files)), folder, states=spark.sparkContext.defaultParallelism)  # about ten keys
    return spark.read.schema(schema).parquet(f"{folder}/out")


def accepted_records(spark, sf_dir):
    return _drained(spark, sf_dir, fx.gateway_records, "seq", lambda s: gateway.accept_stream(s, WINDOW, MOST_BYTES), gateway.ACCEPTED)


def streamed_health(spark, sf_dir):
    return _drained(spark, sf_dir, fx.transport_probes, "id", lambda s: gateway.health_stream(s, DEADLINE, AGE), gateway.HEALTH)


def transport_health(spark, sf_dir):
    probes = fx.frame(spark, sf_dir, fx.transport_probes)
    return gateway.health_changes(probes, probes.agg(F.max("ms")).first()[0] or 0, DEADLINE, AGE)


def streamed_soak(spark, sf_dir):
    return _drained(spark, sf_dir, fx.soak_samples, "id", lambda s: gateway.soak_stream(s, GAP), gateway.SOAK)


QUERIES = {"stream_accepted": accepted_records, "stream_health": streamed_health, "transport_health": transport_health, "stream_soak": streamed_soak}

_HEALTH = fx.cte(p=fx.transport_probes) + f"""
    , l AS (SELECT *, lag(kind) OVER w AS pk, lag(ms) OVER w AS pms, lead(ms) OVER w AS nms FROM p WINDOW w AS (PARTITION BY connection, session ORDER BY ms, id)),
    o AS (SELECT connection, session, min(ms) AS since FROM l WHERE kind = 'PING' AND pk = 'PING' AND ms <= pms + {DEADLINE} GROUP BY ALL),
    s AS (SELECT connection, session, min(ms) AS begins FROM p GROUP BY ALL), e AS (SELECT *, lead(begins) OVER (PARTITION BY connection ORDER BY begins) AS ends FROM s),
    x AS (SELECT l.*, since, ends FROM l LEFT JOIN o USING (connection, session) JOIN e USING (connection, session)),
    good AS (SELECT connection, session, ms FROM x WHERE kind = 'PONG' AND pk = 'PING' AND ms <= pms + {DEADLINE} AND (since IS NULL OR ms < since)),
    miss AS (SELECT connection, session, ms + {DEADLINE} AS ms FROM x WHERE kind = 'PING' AND (since IS NULL OR ms < since) AND ms + {DEADLINE} < least(coalesce(nms, ends, 9e15), coalesce(ends, 9e15))),
    both_ AS (SELECT *, true AS ok FROM good UNION ALL SELECT *, false FROM miss),
    run AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY connection, session ORDER BY ms, ok DESC) AS r FROM both_),
    cnt AS (SELECT *, row_number() OVER (PARTITION BY connection, session, r ORDER BY ms, ok DESC) - CASE WHEN r > 0 THEN 1 ELSE 0 END AS n FROM run),
    pong AS (SELECT c.connection, c.session, c.ms, lead(c.ms) OVER (PARTITION BY c.connection, c.session ORDER BY c.ms) AS next_pong, since, ends FROM cnt c LEFT JOIN o USING (connection, session) JOIN e USING (connection, session) WHERE ok AND n >= 3),
    off AS (
        SELECT p.*, (SELECT min(m.ms) FROM miss m WHERE m.connection = p.connection AND m.session = p.session AND m.ms > p.ms) AS missed FROM pong p
    ), f AS (SELECT *, least(coalesce(missed, 9e15), ms + {AGE}, coalesce(since, 9e15), coalesce(ends, 9e15))::BIGINT AS stop FROM off),
    stops AS (
        SELECT connection, session, ms, stop, next_pong IS NULL OR stop < next_pong AS stopped,
            CASE WHEN stop = missed THEN 'DEADLINE' WHEN stop = ends THEN 'NEW_SESSION' WHEN stop = since THEN 'AMBIGUOUS' ELSE 'PROOF_EXPIRED' END AS reason FROM f
    ), ups AS (SELECT *, lag(stopped, 1, true) OVER (PARTITION BY connection, session ORDER BY ms) AS fresh FROM stops)
    SELECT connection, session, ms, true AS healthy, 'GOOD_PROBES' AS reason FROM ups WHERE fresh
    UNION ALL SELECT connection, session, stop, false, reason FROM ups WHERE stopped AND (stop < (SELECT max(ms) FROM p) OR (reason IN ('NEW_SESSION', 'AMBIGUOUS') AND stop <= (SELECT max(ms) FROM p)))
"""

ORACLE_SQL = {
    "stream_accepted": fx.cte(r=fx.gateway_records).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
        , n AS (SELECT *, row_number() OVER (PARTITION BY plant ORDER BY seq) AS i, stream || ':' || "offset" AS k FROM r),
        walk AS (
            SELECT plant, 0::BIGINT AS i, NULL::BIGINT AS seq, NULL::VARCHAR AS status, NULL::VARCHAR AS session, NULL::VARCHAR AS stream, []::STRUCT(k VARCHAR, d VARCHAR, b BIGINT)[] AS q FROM (SELECT DISTINCT plant FROM r)
            UNION ALL
            SELECT plant, i, seq, status, CASE status WHEN 'SESSION' THEN own ELSE session END, CASE status WHEN 'SESSION' THEN of ELSE stream END,
                CASE status WHEN 'SESSION' THEN [] WHEN 'ACCEPTED' THEN added[list_filter(range(1, len(added) + 2), lambda j: len(added) - j + 1 <= {WINDOW} AND coalesce(list_sum(list_transform(added[j:], lambda x: x.b)), 0) <= {MOST_BYTES})[1]:] ELSE q END
            FROM (
                SELECT *, list_append(q, {{'k': k, 'd': digest, 'b': bytes}}) AS added, CASE WHEN kind = 'SESSION' THEN 'SESSION' WHEN own IS DISTINCT FROM session THEN 'STALE_SESSION' WHEN of IS DISTINCT FROM stream THEN 'RESET_REQUIRED_STREAM_GENERATION'
                    WHEN len(list_filter(q, lambda x: x.k = outer_k)) > 0 THEN CASE WHEN list_filter(q, lambda x: x.k = outer_k)[1].d = digest THEN 'RETRY' ELSE 'IDENTITY_CONTENT_CONFLICT' END ELSE 'ACCEPTED' END AS status FROM (
                    SELECT w.plant, n.i, n.seq, n.kind, n.session AS own, n.stream AS of, n.k, n.k AS outer_k, n.digest, n.bytes, w.session, w.stream, w.q FROM walk w JOIN n ON n.plant = w.plant AND n.i = w.i + 1
                )
            )
        )
        SELECT plant, seq, status FROM walk WHERE i > 0""",
    "stream_health": _HEALTH,
    "transport_health": _HEALTH,
    "stream_soak": fx.cte(e=fx.soak_samples) + f"""
        , s AS (SELECT *, lag(ms) OVER w AS pa, lag(fingerprint) OVER w AS pf FROM e WINDOW w AS (PARTITION BY key ORDER BY ms, id)),
        n AS (SELECT *, sum(CASE WHEN pa IS NULL OR ms - pa > {GAP} OR fingerprint <> pf THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ms, id) AS k FROM s),
        g AS (SELECT key, k, min(ms) AS a, max(ms) AS z, count(*) AS samples, min(fingerprint) AS fingerprint FROM n GROUP BY ALL), h AS (SELECT *, lead(a) OVER (PARTITION BY key ORDER BY k) AS nxt FROM g)
        SELECT key, a AS "from", z AS "to", samples, fingerprint, CASE WHEN nxt IS NULL OR nxt - z > {GAP} THEN 'GAP' ELSE 'FINGERPRINT' END AS closed_by, z // 86400000 > a // 86400000 AS crossed_midnight,
            CASE WHEN z - a >= 86400000 AND z // 86400000 > a // 86400000 THEN 'PASS' ELSE 'NOT_COMPLETE' END AS verdict FROM h WHERE nxt IS NOT NULL OR z + {GAP} < (SELECT max(ms) FROM e)""",
}
