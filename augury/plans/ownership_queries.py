"""Ownership of conditions and tokens, promotions, and the registry after a write, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from augury.operators import ownership
from augury.sources import fixtures as fx


def _inputs(spark, sf_dir):
    return tuple(fx.frame(spark, sf_dir, build) for build in (fx.registry_rows, fx.registry_markets, fx.registry_tokens))


def accepted(spark, sf_dir):
    return ownership.filter_ownership(*_inputs(spark, sf_dir))[0].select("condition_id", "yes_token", "no_token", "gamma_market_id", "category", "strict")


def evidence(spark, sf_dir):
    return ownership.filter_ownership(*_inputs(spark, sf_dir))[1]


def promotions(spark, sf_dir):
    return ownership.filter_ownership(*_inputs(spark, sf_dir))[2].select("kind", "token_id", "from_market_id", "from_condition_id", "to_condition_id")


def _written(spark, sf_dir):
    """By the time of the write every seventh promoted token has another owner."""
    rows, markets, tokens = _inputs(spark, sf_dir)
    good, _, moves = ownership.filter_ownership(rows, markets, tokens)
    since = tokens.withColumn("condition_id", F.when(F.col("token_id").cast("long") % 70 == 30, "0xelse").otherwise(F.col("condition_id")))
    return ownership.write_registry(good, moves, markets, since)


def markets_after(spark, sf_dir):
    return _written(spark, sf_dir)[0].select("market_id", "condition_id", "identity_kind", F.coalesce("gamma_market_id", F.lit("")).alias("gamma_market_id"), "category", F.coalesce("slug", F.lit("")).alias("slug"))


def tokens_after(spark, sf_dir):
    return _written(spark, sf_dir)[1]


def failures(spark, sf_dir):
    return _written(spark, sf_dir)[2]


QUERIES = {"ownership_accepted": accepted, "ownership_evidence": evidence, "ownership_promotions": promotions, "registry_markets": markets_after, "registry_tokens": tokens_after, "registry_failures": failures}

_RULES = fx.cte(r0=fx.registry_rows, m=fx.registry_markets, t=fx.registry_tokens) + """
    , r AS (SELECT *, normalized AND trim(gamma_market_id) <> '' AS strict FROM r0),
    shell AS (SELECT market_id, condition_id, identity_kind, gamma_market_id, identity_kind = 'protocol_structural' OR (trim(coalesce(gamma_market_id, '')) = '' AND (lower(category) = 'orderfilled-placeholder' OR slug LIKE 'trade-indexer-placeholder-%')) AS loose FROM m),
    c AS (SELECT r.condition_id, s.market_id, strict AND loose AS may FROM r JOIN shell s ON s.condition_id = r.condition_id WHERE NOT (identity_kind = 'canonical_gamma' AND trim(s.gamma_market_id) = trim(r.gamma_market_id))),
    k AS (SELECT condition_id, strict, yes_token AS token_id FROM r UNION SELECT condition_id, strict, no_token FROM r),
    n AS (SELECT k.*, (SELECT count(DISTINCT condition_id) FROM k x WHERE x.token_id = k.token_id) > 1 AS several, t.market_id, t.condition_id AS held, s.condition_id AS home, loose FROM k LEFT JOIN t ON t.token_id = k.token_id LEFT JOIN shell s ON s.market_id = t.market_id),
    e AS (
        SELECT 'condition_identity_conflict' AS kind, '' AS token_id, condition_id AS existing, condition_id AS attempted FROM c WHERE NOT may
        UNION ALL SELECT 'token_ownership_conflict', token_id, coalesce(held, 'batch'), condition_id FROM n WHERE several AND held IS DISTINCT FROM condition_id
        UNION ALL SELECT 'token_ownership_conflict', token_id, coalesce(home, held), condition_id FROM n WHERE NOT several AND held <> condition_id AND NOT (strict AND loose)
    ), p AS (
        SELECT 'market_identity' AS kind, '' AS token_id, market_id AS from_market_id, condition_id AS from_condition_id, condition_id AS to_condition_id FROM c WHERE may AND condition_id NOT IN (SELECT attempted FROM e)
        UNION ALL SELECT 'token_rehome', token_id, market_id, held, condition_id FROM n WHERE NOT several AND held <> condition_id AND strict AND loose AND condition_id NOT IN (SELECT attempted FROM e)
    ), stale AS (SELECT DISTINCT to_condition_id AS condition_id FROM p WHERE kind = 'token_rehome' AND token_id::BIGINT % 70 = 30),
    w AS (SELECT * FROM r WHERE condition_id NOT IN (SELECT attempted FROM e) AND condition_id NOT IN (SELECT condition_id FROM stale)),
    ids AS (
        SELECT w.*, m.market_id, false AS fresh FROM w JOIN m ON m.condition_id = w.condition_id
        UNION ALL SELECT w.*, (SELECT max(market_id) FROM m) + row_number() OVER (ORDER BY condition_id), true FROM w WHERE condition_id NOT IN (SELECT condition_id FROM m)
    ), ts AS (SELECT token_id, market_id, CASE WHEN token_id::BIGINT % 70 = 30 THEN '0xelse' ELSE condition_id END AS condition_id, id, outcome, outcome_index FROM t),
    want AS (SELECT yes_token AS token_id, market_id, condition_id, -(2 * market_id - 1) AS id, 'YES' AS outcome, 0 AS outcome_index FROM ids UNION ALL SELECT no_token, market_id, condition_id, -2 * market_id, 'NO', 1 FROM ids),
    put AS (SELECT want.* FROM want LEFT JOIN ts ON ts.token_id = want.token_id WHERE ts.token_id IS NULL OR ts.condition_id = want.condition_id OR want.token_id IN (SELECT token_id FROM p WHERE kind = 'token_rehome' AND to_condition_id = want.condition_id)),
    after_ AS (SELECT * FROM put UNION ALL SELECT * FROM ts WHERE token_id NOT IN (SELECT token_id FROM put))
"""

ORACLE_SQL = {
    "ownership_accepted": _RULES + "SELECT condition_id, yes_token, no_token, gamma_market_id, category, strict FROM r WHERE condition_id NOT IN (SELECT attempted FROM e)",
    "ownership_evidence": _RULES + "SELECT * FROM e",
    "ownership_promotions": _RULES + "SELECT * FROM p",
    "registry_markets": _RULES + """
        SELECT m.market_id, m.condition_id, CASE WHEN i.market_id IS NULL THEN identity_kind ELSE 'canonical_gamma' END AS identity_kind, coalesce(CASE WHEN i.market_id IS NULL THEN m.gamma_market_id ELSE i.gamma_market_id END, '') AS gamma_market_id,
            CASE WHEN i.market_id IS NULL THEN m.category ELSE i.category END AS category, slug FROM m LEFT JOIN ids i ON i.market_id = m.market_id
        UNION ALL SELECT market_id, condition_id, 'canonical_gamma', gamma_market_id, category, '' FROM ids WHERE fresh""",
    "registry_tokens": _RULES + "SELECT token_id, market_id, condition_id, id, outcome, outcome_index FROM after_",
    "registry_failures": _RULES + """
        SELECT condition_id, '' AS token_id, 'CHANGED_SINCE' AS failure FROM stale
        UNION ALL SELECT want.condition_id, want.token_id, 'NOT_INSTALLED' FROM want LEFT JOIN after_ a ON a.token_id = want.token_id WHERE a.market_id IS DISTINCT FROM want.market_id OR a.condition_id IS DISTINCT FROM want.condition_id OR a.outcome IS DISTINCT FROM want.outcome""",
}
