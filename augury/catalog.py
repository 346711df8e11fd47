"""Registered queries of the library and the DuckDB SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from augury.plans import audit_queries, combo_queries, decoder_queries, fill_queries, market_queries, ownership_queries, qualification_queries, reconcile_queries, registry_queries, replay_queries, settlement_queries, stream_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for _part in (fill_queries, market_queries, registry_queries, audit_queries, settlement_queries, decoder_queries, reconcile_queries, replay_queries, stream_queries, combo_queries, ownership_queries, qualification_queries):
    QUERIES |= _part.QUERIES
    ORACLE_SQL |= _part.ORACLE_SQL


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_queries.volume(spark, sf_dir)
