"""Reference prices: validity, windows, rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.operators import tables

ROUND_MS = 300_000


def validity() -> Column:
    """All reasons against a price record."""
    return tables.reasons(
        (F.col("observed_ms") <= F.col("published_ms"), "published before observed"), (F.col("published_ms") <= F.col("received_ms"), "received before published"),
        (F.col("price") == F.col("exact"), "inexact"), (F.col("feed") == "feed", "other feed"),
    )


def valid_prices(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records, others with their first reason)."""
    return tables.split(records.withColumn("reason", F.get(validity(), 0)))


def agreed(prices: DataFrame) -> DataFrame:
    """One price for each asset and time; times with more than one value are dropped."""
    out = prices.groupBy("asset", "observed_ms").agg(F.min("price").alias("price"), F.max("price").alias("__hi"))
    return out.where("price = __hi").drop("__hi")


def price_window(prices: DataFrame, now: int, span: int, most: int = 300) -> DataFrame:
    """The newest prices of each asset within the span before now, or else its last one."""
    past = prices.where(F.col("observed_ms") <= now)
    placed = tables.top_per(past, ["asset"], [F.desc("observed_ms")], most)
    return placed.where((F.col("observed_ms") > now - span) | (F.col("place") == 1))


def rounds(prices: DataFrame, round_ms: int = ROUND_MS) -> DataFrame:
    """Each asset's price by round: first, last, lowest, highest, count, and the exact opening if there is one."""
    begin = F.col("observed_ms") - F.pmod(F.col("observed_ms"), F.lit(round_ms))
    return prices.groupBy("asset", begin.alias("round")).agg(
        F.min_by("price", "observed_ms").alias("first"), F.max_by("price", "observed_ms").alias("last"), F.min("price").alias("low"), F.max("price").alias("high"), F.count("*").alias("n"),
        F.max(F.when(F.col("observed_ms") == begin, F.col("price"))).alias("opening"),
    )
