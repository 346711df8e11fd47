"""Oracle events and settlement: summaries, market bridge, payouts, readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 10**18
LEG = 1_000_000


def adjudication(events: DataFrame) -> DataFrame:
    """Per market: numbers of events by status, and the settle that comes last by block, log index and id."""
    place = F.struct("block", "log_index", "id")
    settle = F.col("status") == "settle"
    return events.groupBy("market").agg(
        *[F.count_if(F.col("status") == s).alias(f"{s}s") for s in ("request", "propose", "dispute", "settle")],
        F.max_by(F.when(settle, F.col("id")), F.when(settle, place)).alias("last_settle"), F.max_by(F.when(settle, F.col("value")), F.when(settle, place)).alias("last_value"),
    )


def bridge_markets(rows: DataFrame, markets: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows with market_id and matched_by: a key counts only if it names one market, and all keys that count must
    agree; matched_by is the first of them."""
    out = rows
    for k in keys:
        unique = markets.where(F.col(k).isNotNull()).groupBy(k).agg(F.count("*").alias("__n"), F.min("market_id").alias(f"__{k}")).where("__n = 1").drop("__n")
        out = out.join(unique, k, "left")
    found = F.filter(F.array(*[F.col(f"__{k}") for k in keys]), lambda x: x.isNotNull())
    agreed = F.size(F.array_distinct(found)) == 1
    by = F.coalesce(*[F.when(F.col(f"__{k}").isNotNull(), F.lit(k)) for k in keys])
    out = out.withColumn("market_id", F.when(agreed, F.get(found, 0))).withColumn("matched_by", F.when(agreed, by))
    return out.drop(*[f"__{k}" for k in keys])


def _scaled(limbs: Column, n: Column, up: bool) -> Column:
    """limbs * n / 1e6, rounded down or up, for a number held as hi * 1e18 + lo: each product fits 24 digits. Each step is
    named, so that none is repeated in the next."""
    d = lambda x: x.cast("decimal(38,0)")
    named = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)
    unit = F.lit(UNIT).cast("decimal(19,0)")

    def joined(x: Column) -> Column:
        whole = lambda lo_rest: d((d(x["lo"]) - lo_rest) / LEG) + (F.when(lo_rest > 0, 1).otherwise(0) if up else F.lit(0))
        split = lambda t: named(d(t % unit), lambda carry: F.struct(d(x["hi"] + d((t - carry) / unit)).alias("hi"), carry.alias("lo")))
        return named(d(whole(d(x["lo"]) % LEG)), split)

    high = named(d(limbs["hi"]) * n, lambda hi: F.struct(hi.alias("hi"), (hi % LEG).alias("rest")))
    return named(high, lambda h: named(F.struct(d((h["hi"] - h["rest"]) / LEG).alias("hi"), (h["rest"] * unit + d(limbs["lo"]) * n).alias("lo")), joined))


def combo_payout(legs: Column) -> Column:
    """Payout of a combination from its legs' numerators (of 1e6, in order): struct of down and up factors, each in
    limbs of 1e18 for the unit 1e36; a leg of zero makes the first zero."""
    one = F.struct(F.lit(UNIT).cast("decimal(38,0)").alias("hi"), F.lit(0).cast("decimal(38,0)").alias("lo"))
    fold = lambda up: F.aggregate(legs, one, lambda acc, n: _scaled(acc, n.cast("decimal(7,0)"), up))
    return F.struct(fold(False).alias("down"), fold(True).alias("up"))


def payout_vector(text: Column) -> Column:
    """Numerators of a payout list such as [1, 0], as array<decimal>; null unless 2 to 256 plain integers whose sum
    is positive."""
    plain = F.regexp_replace(text, r"\s", "")
    items = F.split(F.regexp_replace(plain, r"[\[\]]", ""), ",")
    numbers = F.transform(items, lambda x: x.try_cast("decimal(38,0)"))
    good = plain.rlike(r"^\[(0|[1-9][0-9]{0,36})(,(0|[1-9][0-9]{0,36})){1,255}\]$") & F.exists(numbers, lambda x: x > 0)
    return F.when(good, numbers)


def readiness(status: DataFrame) -> DataFrame:
    """State of every market from its summary: the order of the branches is part of the meaning."""
    state = (
        F.when(F.col("settles") == 0, F.when(F.col("proposes") > 0, "PROPOSED").when(F.col("requests") > 0, "REQUESTED").otherwise("NO_EVIDENCE"))
        .when(F.col("requests") == 0, "SETTLED_WITHOUT_REQUEST").when(F.col("disputes") > F.col("settles"), "DISPUTED").when(F.col("last_value").isNull(), "INVALID_PAYOUT").otherwise("READY")
    )
    return status.withColumn("state", state)
