"""Table kit: merges, comparisons, latest rows, sequences, intervals, quantiles, as-of joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from augury.sources.shared import written


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Equality of key columns, null equal to null."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


#: How merge_table() joins an old and a new value.
RULES = {
    "keep": lambda old, new: F.coalesce(old, new),
    "replace": lambda old, new: new,
    "coalesce": lambda old, new: F.coalesce(F.when(new.cast("string") != "", new), old),
    "least": lambda old, new: F.least(old, new),
    "greatest": lambda old, new: F.greatest(old, new),
    "sum": lambda old, new: F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0)),
    "or": lambda old, new: F.coalesce(old, F.lit(False)) | F.coalesce(new, F.lit(False)),
}


def merge_table(base: DataFrame, delta: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """The new state of base after delta: one full outer join; each column follows its rule where both sides have the
    key, and the side that exists otherwise. Keys must be unique in each side."""
    b, d = base.withColumn("__b", F.lit(True)).alias("b"), delta.withColumn("__d", F.lit(True)).alias("d")
    on = reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys])
    both = b.join(d, on, "full_outer")

    def column(c: str) -> Column:
        old, new = F.col(f"b.{c}"), F.col(f"d.{c}")
        merged = F.coalesce(old, new) if c in keys else RULES[rules[c]](old, new)
        return F.when(F.col("d.__d").isNull(), old).when(F.col("b.__b").isNull(), new).otherwise(merged).alias(c)

    return both.select(*[column(c) for c in base.columns])


def compare_tables(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Rows (keys, status, copies_expected, copies_actual): missing, extra, mismatched, duplicate or same, by key."""
    digest = lambda: F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
    each = lambda df, side: df.select(*keys, digest().alias("d"), F.lit(side).alias("side"))
    both = each(expected, 0).unionByName(each(actual, 1))
    of = lambda side: F.col("side") == side
    grouped = both.groupBy(*keys).agg(
        F.count_if(of(0)).alias("copies_expected"), F.count_if(of(1)).alias("copies_actual"), F.min("d").alias("lo"), F.max("d").alias("hi"),
    )
    status = (
        F.when(F.col("copies_actual") == 0, "missing").when(F.col("copies_expected") == 0, "extra")
        .when(F.greatest("copies_expected", "copies_actual") > 1, "duplicate").when(F.col("lo") != F.col("hi"), "mismatched").otherwise("same")
    )
    return grouped.select(*keys, status.alias("status"), "copies_expected", "copies_actual")


def audit_keys(expected: DataFrame, actual: DataFrame, keys: list[str], by: list[str] = ()) -> DataFrame:
    """Key audit, one row or one for each value of `by` (columns of the key): unique keys, duplicate rows, missing,
    extra, exact."""
    each = compare_tables(expected, actual, [*by, *[k for k in keys if k not in by]], keys)
    have = lambda c: F.count_if(F.col(c) > 0)
    surplus = lambda c: F.coalesce(F.sum(F.greatest(F.col(c) - 1, F.lit(0))), F.lit(0)).cast("long")
    out = each.groupBy(*by).agg(
        have("copies_expected").alias("expected_keys"), have("copies_actual").alias("actual_keys"),
        surplus("copies_expected").alias("expected_duplicates"), surplus("copies_actual").alias("actual_duplicates"),
        F.count_if(F.col("status") == "missing").alias("missing"), F.count_if(F.col("status") == "extra").alias("extra"),
    )
    bad = F.col("missing") + F.col("extra") + F.col("expected_duplicates") + F.col("actual_duplicates")
    return out.withColumn("exact", bad == 0)


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last in the given order (descending; the columns must decide ties)."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))  # partial before the shuffle
    return last.select(*[F.col(c) if c in keys else F.col("__r").getField(c).alias(c) for c in df.columns])


def top_per(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key in the given order, with their place."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= n)


def sequence_gaps(df: DataFrame, keys: list[str], order: str, seq: str, prev: str | None = None) -> DataFrame:
    """Rows that do not follow the row before: seq is not one more, or the named previous number is not the seen one."""
    last = F.lag(seq).over(Window.partitionBy(*keys).orderBy(order))
    wrong = F.col(seq) != F.col("expected")
    if prev:
        wrong = wrong | F.coalesce(F.col(prev) != F.col("expected") - 1, F.lit(True))
    return df.withColumn("expected", last + 1).where(F.col("expected").isNotNull() & wrong)


def contiguous_prefix(ranges: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """For each key: committed (end of the contiguous run from its start), islands, holes, overlaps, tail (numbers
    above the prefix that a range holds)."""
    order = Window.partitionBy(*keys).orderBy(first, last)
    before = F.max(last).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = ranges.withColumn("__before", before)
    marked = marked.withColumn("__new", (F.col("__before").isNull() | (F.col(first) > F.col("__before") + 1)).cast("int"))
    marked = marked.withColumn("__over", F.coalesce(F.col(first) <= F.col("__before"), F.lit(False)))
    marked = marked.withColumn("__hole", F.when((F.col("__new") == 1) & F.col("__before").isNotNull(), F.col(first) - F.col("__before") - 1).otherwise(0))
    marked = marked.withColumn("__island", F.sum("__new").over(order))
    islands = marked.groupBy(*keys, "__island").agg(F.min(first).alias("lo"), F.max(last).alias("hi"), F.sum("__hole").alias("hole"), F.count_if("__over").alias("over"))
    return islands.groupBy(*keys).agg(
        F.max(F.when(F.col("__island") == 1, F.col("hi"))).alias("committed"), F.count("*").alias("islands"), F.sum("hole").cast("long").alias("holes"),
        F.sum("over").cast("long").alias("overlaps"), F.coalesce(F.sum(F.when(F.col("__island") > 1, F.col("hi") - F.col("lo") + 1)), F.lit(0)).cast("long").alias("tail"),
    )


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_at: str, right_at: str, take: list[str], cell: int | None = None) -> DataFrame:
    """Each left row with the latest right row of its key at or before it: a union ordered by time, no range join.

    right has one row per key and time; columns `take` come back under their names, null where there is none. With cell, a
    width in units of time, a key is sorted by cells in as many tasks, and each cell starts with the last row before it.
    """
    keys = [F.col(k) for k in by]
    l_ = left.select(*keys, F.col(left_at).alias("__at"), F.lit(1).alias("__side"), F.struct("*").alias("__l"), F.lit(None).cast(right.select(F.struct(*take)).schema[0].dataType).alias("__r"))
    r_ = right.select(*keys, F.col(right_at).alias("__at"), F.lit(0).alias("__side"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("__l"), F.struct(*take).alias("__r"))
    both, parts = l_.unionByName(r_), list(by)
    carried = F.lit(None).cast(both.schema["__r"].dataType)
    if cell:
        both, parts = both.withColumn("__cell", F.floor(F.col("__at") / cell)), [*by, "__cell"]
        lasts = both.groupBy(*parts).agg(F.max_by("__r", F.when(F.col("__side") == 0, F.col("__at"))).alias("__last"))
        earlier = Window.partitionBy(*by).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
        lasts = lasts.withColumn("__before", F.last("__last", ignorenulls=True).over(earlier)).select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(parts)], "__before")
        both, carried = both.join(lasts, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(parts)])), F.col("__before")
    w = Window.partitionBy(*parts).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__r", F.coalesce(F.last("__r", ignorenulls=True).over(w), carried)).where("__side = 1")
    return found.select("__l.*", *[F.col("__r").getField(c).alias(c) for c in take])


def intervals(changes: DataFrame, keys: list[str], at: str, order: str, flag: str, start: int, end: int) -> DataFrame:
    """Half-open intervals (keys, from, to) in which the flag holds, clipped to [start, end)."""
    w = Window.partitionBy(*keys).orderBy(at, order)
    out = changes.withColumn("__to", F.lead(at).over(w)).where(flag)
    out = out.select(*keys, F.greatest(F.col(at), F.lit(start)).alias("from"), F.least(F.coalesce("__to", F.lit(end)), F.lit(end)).alias("to"))
    return out.where("`from` < `to`")


def covered(spans: DataFrame, keys: list[str], least: int = 1) -> DataFrame:
    """For each key, the length of time in which at least so many of its (from, to) intervals hold: a sweep over ends."""
    ends = spans.select(*keys, F.explode(F.array(F.struct(F.col("from").alias("at"), F.lit(1).alias("d")), F.struct(F.col("to").alias("at"), F.lit(-1).alias("d")))).alias("e"))
    steps = ends.groupBy(*keys, "e.at").agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy(*keys).orderBy("at")
    open_ = F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))
    held = steps.select(*keys, open_.alias("open"), (F.lead("at").over(w) - F.col("at")).alias("length"))
    return held.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("open") >= least, F.col("length"))), F.lit(0)).cast("long").alias("covered"))


def exact_quantiles(df: DataFrame, by: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Exact quantiles by the lower-index rule: the element at int((n - 1) * q) of the sorted values.

    Values are counted first, so that repeated ones are one row.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    order = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("__upto", F.sum("n").over(order)).withColumn("__all", F.sum("n").over(Window.partitionBy(*by)))
    pick = lambda q: F.min(F.when(F.col("__upto") > F.floor((F.col("__all") - 1) * F.lit(q)), F.col(value)))
    return placed.groupBy(*by).agg(F.max("__all").alias("n"), *[pick(q).alias(name) for name, q in qs.items()], F.max(value).alias("max"))


def histogram_quantiles(df: DataFrame, by: list[str], value: str, bounds: list[int], qs: dict[str, float]) -> DataFrame:
    """Upper bounds of the histogram bucket in which each quantile falls; values above all bounds get -1."""
    bucket = F.coalesce(*[F.when(F.col(value) <= b, F.lit(i)) for i, b in enumerate(bounds)], F.lit(len(bounds)))
    counts = df.groupBy(*by, bucket.alias("b")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by)
    placed = counts.withColumn("upto", F.sum("n").over(w.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(w))
    firsts = placed.groupBy(*by).agg(F.max("all").alias("n"), *[F.min(F.when(F.col("upto") >= F.col("all") * F.lit(q), F.col("b"))).alias(name) for name, q in qs.items()])
    return firsts.select(*by, "n", *[F.element_at(F.array(*map(F.lit, [*bounds, -1])), F.col(name) + 1).cast("long").alias(name) for name in qs])


def reasons(*checks: tuple[Column, str]) -> Column:
    """All failing reasons in order, as an array."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(why)) for ok, why in checks]), lambda x: x.isNotNull())


def settled(df: DataFrame) -> DataFrame:
    """The same rows as the output of a generator: filters above are not rewritten into the expressions below, which
    would repeat long decoding expressions."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def split(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Rows without and with a reason.

    The reason depends, in form, on the partition's number: filters that ask for it are not rewritten into the expressions
    below, and unlike a generator the projection is compiled.
    """
    df = df.withColumn(reason, F.when(F.spark_partition_id() >= 0, F.col(reason)))
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with the 0-based place of each row in the given order: rows are dealt by ranges, sorted and written, and only
    the number of rows of each partition is summed up. Nulls come first; ties get places of their own."""
    by = [F.col(c).asc_nulls_first() for c in order]
    at = F.monotonically_increasing_id()
    fixed = written(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"__part": F.shiftrightunsigned(at, 33), "__at": at.bitwiseAND(F.lit((1 << 33) - 1))}), "ranked")
    sizes = fixed.groupBy("__part").agg((F.max("__at") + 1).alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return fixed.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")
