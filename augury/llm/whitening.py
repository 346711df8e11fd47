"""Whitening of embeddings by a covariance in which equal vectors count by their multiplicity.

Vectors become whole numbers x, equal ones are grouped, and each group is one row with its number of copies. Weights of the fit are those
numbers (or one for each group). Sums are exact; the covariance is a weighted product of centred matrices: each task
adds up what its rows give, centred at the whole numbers next to the mean, and the rest of the centring, less than one, is taken off in the end. Each
group is whitened once, and rows join it by their x. What the driver holds is a matrix of dimensions by dimensions.

Vectors that are null or empty, or hold a null, NaN or infinite entry, or one beyond the documented RANGE, take no part and have no rows;
nor have those whose length is not the most frequent one (of equally frequent ones, the longest). Repeated rows each get
their rows and count in the fit; ties of eigenvalues are broken as the solver does, the same for all rows. A component
whose eigenvalue is zero up to rounding is listed with null for what it whitens. Columns of the input pass
through in the struct `row`, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.llm.common import remove, small_batches, written

COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Entries at or beyond it count as not finite: no double tells neighbouring x apart there.
RANGE = 2.0**42
_WIDE = pa.decimal128(38, 0)


def whole(vector: Column) -> Column:
    """floor(SCALE * c) + SHIFT of each entry; null for a vector that takes no part."""
    wide = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall(wide, lambda c: F.coalesce(F.abs(c) < RANGE, F.lit(False)))  # NaN is larger than any number
    return F.when((F.size(vector) > 0) & fine, F.transform(wide, lambda c: F.floor(c * SCALE) + SHIFT))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _exact(x: np.ndarray, most: int) -> np.ndarray:
    """x as it is if results up to `most` fit in 63 bits, else as Python's integers."""
    return x if most < 2**62 else x.astype(object)


def _sums(groups: DataFrame) -> DataFrame:
    """Exact weighted sums by dimension (i, s), and the sum of weights as dimension -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            if batch.num_rows:
                x, w = _matrix(batch.column("x")), batch.column("weight").to_numpy()
                x = np.column_stack([np.ones(len(x), np.int64), x])
                most = int(np.abs(x).max()) * int(w.sum())
                part = (_exact(w, most) @ _exact(x, most)).astype(object)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total) - 1), pa.int32()), pa.array([Decimal(int(s)) for s in total], _WIDE)], ["i", "s"])

    return groups.select("x", "weight").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))


def _products(groups: DataFrame, centre: np.ndarray) -> DataFrame:
    """Weighted products of centred entries by pair of dimensions (i, j, v), i <= j: one matrix product a batch."""
    sent = groups.sparkSession.sparkContext.broadcast(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centre), len(centre)))
        for batch in batches:
            if batch.num_rows:
                d = (_matrix(batch.column("x")) - sent.value).astype(np.float64)
                total += d.T @ (d * batch.column("weight").to_numpy()[:, None])
        i, j = np.triu_indices(len(centre))
        for a in range(0, len(i), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(k[a : a + 50_000].astype(np.int32)) for k in (i, j)] + [pa.array(total[i, j][a : a + 50_000])], ["i", "j", "v"])

    return groups.select("x", "weight").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))


def fit(groups: DataFrame, components: int = COMPONENTS) -> dict:
    """Model of groups (x, weight): n, sums, centre, rest of the centring, eigenvalues (all), axes (columns)."""
    found = {r["i"]: int(r["s"]) for r in _sums(groups).collect()}  # a number for each dimension
    if not found:
        return {"n": 0}
    n = found.pop(-1)
    sums = [found[i] for i in range(len(found))]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = np.array([(s - n * int(c)) / n for s, c in zip(sums, centre)])
    v = np.zeros((len(sums), len(sums)))
    for r in _products(groups, centre).collect():
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = r["v"] / n
    values, axes = np.linalg.eigh(v - np.outer(rest, rest))
    values, axes = values[::-1], axes[:, ::-1][:, :components]
    return {"n": n, "sums": sums, "centre": centre, "rest": rest, "values": values, "axes": axes, "trace": float(np.trace(v) - rest @ rest)}


def _standing(model: dict) -> np.ndarray:
    """Which of the listed components have an eigenvalue beyond rounding."""
    return model["values"][: model["axes"].shape[1]] > max(model["values"][0], 0) * len(model["values"]) * np.finfo(float).eps


def _whitened(groups: DataFrame, model: dict) -> DataFrame:
    """Groups with `whitened` (an entry for each component) and `deviation` (null if it has over 38 digits)."""
    sent = groups.sparkSession.sparkContext.broadcast(model)
    names = [*groups.columns, "whitened", "deviation"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        good, k = _standing(m), m["axes"].shape[1]
        scale = np.sqrt(np.where(good, m["values"][:k], 1.0))
        for batch in batches:
            x = _matrix(batch.column("x")) if batch.num_rows else np.zeros((0, len(m["sums"])), np.int64)
            y = ((x - m["centre"]).astype(np.float64) - m["rest"]) @ m["axes"] / scale
            most = int(np.abs(x).max(initial=0)) * m["n"] + max(map(abs, m["sums"]))
            d = _exact(x, most) * m["n"] - np.array(m["sums"], object if most >= 2**62 else np.int64)
            largest = max((abs(int(e)) for e in (d.max(initial=0), d.min(initial=0))), default=0)
            d = _exact(d, largest * largest * x.shape[1])
            deviation = [Decimal(int(e)) if int(e) < 10**38 else None for e in (d * d).sum(axis=1)] if len(x) else []
            entries = pa.array(y.ravel(), mask=np.tile(~good, len(y)))
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, y.size + 1, k), pa.int32()), entries)
            yield pa.RecordBatch.from_arrays([*batch.columns, listed, pa.array(deviation, _WIDE)], names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema.fields)
    return groups.mapInArrow(run, f"{kinds}, whitened array<double>, deviation decimal(38,0)")


def _identity_error(groups: DataFrame, model: dict) -> float:
    """Largest entry of the whitened rows' weighted covariance, centred before multiplying, beside the identity."""
    at = [k for k, good in enumerate(_standing(model)) if good]
    if not at:
        return 0.0
    n, w = float(model["n"]), F.col("weight")
    entry = lambda k: F.get("whitened", F.lit(k))
    means = groups.agg(*[(F.sum(entry(k) * w) / n) for k in at]).first()
    centred = {k: entry(k) - mean for k, mean in zip(at, means)}
    pairs = [(a, b) for a in at for b in at if a <= b]
    found = groups.agg(*[F.sum(centred[a] * centred[b] * w) / n for a, b in pairs]).first()
    return max(abs(v - (a == b)) for (a, b), v in zip(pairs, found))


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, weight: str = "count") -> DataFrame:
    """Columns row, x, n (sum of weights), deviation decimal, whitened array, eigenvalues array, trace, identity_error.

    weight: "count" weighs each distinct vector by its copies, "one" all alike.
    """
    if weight not in ("count", "one"):
        raise ValueError(f"weight is count or one, not {weight}")
    packed = small_batches(rows).select(F.struct("*").alias("row"), whole(F.col(f"`{vector}`")).alias("x")).where("x is not null")
    sizes = packed.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    packed = packed.where(F.size("x") == (sizes["size"] if sizes else 0))
    groups = written(packed.groupBy("x").agg(F.count("*").alias("copies")).withColumn("weight", F.col("copies") if weight == "count" else F.lit(1).cast("long")), "vectors")
    model = fit(groups, components)
    if not model["n"]:
        model = {"n": 0, "sums": [0], "centre": np.zeros(1, np.int64), "rest": np.zeros(1), "values": np.zeros(1), "axes": np.zeros((1, 1)), "trace": 0.0}
    once = written(_whitened(groups, model), "whitened")
    remove(groups)
    error = _identity_error(once, model)
    # Two hashes find the group, equality makes sure: vectors are too long to be sorted by.
    key = lambda x: [F.xxhash64(x).alias("h"), F.hash(x).alias("g")]
    found = once.select(*key("x"), F.col("x").alias("y"), "whitened", "deviation")
    joined = packed.select("row", "x", *key("x")).join(found, ["h", "g"]).where(F.col("x") == F.col("y"))
    values = [float(e) for e in model["values"][: model["axes"].shape[1]]]
    return joined.select(
        "row", "x", F.lit(model["n"]).cast("long").alias("n"), "deviation", "whitened",
        F.array(*map(F.lit, values)).alias("eigenvalues"), F.lit(model["trace"]).alias("trace"), F.lit(float(error)).alias("identity_error"),
    )
