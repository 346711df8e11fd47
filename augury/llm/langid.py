"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learns from rows with text and a language; counts of all of them are summed by Spark, and the matrix of log
probabilities is broadcast in slabs of a fixed number of languages, so that its size does not depend on the data. A batch
of texts is one sparse matrix of n-gram counts, which is multiplied with the slab in numpy.

A null text, or one without a letter, is `und` with score 0, as is every text if there was nothing to learn from. An empty
text teaches nothing but how frequent its language is. Ties go to the first language in alphabetical order. Very long
texts count whole. Repeated rows, null ids and extra columns pass through in `row`; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.llm.common import remove, small_batches, with_results, written

ORDERS = (1, 2, 3)
BITS = 16
#: Languages of a slab of the matrix (2**16 buckets of 4 bytes each), and products held at once.
SLAB, PRODUCTS = 64, 4_000_000
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def features(text: str, bits: int = BITS) -> np.ndarray:
    """Bucket of each n-gram of the lower-cased text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    out = []
    for n in ORDERS:
        if len(c) >= n:
            h = np.full(len(c) - n + 1, n, np.uint64)
            for k in range(n):
                h += c[k : len(c) - n + 1 + k] * _M[k]
            h ^= h >> np.uint64(32)
            out.append((h * _M[3]) >> np.uint64(64 - bits))
    return np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)


def fit(rows: DataFrame, bits: int = BITS, slab: int = SLAB) -> list[tuple[list[str], np.ndarray]]:
    """Slabs in alphabetical order: languages, and the matrix buckets x languages of log probabilities with the log prior
    in a last row. One language's counts are one binary value by the time that they reach the driver."""
    out = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros((1 << bits) + 1, np.int64))

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], schema=out)
            sums.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                one = sums[lang.as_py()]
                one[:-1] += np.bincount(features(text.as_py(), bits), minlength=1 << bits)
                one[-1] += 1
                if len(sums) > slab:
                    yield from flush()
        yield from flush()

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        n = np.zeros((1 << bits) + 1, np.int64)
        n[group.column("bucket").to_numpy()] = group.column("n").to_numpy()
        return pa.table({"lang": [key[0].as_py()], "counts": [n.tobytes()]})

    known = small_batches(rows).where("text is not null and lang is not null").select("text", "lang")
    counts = known.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = written(counts.groupBy("lang").applyInArrow(pack, "lang string, counts binary"), "languages")
    langs = sorted(r["lang"] for r in packed.select("lang").collect())
    slabs = []
    for at in range(0, len(langs), slab):
        part = langs[at : at + slab]
        found = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in packed.where(F.col("lang").isin(part)).collect()}
        n = np.stack([found[lang] for lang in part], axis=1).astype(np.float64)
        slabs.append((part, np.vstack([np.log(n[:-1] + 0.5) - np.log((n[:-1] + 0.5).sum(axis=0)), np.log(n[-1:])]).astype(np.float32)))
    remove(packed)
    return slabs


def multiplied(texts: list[str | None], matrix: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Log likelihood of each text by language, texts x languages: the sparse matrix of n-gram counts times `matrix`."""
    rows = [np.unique(features(t or "", bits), return_counts=True) for t in texts]
    edges = np.concatenate([[0], np.cumsum([len(at) for at, _ in rows])])
    column, count = (np.concatenate([r[k] for r in rows]) if rows else np.empty(0, np.int64) for k in (0, 1))
    out = np.zeros((len(texts), matrix.shape[1]))
    full = np.flatnonzero(np.diff(edges))  # rows with n-grams
    step = max(1, PRODUCTS // max(1, matrix.shape[1]))
    for lo in range(0, int(edges[-1]), step):
        hi = min(lo + step, int(edges[-1]))
        here = full[(edges[full] < hi) & (edges[full + 1] > lo)]
        products = matrix[column[lo:hi]] * count[lo:hi, None].astype(np.float64)
        out[here] += np.add.reduceat(products, np.maximum(edges[here], lo) - lo, axis=0)
    return out + matrix[-1]


_FOUND = pa.schema([("lang_pred", pa.string()), ("best", pa.float64()), ("mass", pa.float64())])


def predict(docs: DataFrame, model: list[tuple[list[str], np.ndarray]], text: str = "text", bits: int = BITS) -> DataFrame:
    """Columns row, lang_pred string, score double (posterior probability of that language)."""
    out = _slab(docs, model[0] if model else ([], np.zeros((1, 0), np.float32)), text, bits, first=True)
    for part in model[1:]:
        out = _slab(out, part, text, bits, first=False)
    score = F.when(F.col("lang_pred") == UNKNOWN, 0.0).otherwise(1.0 / F.col("mass"))
    return out.select("row", "lang_pred", score.alias("score"))


def _slab(docs: DataFrame, part: tuple[list[str], np.ndarray], text: str, bits: int, first: bool) -> DataFrame:
    """The best language so far, its log probability, and the summed probabilities as multiples of its own."""
    sent = docs.sparkSession.sparkContext.broadcast(part)

    def start():
        langs, matrix = sent.value

        def run(row: pa.StructArray) -> list:
            texts = (row if first else row.field("row")).field(text).to_pylist()
            known = [k for k, t in enumerate(texts) if langs and t is not None and _LETTER.search(t)]
            logs = multiplied([texts[k] for k in known], matrix, bits)
            before = None if first else [row.field(c).to_pylist() for c in _FOUND.names]
            lang, best, mass = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            for k, x in zip(known, logs):
                at = int(np.argmax(x))
                lang[k], best[k], mass[k] = langs[at], float(x[at]), float(np.exp(x - x[at]).sum())
                if before:
                    old = before[1][k]
                    if old >= best[k]:
                        lang[k], best[k], mass[k] = before[0][k], old, before[2][k] + mass[k] * float(np.exp(best[k] - old))
                    else:
                        mass[k] += before[2][k] * float(np.exp(old - best[k]))
            return [lang, best, mass]

        return run

    out = with_results(docs, start, _FOUND)
    return out if first else out.select("row.row", *_FOUND.names)
