"""Secret scans with multipart credential linking.

Base findings are reported as they are. Weaker candidates (identifiers, bare secrets, endpoints) are reported only if
the parts that complete them start within SCOPE characters in the same text: an identifier needs a secret, a bare
secret an identifier, an endpoint both. The parts of all texts meet in an interval join on cells of SCOPE characters,
so a cell holds few parts however long a text is.

A null text is empty. Every row gets its result; rows with equal id and text share it. Null ids and extra columns do not
matter: only doc_id and text are read. Findings with equal start are listed in the order of KINDS. Very long texts are
scanned whole, in time that grows with their length. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.llm.common import with_results, written

SCOPE = 300
#: Kinds in the order in which findings with equal start are listed. Fixed values, as are the patterns.
KINDS = ("assign", "access", "hex", "identifier", "bare", "endpoint")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_IDENTIFIER = re.compile(r"\b(?:ASIA|AROA|AIDA)[A-Z0-9]{16}\b|\b(?i:client|account|user|access)[_-]?(?i:id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._-]{6,}", re.A)
_BARE = re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{40,64}(?![A-Za-z0-9+/_-])", re.A)
_ENDPOINT = re.compile(r"https?://[^\s\"'<>]+", re.A)
_HEX_RUN = re.compile(r"[0-9a-f]{24,}")
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])


def base_spans(text: str) -> list[dict]:
    """Findings of the three base kinds."""
    out = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        out += [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if _HEX_RUN.search(text):
        out += [(2, m.start(), m.end()) for m in _HEX.finditer(text) if len(m[0]) >= 24]
    return [dict(zip(("kind", "start", "end"), s)) for s in sorted(out, key=lambda s: (s[1], s[0]))]


def weak_spans(text: str, base: list[dict]) -> list[dict]:
    """Candidates that count only beside complementary parts; none lies in a base finding."""
    low = text.lower()
    found = [(3, *m.span()) for m in _IDENTIFIER.finditer(text)] if any(w in low for w in ("id", "asia", "aroa")) else []
    found += [(4, *m.span()) for m in _BARE.finditer(text)]
    found += [(5, *m.span()) for m in _ENDPOINT.finditer(text)] if "://" in text else []
    # Base findings may overlap each other: of those that start before a candidate ends the furthest end decides.
    starts = [b["start"] for b in base]
    ends = list(accumulate((b["end"] for b in base), max))
    free = lambda a, z: (k := bisect_left(starts, z)) == 0 or ends[k - 1] <= a
    return [{"kind": k, "start": a, "end": z} for k, a, z in found if free(a, z)]


def _parts(row: pa.StructArray) -> list:
    texts = [t or "" for t in row.field("text").to_pylist()]
    base = [base_spans(t) for t in texts]
    # A weak candidate never completes itself: texts with one kind of part only have nothing to link.
    weak = [weak_spans(t, b) for t, b in zip(texts, base)]
    return [base, weak]


def _near(parts: DataFrame, others: DataFrame, scope: int) -> DataFrame:
    """The parts with one of the others within scope in the same text."""
    cell = (F.col("start") / scope).cast("long")
    there = others.select(
        *[F.col(c).alias(f"{c}_") for c in ("doc_id", "text_hash")], F.col("start").alias("start_"),
        F.explode(F.sequence(cell - 1, cell + 1)).alias("cell_"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("text_hash") == F.col("text_hash_")) & (F.col("cell") == F.col("cell_"))
    return parts.withColumn("cell", cell).join(there, same & (F.abs(F.col("start") - F.col("start_")) <= scope), "left_semi").drop("cell")


def credentials(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Columns doc_id, base and spans: arrays of (start, kind, end), sorted, of the base and of all findings."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = with_results(rows, lambda: _parts, pa.schema([("base", pa.list_(_SPAN)), ("weak", pa.list_(_SPAN))]))
    rows = written(rows.select("row.doc_id", "row.text_hash", "base", "weak"), "parts")
    each = rows.where(F.size("weak") > 0).select("doc_id", "text_hash", F.explode(F.concat("base", "weak")).alias("s")).select("doc_id", "text_hash", "s.*").distinct()
    secrets = each.where(F.col("kind").isin(0, 2, 4))
    identifiers = each.where(F.col("kind").isin(1, 3))
    linked = _near(each.where("kind = 3"), secrets, scope).unionByName(_near(each.where("kind = 4"), identifiers, scope))
    linked = linked.unionByName(_near(_near(each.where("kind = 5"), identifiers, scope), secrets, scope))
    found = linked.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))
    found = found.select(F.col("doc_id").alias("doc_id_"), F.col("text_hash").alias("text_hash_"), "linked")
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("text_hash") == F.col("text_hash_")), "left")
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return out.select("doc_id", F.array_sort(base).alias("base"), F.array_sort(F.concat(base, F.coalesce("linked", F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>")))).alias("spans"))
