"""SimHash fingerprints with DataFrame functions only, and the search for all fingerprints within a Hamming radius.

The terms of a text are its adjacent word pairs (the last word stands alone); each occurrence votes with the 128 bits
of its hash, so a term weighs as much as it occurs, and a bit is set if more than half of the votes set it. Four votes
share a long while they are summed, in chunks short enough for 16 bits each.

A null text is an empty one; equal texts have equal fingerprints. Rows with equal id and text are one document with as
many output rows. A null id sorts first and is no query unless all rows are; ties in the order of ids go by a hash of the
text. Very long texts vote in chunks. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.llm.common import ranked, written

#: Near copies (five-word Jaccard of 0.75 at least) lie 4 to 24 bits apart at sf0.1, 96 % of them at most this far.
RADIUS = 20
_CHUNK = 30_000
_LANES = 0x0001000100010001
_WIDE = 0x0000FFFF0000FFFF
_SPLIT = r"[\x20\x09-\x0D]+"


def terms(text: Column) -> Column:
    """Hash of each term occurrence."""
    words = F.transform(F.split(text, _SPLIT), lambda w: F.xxhash64(w))
    return F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, f0, f1: long) for texts with the columns keys and `terms`; keys identify the rows."""
    each = texts.select(*keys, F.posexplode("terms").alias("pos", "h0"))
    each = each.select(*keys, F.floor(F.col("pos") / _CHUNK).alias("chunk"), "h0", F.xxhash64("h0").alias("h1"))
    lane = lambda h, i: F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES)))
    sums = each.groupBy(*keys, "chunk").agg(F.count("*").alias("n"), *[lane(f"h{k}", i).alias(f"s{k}_{i}") for k in (0, 1) for i in range(16)])
    # Chunks of one text are added in lanes of 32 bits: even quarters of each long, then odd ones.
    wide = [
        F.sum((F.col(f"s{k}_{i}") if odd == 0 else F.shiftrightunsigned(f"s{k}_{i}", 16)).bitwiseAND(F.lit(_WIDE))).alias(f"w{k}_{i}_{odd}")
        for k in (0, 1) for i in range(16) for odd in (0, 1)
    ]
    votes = sums.groupBy(*keys).agg(F.sum("n").alias("n"), *wide)

    def bits(k: int) -> Column:
        out = F.lit(0).cast("long")
        for i in range(16):
            for lane_ in range(4):
                ones = F.shiftrightunsigned(f"w{k}_{i}_{lane_ % 2}", 32 * (lane_ // 2)).bitwiseAND(F.lit(0xFFFFFFFF))
                at = 16 * lane_ + i
                value = (1 << at) - (1 << 64 if at == 63 else 0)
                out = out.bitwiseOR(F.when(2 * ones > F.col("n"), F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
        return out

    return votes.select(*keys, bits(0).alias("f0"), bits(1).alias("f1"))


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Number of differing bits."""
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def shown(f0: Column, f1: Column) -> Column:
    """Fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f0), 16, "0")))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs (q0, q1, f0, f1) of a fingerprint of queries and another one of prints, both with columns f0 and f1, at
    most radius apart, each pair once.

    The bits are cut into so many blocks that such a pair differs in two bits of one block at most. Fingerprints are
    dealt into a table for each block by the block's value; queries look every table up under all values that differ in
    two bits at most. A pair counts in the first table only that it meets in. Equal fingerprints are taken together
    before, so copies make no pairs, and the distance is checked as the rows meet: nothing else leaves the join.
    """
    n = max(2, radius // 3 + 1)
    edges = [128 * i // n for i in range(n + 1)]

    def block(i: int, low: str, high: str) -> Column:
        lo, hi = edges[i], edges[i + 1]
        mask = F.lit(-1 if hi - lo == 64 else (1 << (hi - lo)) - 1).cast("long")
        if hi <= 64:
            found = F.shiftrightunsigned(low, lo)
        elif lo >= 64:
            found = F.shiftrightunsigned(high, lo - 64)
        else:
            found = F.shiftrightunsigned(low, lo).bitwiseOR(F.shiftleft(high, 64 - lo))
        return found.bitwiseAND(mask)

    def flips(i: int) -> Column:
        """Long values with at most so many bits of the block set as a pair may differ in there."""
        width = edges[i + 1] - edges[i]
        sets = [c for k in range(min(2, radius // n) + 1) for c in combinations(range(width), k)]
        values = [sum(1 << b for b in c) for c in sets]
        return F.expr(f"array({', '.join(f'bigint({v - (1 << 64) * (v >> 63)})' for v in values)})")

    table = lambda i, value: F.xxhash64(F.lit(i), value)
    own, asked = prints.select("f0", "f1").distinct(), queries.select(F.col("f0").alias("q0"), F.col("f1").alias("q1")).distinct()
    # The looks multiply after this exchange, which Spark would take for a small one and gather in few tasks.
    asked = asked.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = own.select("f0", "f1", F.explode(F.array(*[table(i, block(i, "f0", "f1")) for i in range(n)])).alias("key"))
    around = lambda i: F.transform(flips(i), lambda bits: table(i, block(i, "q0", "q1").bitwiseXOR(bits)))
    looked = asked.select("q0", "q1", F.explode(F.concat(*map(around, range(n)))).alias("at"))
    near = distance((F.col("f0"), F.col("f1")), (F.col("q0"), F.col("q1")))
    differing = [block(i, "f0", "f1").bitwiseXOR(block(i, "q0", "q1")) for i in range(n)]
    first = F.coalesce(*[F.when(F.bit_count(d) <= min(2, radius // n), table(i, block(i, "f0", "f1"))) for i, d in enumerate(differing)])
    return looked.hint("merge").join(dealt, (F.col("at") == F.col("key")) & near.between(1, radius) & (F.col("key") == first)).select("q0", "q1", "f0", "f1")


def edited_and_next(docs: DataFrame) -> DataFrame:
    """For each different (doc_id, text): both fingerprints, sizes, and the place in the order of ids.

    Columns doc_id, n_chars, copies, rank, edited_sha256, f0, f1, e0, e1. The edited text has its last half replaced
    by the first characters of the next document. Texts are shuffled once whole, by id and hash, and the part of a
    text that the document before needs once more.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(0).cast("long")).alias("k"), F.xxhash64("text", F.col("doc_id").isNull()).alias("h"), "text")
    sizes = docs.groupBy("k", "h").agg(F.max("doc_id").alias("doc_id"), F.max(F.char_length("text")).cast("long").alias("n"), F.count("*").alias("copies"))
    order = ranked(sizes, ["doc_id", "h"])
    total = order.count()
    before = order.select(((F.col("rank") + 1) % F.lit(max(1, total))).alias("rank"), F.col("k").alias("p_k"), F.col("h").alias("p_h"), F.floor(F.col("n") / 2).alias("need"))
    order = written(order.join(before, "rank"), "order")
    texts = docs.groupBy("k", "h").agg(F.first("text").alias("text"))
    placed = texts.join(order, ["k", "h"])
    heads = placed.select(F.col("p_k").alias("k"), F.col("p_h").alias("h"), F.expr("substring(text, 1, cast(need as int))").alias("head"))
    edited = F.concat(F.expr("substring(text, 1, cast(n - floor(n / 2) as int))"), "head")
    both = placed.join(heads, ["k", "h"]).select("k", "h", "text", edited.alias("edited"))
    kinds = F.array(F.struct(F.lit(0).alias("which"), terms(F.col("text")).alias("terms")), F.struct(F.lit(1).alias("which"), terms(F.col("edited")).alias("terms")))
    prints = fingerprints(both.select("k", "h", F.explode(kinds).alias("x")).select("k", "h", "x.which", "x.terms"), ["k", "h", "which"])
    pick = lambda c, which: F.max(F.when(F.col("which") == which, F.col(c)))
    prints = prints.groupBy("k", "h").agg(pick("f0", 0).alias("f0"), pick("f1", 0).alias("f1"), pick("f0", 1).alias("e0"), pick("f1", 1).alias("e1"))
    shas = both.select("k", "h", F.sha2("edited", 256).alias("edited_sha256"))
    out = order.select("k", "h", "doc_id", F.col("n").alias("n_chars"), "copies", "rank").join(shas, ["k", "h"]).join(prints, ["k", "h"])
    return written(out.drop("k", "h"), "prints")


def likeness(docs: DataFrame, radius: int = RADIUS, queries: Column | None = None) -> DataFrame:
    """One row per row of docs: the fingerprints and how alike they are, the class of equal fingerprints (its least
    id) and, for documents for which queries (a condition on doc_id; all if not given) holds, the number of other
    fingerprints within the radius; null for the rest."""
    rows = edited_and_next(docs)
    total = rows.count()
    following = rows.select(((F.col("rank") + F.lit(max(1, total) - 1)) % F.lit(max(1, total))).alias("rank"), F.col("f0").alias("x0"), F.col("f1").alias("x1"))
    asks = F.lit(True) if queries is None else F.coalesce(queries, F.lit(False))
    found = within_radius(rows.where(asks), rows, radius).groupBy("q0", "q1").agg(F.count("*").alias("n_links"))
    classes = rows.groupBy("f0", "f1").agg(F.min("doc_id").alias("class_id"))
    # Written first, so that the join below is dealt by itself and Spark can split the rows of a class of many copies.
    facts = written(classes.join(found, (F.col("f0") == F.col("q0")) & (F.col("f1") == F.col("q1")), "left").select("f0", "f1", "class_id", "n_links"), "classes")
    own, other, after = ((F.col(a), F.col(b)) for a, b in (("f0", "f1"), ("e0", "e1"), ("x0", "x1")))
    alike = lambda a, b: 1.0 - distance(a, b) / F.lit(128.0)
    out = written(rows.join(following, "rank"), "following").join(facts, ["f0", "f1"])
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", shown(*own).alias("fingerprint"), shown(*other).alias("edited_fingerprint"),
        alike(own, other).alias("near_edited"), alike(own, after).alias("near_next"),
        "class_id", F.when(asks, F.coalesce("n_links", F.lit(0).cast("long"))).alias("n_links"),
    )
