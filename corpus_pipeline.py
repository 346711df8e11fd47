"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, tokens.

Each stage takes the documents that the stage before kept and returns documents with the same columns; the last one
returns their tokens. Nulls, empty texts, ties, repeated rows and extra columns are handled as the operators say:
null and empty texts are rejected by the quality stage; of rows that repeat an id and text near-dedup keeps one. Very
long texts go through whole, each in one row; an empty table gives empty tables in every stage and no rows in the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augury.llm import bpe, lines, queries, wumanber
from augury.llm.common import written
from augury.llm.minhash import near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier, trained on labelled good ones, accepts."""
    judged = queries.quality(docs, queries.table(spark, sf_dir, "labels"))
    return judged.where("accepted").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source.

    Equal texts count once and a document is never emptied, because copies are left to the next stage; a line must be in
    three texts, because in a source of under a hundred documents one of them is already over the ratio.
    """
    found = lines.without_boilerplate(docs, F.col("source"), ratio=lines.SOURCE_RATIO, distinct=True, least_pages=3, spare=True)
    new = {"text": F.col("clean"), "n_chars": F.when(F.col("n_dropped") > 0, F.char_length("clean").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the least id, then text hash, then any of equal rows.

    Null ids come last. Only rows that repeat an id and text are grouped with their texts, partially before the shuffle.
    """
    found = near_duplicates(docs, roots=True)
    each = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    alone = F.when(F.col("root").isNull(), F.struct("doc_id", "text_hash"))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"), F.col("n").alias("n")))
    kept = written(each.groupBy("root", alone.alias("alone")).agg(first.alias("x")).select("x.k_id", "x.k_hash", "x.n"), "kept")
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    same = F.col("id").eqNullSafe(F.col("k_id")) & (F.col("hash") == F.col("k_hash"))
    once = packed.join(kept.where("n = 1"), same, "left_semi").select("row")
    repeated = packed.join(kept.where("n > 1"), same, "left_semi")
    one = repeated.groupBy("id", "hash").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return once.unionByName(one).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = wumanber.contamination(docs, queries.table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes that they decode to."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(docs.select("doc_id", "text"), path, pattern, keep=["doc_id"], with_bytes=True)
    return queries.digests(encoded, "ids")


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]

#: A language model's perplexity is beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before has written to the shared folder."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
