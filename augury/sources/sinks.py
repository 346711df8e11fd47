"""Parquet sinks with receipts that are checked by reading back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from augury.operators import book


def _digest() -> Column:
    """Order-insensitive digest of rows: their number and the sum of their hashes."""
    return F.sum(F.col("__h").cast("decimal(38,0)")).cast("string").alias("digest")


def write_tape(tape: DataFrame, path: str, buckets: int = 4) -> DataFrame:
    """Write tape rows (stream, offset, market, ...) in folders by hash of the market; returns the receipt read back
    from what was written: per stream first and last offset, rows and digest. Raises if anything differs."""
    bucket = (F.conv(F.substring(F.sha2(F.col("market").cast("string"), 256), 1, 8), 16, 10).cast("long") % buckets).cast("int")
    tape.withColumn("bucket", bucket).repartition("bucket", "market").sortWithinPartitions("market", "offset").write.partitionBy("bucket").parquet(path)
    back = tape.sparkSession.read.parquet(path)
    receipt = lambda df: df.withColumn("__h", F.xxhash64(*tape.columns)).groupBy("stream").agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("n"), _digest())
    written, wanted = receipt(back), receipt(tape)
    if wanted.exceptAll(written).limit(1).count() or written.exceptAll(wanted).limit(1).count():
        raise ValueError(f"{path}: what was read back is not what was written")
    return written


def write_observations(rows: DataFrame, path: str, bundle_rows: int = 10_000) -> DataFrame:
    """Write occurrences (position, source, raw) with each payload of a bundle stored once; returns by bundle the
    occurrences, raw, unique and saved bytes. Bundles are ranges of positions. Raises if a payload cannot be rebuilt.

    A bundle lies whole in one file, which holds many, sorted: files grow with the bytes, not with tasks times bundles.
    """
    keyed = rows.withColumns({"bundle": F.floor(F.col("position") / bundle_rows), "sha": F.sha2(F.col("raw").cast("binary"), 256)})
    keyed.drop("raw").repartition("bundle").sortWithinPartitions("bundle", "position").write.parquet(f"{path}/occurrences")
    keyed.repartition("bundle").groupBy("bundle", "sha").agg(F.first("raw").alias("raw")).sortWithinPartitions("bundle", "sha").write.parquet(f"{path}/payloads")
    read = rows.sparkSession.read.parquet
    rebuilt = read(f"{path}/occurrences").join(read(f"{path}/payloads"), ["bundle", "sha"], "left")
    length = F.octet_length("raw").cast("long")
    first = F.row_number().over(Window.partitionBy("bundle", "sha").orderBy("position")) == 1
    sized = rebuilt.select("bundle", "sha", "position", length.alias("__bytes"), F.col("sha").eqNullSafe(F.sha2(F.col("raw").cast("binary"), 256)).alias("__ok"))
    marked = sized.withColumn("__first", first)
    out = marked.groupBy("bundle").agg(F.count("*").alias("occurrences"), F.sum("__bytes").alias("raw_bytes"), F.sum(F.when(F.col("__first"), F.col("__bytes")).otherwise(0)).alias("unique_bytes"), F.count_if(~F.col("__ok")).alias("bad"))
    if out.where("bad > 0").limit(1).count():
        raise ValueError(f"{path}: a payload was not rebuilt")
    return out.select("bundle", "occurrences", "raw_bytes", "unique_bytes", (F.col("raw_bytes") - F.col("unique_bytes")).alias("saved_bytes"))


def write_outputs(outputs: dict[str, DataFrame], path: str) -> DataFrame:
    """Write named tables in folders of their own; returns by table the rows and the digest read back. Raises if anything
    differs from what was to be written."""
    receipts = None
    for name, df in outputs.items():
        df.write.parquet(f"{path}/{name}")
        receipt = lambda d: d.withColumn("__h", F.xxhash64(*df.columns)).agg(F.count("*").alias("n"), _digest())  # noqa: B023, E731
        back = receipt(df.sparkSession.read.parquet(f"{path}/{name}"))
        if back.first() != receipt(df).first():
            raise ValueError(f"{path}/{name}: what was read back is not what was written")
        back = back.select(F.lit(name).alias("table"), "n", "digest")
        receipts = back if receipts is None else receipts.unionByName(back)
    return receipts


def write_checkpoint(rows: DataFrame, cut: int, path: str) -> DataFrame:
    """Write the ladders of every book at the cut and the markets without a baseline by then; returns the receipt."""
    levels, without = book.checkpoint(rows, cut)
    return write_outputs({"levels": levels, "without_baseline": without}, path)
