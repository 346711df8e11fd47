"""Shared pieces of the text operators: the shared folder, written tables, distributed ranks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

#: Used only where the session names no checkpoint folder (tests, one machine).
DEFAULT_SHARED = "file:///tmp/checkpoints"
BATCH_ROWS, BATCH_BYTES = 1_000, "16m"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir, or a default where it is unset and all tasks run
    in this process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir: {master} has executors on other machines")
        spark.sparkContext.setCheckpointDir(DEFAULT_SHARED)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete a table made by written(), once nothing lazy reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(conf).delete(path, True)


def ranked(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Add the 0-based global position of each row in the given order, without one task for all rows.

    Rows are range-partitioned and sorted, written once (so that the split is fixed), and each partition's
    offset, one number per partition, is added. Nulls come first. Ties get consecutive positions.
    """
    spark = df.sparkSession
    # The number of partitions is left to Spark; the last fields number the rows within their partition.
    dealt = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    dealt = dealt.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    at = F.monotonically_increasing_id()
    fixed = written(
        dealt.withColumn("__part", F.shiftrightunsigned(at, 33)).withColumn("__at", at.bitwiseAND(F.lit((1 << 33) - 1))),
        "ranked",
    )
    sizes = fixed.groupBy("__part").agg((F.max("__at") + 1).alias("__n"))
    # One row per partition: a window over them is small however large the table is.
    offsets = sizes.withColumn(
        "__before",
        F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select("__part", "__before")
    rows = {r["__part"]: r["__before"] for r in offsets.collect()}
    if not rows:
        return fixed.withColumn(name, F.lit(0).cast("long")).drop("__part", "__at")
    table = spark.createDataFrame(list(rows.items()), "__part long, __before long")
    return (
        fixed.join(F.broadcast(table), "__part")
        .withColumn(name, F.col("__before") + F.col("__at"))
        .drop("__part", "__at", "__before")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b: long): rows (node, root), root the smallest node, for nodes with an edge.

    Alternates large-star and small-star steps until the edge set is stable: O(log n) rounds, each a grouping and a
    join; the edges of a hub are aggregated before they are shuffled. Nulls, loops and repeated edges are ignored.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))).alias("e"))
        step = written(small.select("e.a", F.col("e.m").alias("b")).where("a <> b").distinct(), "edges")
        now = step.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        remove(edges)
        edges = step
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def small_batches(df: DataFrame) -> DataFrame:
    """df, with Arrow batches of at most BATCH_ROWS rows in its session: texts are long, and every Python worker holds
    a batch as Arrow and as strings. A larger setting of the session stays lowered, because plans read it when they run."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)  # and a few rows if they are very long
    return df


def with_results(df: DataFrame, start: Callable, fields: pa.Schema, keep: list[str] | None = None) -> DataFrame:
    """Apply Python to Arrow batches of df and keep the input beside the result.

    start() is called once in each task and returns a function from a batch's rows (pa.StructArray) to the columns
    named in fields. The result has the input row in the struct column `row`, untouched, so that input columns may have
    any names and types; with keep only these columns of it.
    """
    packed = small_batches(df).select(F.struct("*").alias("row"))
    kept = packed if keep is None else df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    schema = StructType(kept.schema.fields + from_arrow_schema(fields).fields)
    names, kinds = schema.names, fields.types

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = start()
        for batch in found:
            row = batch.column(0)
            back = row if keep is None else pa.StructArray.from_arrays([row.field(c) for c in keep], keep)
            yield pa.RecordBatch.from_arrays([back, *(pa.array(c, t) for c, t in zip(run(row), kinds))], names)
        batch = row = back = run = None
        pa.default_memory_pool().release_unused()  # an idle worker would keep it beside those that work

    return packed.mapInArrow(batches, schema)
