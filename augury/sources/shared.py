"""The folder that driver and executors share, and tables that are written there to end a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession, name: str = "stream") -> str:
    """A new folder in spark.checkpoint.dir, or a local one where that is unset (one machine)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir: executors on other machines do not see this one's folders")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix=f"{name}-")


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df as Parquet in the shared folder, read back: a lost executor costs no earlier step."""
    path = f"{work_dir(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {f.rsplit("/", 2)[0] for f in df.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
