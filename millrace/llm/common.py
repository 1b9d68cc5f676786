"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="millrace-")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only where that is unset and all tasks run in this process."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
    return shared or _own_dir()


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out.millrace_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized frame that nothing reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.millrace_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
