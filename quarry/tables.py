"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, a local one, for a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + os.path.join(tempfile.gettempdir(), "quarry-shared")
    return path.rstrip("/")


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read back, so that later stages need no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/quarry-{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Delete the tables that kept_table has written so far; to be called when the results that read them are stored."""
    jvm = spark.sparkContext._jvm
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df: DataFrame) -> DataFrame:
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
