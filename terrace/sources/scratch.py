"""Tables that a computation writes for itself, in a folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone already
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder below the one that spark.checkpoint.dir names, or the warehouse. It goes when the interpreter ends."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written and read again: its lineage ends there, and lost executors don't cost more than reading."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
