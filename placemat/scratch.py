"""Intermediate tables in the folder all executors share.

A written table cuts lineage and survives the loss of executors, and unlike a
checkpointed RDD it can be read back column by column.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_for_local_sessions: str | None = None


def use_for_local_sessions(folder: str) -> None:
    """Name the folder of local sessions that do not set ``spark.checkpoint.dir``."""
    global _for_local_sessions
    _for_local_sessions = folder


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Who sets it owns it: nothing here deletes tables, as a frame may still read them.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if _for_local_sessions and spark.sparkContext.master.startswith("local"):
        return _for_local_sessions
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return the frame that reads it back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
