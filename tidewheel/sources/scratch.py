"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session that names none gets a temporary one; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidewheel-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def folder(spark: SparkSession, tag: str) -> str:
    """A new place for a table."""
    return f"{shared(spark).rstrip('/')}/tidewheel-{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame) -> DataFrame:
    """A reliable checkpoint."""
    shared(df.sparkSession)
    return df.checkpoint()
