"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Where none is set, one of our own, but only where driver and
    executors are one machine: on a cluster a machine's own folder would hide each executor's files from the others."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="sparktiles-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write a table to the shared checkpoint folder and go on from it.

    It fixes generated row numbers and range boundaries for retried tasks, cuts the lineage, and later passes read only
    the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/sparktiles-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
