"""Cutting lineage through the folder that all machines share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; only where none is set, and all is one machine, one is chosen here."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The rows, written once and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
