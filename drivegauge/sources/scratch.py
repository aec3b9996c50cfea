"""Paths below the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``; only a local session without that setting takes one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that all executors share")
        root = "/tmp/checkpoints/drivegauge"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back, so that its rows and their order in files are settled."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
