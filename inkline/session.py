"""Session helpers: checkpoint folder and shuffle width."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for cut lineage.

    The cluster's ``spark.checkpoint.dir`` wins. Only a local session without
    one gets a temporary folder; a cluster session without one is an error,
    because a machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="inkline-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Write a table to the checkpoint folder and read it back.

    The result survives lost executors and has no lineage, and unlike an RDD
    checkpoint the plan runs once and the new scan carries size statistics.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/inkline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
