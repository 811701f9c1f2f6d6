"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a session without one (tests) gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new shared folder and read it back.

    The lineage ends there: a lost executor costs no more than the tasks it was running.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
