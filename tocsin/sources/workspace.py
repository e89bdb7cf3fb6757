"""Where written tables go: the shared folder that every executor can read."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a new folder of
    its own. On a cluster a machine-local folder would lose data with its
    machine, so there the missing setting is an error.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tocsin-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back.

    Several consumers then read the written rows instead of computing them
    again, and a lost executor costs a re-read only.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
