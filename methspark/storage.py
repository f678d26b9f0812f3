"""The folder that all executors share, and tables stored in it."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; where it is unset, a temporary folder in local mode and an error on a cluster."""
    if spark.sparkContext.getCheckpointDir() is None:
        base, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
        if base is None and master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(base or tempfile.mkdtemp(prefix="methspark-"))
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def folder(spark: SparkSession) -> str:
    """A new name in the shared folder."""
    return f"{shared(spark)}/{uuid4()}"


def stored(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, with no lineage; executors may come and go."""
    shared(df.sparkSession)
    return df.checkpoint()
