"""Intermediate tables that several branches of a job read."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Without that setting a session on one machine gets a temporary folder; on a cluster, where
    executors would not see it, the job is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or tempfile.mkdtemp(prefix="run-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    shared = shared_dir(spark)
    return f"{shared.rstrip('/')}/lakeshift/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result as a Parquet table on shared storage and read it back.

    Used where several branches need one expensive result: it is computed once, survives lost
    executors without being recomputed, and each branch still reads only its columns.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
