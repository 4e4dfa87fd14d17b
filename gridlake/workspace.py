"""Intermediate tables in the shared folder of the cluster.

Small derived tables (a dimension, group statistics, hourly prices) are written once and read
back. That cuts lineage, so a lost executor costs a re-read and not a recomputation, and it gives
the planner the real file size: the table is broadcast only if it is below
`spark.sql.autoBroadcastJoinThreshold`, and joined by a shuffle otherwise.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a temporary one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gridlake-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{workspace_root(spark)}/gridlake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the part of the workspace that belongs to this application."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clean_workspace(spark: SparkSession) -> None:
    """Delete everything this application wrote to the workspace; call it when no result is needed any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the workspace and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
