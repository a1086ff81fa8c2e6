"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode, where executors see the driver's folders."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docketlab-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/plans-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: it cuts lineage, and a lost executor loses nothing."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that :func:`written` made and that no plan still to be run reads."""
    path = getattr(df, "_scratch", None)
    if path:
        delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
