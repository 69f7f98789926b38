"""Intermediate tables in the folder that driver and executors share, to cut lineage and decide each row once."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset and all runs on one machine (tests), a temporary folder that goes with the process."""
    if at := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="spark-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{own}")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table of its own, read again."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
