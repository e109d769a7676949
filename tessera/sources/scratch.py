"""Folders for files a job writes and reads again, in the storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; under a temporary folder only where that is unset and all is on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tessera-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


#: Of sorted texts what differs from the one before is written.
COMPACT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def materialized(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df, written once and read back, for what several parts of a job use."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
