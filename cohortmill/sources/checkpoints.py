"""Intermediate tables in the shared folder the cluster names.

A table used by several later steps is written once, so that later steps neither repeat the work nor
carry its plan, and survive lost executors. Parquet keeps column pruning and filters for the readers.

Each application writes below a folder of its own, ``cohortmill-<application id>``. Nothing here deletes
it, as readers may come later: remove the folders of applications that have ended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the folder given to ``setCheckpointDir``; one of them must be named."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def new_path(spark: SparkSession, name: str = "table") -> str:
    """A path not used before, in this application's part of the shared folder."""
    own = f"cohortmill-{spark.sparkContext.applicationId}"
    return f"{shared_folder(spark).rstrip('/')}/{own}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows, written once and read back."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
