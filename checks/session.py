"""A shared folder for sessions that name none: only for ``local`` masters, where one process reads and writes it."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def with_folder(spark: SparkSession) -> SparkSession:
    """The session, with a temporary checkpoint folder if it has none and runs in this process alone."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortmill-"))
    return spark
