"""Folders that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, else the context's; where neither is set a temporary one, in local mode only."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="tidemark-")


def fresh(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
