"""Folders for files that are written to be read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder that executors share, below `spark.checkpoint.dir`; it goes when the driver ends.

    Where that is unset, a local master gets a folder of its own; elsewhere it is an error.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.gettempdir()
    path = f"{root.rstrip('/')}/lectern-files/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return f"{path}/{name}"
