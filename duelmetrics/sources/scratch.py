"""Folders for intermediate tables."""

import uuid

from pyspark.sql import SparkSession


_FOLDER = f"duelmetrics-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path that every executor can reach, removed when the session ends.

    It lies in the folder that ``spark.checkpoint.dir`` names, or else in the
    warehouse, which all executors share too. Paths of a process share a folder,
    which the file system is told to remove at the end.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/{_FOLDER}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.mkdirs(target):
        fs.deleteOnExit(target)
    return f"{folder}/{label}-{uuid.uuid4().hex}"
