"""Folders for what a job writes and reads again: in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def shared(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: the session's spark.checkpoint.dir, or what was given to
    setCheckpointDir. Only a local session may go without: it gets a temporary one. On a cluster such a folder would lie on
    each machine's own disk, so an error is raised there."""
    held = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if held:
        return held
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="wardlake-")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared one."""
    return f"{shared(spark)}/{name}-{uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that is no longer read, wherever it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
