"""Shared storage for intermediate tables.

A table that several steps read (extracted fields, candidate pairs, hot blocks) is
written once as Parquet and read back: its lineage ends there, so a lost executor costs a
re-read and not a second pass over the document texts, and the planner knows its size.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_root(application: str) -> str:
    root = tempfile.mkdtemp(prefix=f"docmeld-{application}-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_root(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir`` of the session.

    Only a local session, where driver and executors are one machine, may go without it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root(spark.sparkContext.applicationId)
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def _folder(spark: SparkSession, path: str):
    """The file system that Spark uses for a path, and the path as it takes it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, where = _folder(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; one that does not exist is no matter."""
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    """Give all files below a folder a time stamp, as a restored archive has."""
    fs, where = _folder(spark, path)
    files = fs.listFiles(where, True)
    while files.hasNext():
        fs.setTimes(files.next().getPath(), millis, -1)


class Workspace:
    """One run's own folder under the shared root."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_root(spark)}/run-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the scan of the written table."""
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Delete the folder once nothing reads its tables any more."""
        remove(self.spark, self.root)
