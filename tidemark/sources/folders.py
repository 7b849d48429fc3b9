"""Folders that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

_made: dict[str, SparkSession] = {}


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder of our own where a local session (tests) leaves that unset."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(named)
    return named


def shared(spark: SparkSession) -> str:
    """A new name in the shared folder; what is written there goes when the session ends, or by :func:`remove`."""
    path = f"{root(spark)}/session-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove_all)
    _made[path] = spark
    return path


def file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder."""
    fs, at = file_system(spark, path)
    return fs.getContentSummary(at).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)
    _made.pop(path, None)


def _remove_all() -> None:
    for path, spark in list(_made.items()):
        if spark.sparkContext._jsc is not None:
            remove(spark, path)
