"""Paths in whatever store Spark reads and writes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    """Hadoop's view of a path: its file system and itself."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return store.exists(where)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the path was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    store, where = _store(spark, path)
    store.delete(where, True)
