"""Folders of the cluster's file system, whichever it is (only names; contents are read and written by Spark)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    system, path = _at(spark, folder)
    return system.exists(path)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders and files inside; none where there is no such folder."""
    system, path = _at(spark, folder)
    return sorted(f.getPath().getName() for f in system.listStatus(path)) if system.exists(path) else []


def remove(spark: SparkSession, folder: str) -> None:
    system, path = _at(spark, folder)
    system.delete(path, True)
