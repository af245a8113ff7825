"""Folders of tables, through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder if it is there; works for any store Spark has a file system for."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
