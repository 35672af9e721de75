"""Folders on whatever file system Spark's paths lead to.

Uses the session's Java gateway, so these helpers need a classic session, not
Spark Connect. Only names of folders and markers are looked at, never data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in one folder; none if there is no such folder."""
    folder, files = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all that is in it; whether there was one."""
    folder, files = _folder(spark, path)
    return files.exists(folder) and files.delete(folder, True)
