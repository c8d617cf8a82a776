"""Existence and removal of folders on any file system Hadoop knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _resolve(spark, path)
    return filesystem.exists(target)


def delete_folder(spark: SparkSession, path: str) -> bool:
    filesystem, target = _resolve(spark, path)
    return filesystem.delete(target, True)
