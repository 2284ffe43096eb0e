"""Folder metadata, through the file system the cluster is configured with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def create(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.mkdirs(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.delete(folder, True)
