"""Hadoop file-system calls, for folders only the driver needs to know about."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _path(spark, path)
    fs.mkdirs(jvm_path)


def finished_folders(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the sub-folders whose write was committed, ascending."""
    marks, fs = _path(spark, f"{path}/*/_SUCCESS")
    found = fs.globStatus(marks) or []
    return sorted(int(status.getPath().getParent().getName()) for status in found)


def folder_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the sub-folders that are named by one, ascending."""
    names, fs = _path(spark, f"{path}/*")
    return sorted(int(n) for status in fs.globStatus(names) or [] if (n := status.getPath().getName()).isdigit())


def partition_folders(spark: SparkSession, pattern: str, value: str) -> list[str]:
    """Folders that fit ``pattern`` whose last part is a partition of this value."""
    names, fs = _path(spark, pattern)
    paths = [status.getPath() for status in fs.globStatus(names) or []]
    # Characters that paths cannot hold are written as %XX.
    return sorted(str(path.toString()) for path in paths if unquote(path.getName()).partition("=")[2] == value)


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _path(spark, path)
    fs.delete(jvm_path, True)
