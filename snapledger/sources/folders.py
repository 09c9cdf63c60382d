"""Folder names below a path, through the file system Spark itself uses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

# How tables are stored: keys are hex digests, which only an entropy coder makes smaller.
STORED = {"compression": "zstd"}


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders and files directly below ``path``; none if it does not exist."""
    return [s.getPath().getName() for s in _listing(spark, path)]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    return [s.getPath().getName() for s in _listing(spark, path) if s.isDirectory()]


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and modification time of the data files directly below ``path``, by name."""
    found = [s for s in _listing(spark, path) if s.isFile() and s.getPath().getName()[0] not in "._"]
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found)


def _listing(spark: SparkSession, path: str) -> list:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.listStatus(folder)) if fs.exists(folder) else []


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def dated_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Sorted ISO dates found as ``column=<date>`` folders below ``path``."""
    prefix = f"{column}="
    found = []
    for name in subfolders(spark, path):
        if name.startswith(prefix):
            try:
                found.append(dt.date.fromisoformat(name[len(prefix) :]).isoformat())
            except ValueError:
                continue
    return sorted(found)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file; one that is there already stays an empty file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()
