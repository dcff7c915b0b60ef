"""Files and folders beside the tables, through the file system that Spark itself uses."""

from __future__ import annotations

import fnmatch

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none for a folder that does not exist."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def is_file(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isFile()


def holds(spark: SparkSession, path: str, pattern: str | None = None) -> bool:
    """Whether a path is a file, or a folder with files at any depth; with a pattern, files whose name matches it."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return False
    found = fs.listFiles(where, True)
    while found.hasNext():
        name = found.next().getPath().getName()
        if not name.startswith(("_", ".")) and (pattern is None or fnmatch.fnmatchcase(name, pattern)):
            return True
    return False


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    if fs.exists(where):
        fs.delete(where, True)
