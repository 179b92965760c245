"""Paths on whatever file system Spark is configured for (local, HDFS, object store)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def has_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """Stops at the first match: a large folder is not listed in full."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return False
    files = fs.listFiles(target, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(suffix):
            return True
    return False


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """Last path part of every folder matching a glob; files are not listed."""
    fs, target = _path(spark, pattern)
    return [status.getPath().getName() for status in fs.globStatus(target) or []]


def file_names(spark: SparkSession, pattern: str) -> list[str]:
    """Last path part of every file matching a glob."""
    fs, target = _path(spark, pattern)
    return [status.getPath().getName() for status in fs.globStatus(target) or [] if status.isFile()]


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of that name: False then. The file system decides between two writers."""
    fs, target = _path(spark, path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        if fs.exists(target):
            return False
        raise error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _path(spark, path)
    source = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
