"""Small files on the shared folder: listed, read, and written once, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds; nothing if there is no such folder."""
    files, where = _located(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _located(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole or not at all; False if there is one already."""
    files, where = _located(spark, path)
    if files.exists(where):
        return False
    _, unfinished = _located(spark, f"{path}.unfinished")
    stream = files.create(unfinished, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return files.rename(unfinished, where)


def remove(spark: SparkSession, path: str) -> None:
    files, where = _located(spark, path)
    files.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Give a file or folder its final name, at once; False if that name is taken already."""
    files, where = _located(spark, target)
    if files.exists(where):
        return False
    files.mkdirs(where.getParent())
    return files.rename(_located(spark, source)[1], where)
