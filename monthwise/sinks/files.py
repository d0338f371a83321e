"""Small text files beside the tables, in whatever file system these are in."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that readers see whole or not at all; one that is there stays."""
    where, files = _at(spark, path)
    folder, name = path.rsplit("/", 1)
    part, _ = _at(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = files.create(part)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(part, where):
        files.delete(part, False)
        if not files.exists(where):
            raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    where, files = _at(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and folders that fit a path pattern."""
    where, files = _at(spark, pattern)
    return [s.getPath().getName() for s in files.globStatus(where) or []]


def delete(spark: SparkSession, path: str) -> None:
    where, files = _at(spark, path)
    files.delete(where, True)
