"""Names, small files and renames in whatever file system Spark has for a path."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's default file system has it."""
    system, found = _at(spark, path)
    return system.makeQualified(found).toString()


def split(spark: SparkSession, path: str) -> tuple[str, str, str]:
    """(scheme, authority, plain path) of a path, as Spark's default file system has it."""
    system, found = _at(spark, path)
    uri = system.makeQualified(found).toUri()
    return uri.getScheme(), uri.getAuthority() or "", uri.getPath()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it is missing."""
    system, found = _at(spark, path)
    return [s.getPath().getName() for s in system.listStatus(found)] if system.exists(found) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 where it is missing."""
    system, found = _at(spark, path)
    return system.getContentSummary(found).getLength() if system.exists(found) else 0


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    system, found = _at(spark, path)
    stream = system.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there whole or not at all: it is written beside its place and renamed."""
    system, found = _at(spark, path)
    system.mkdirs(found.getParent())
    beside = spark._jvm.org.apache.hadoop.fs.Path(found.getParent(), f".{found.getName()}-{uuid.uuid4().hex}")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(found):
        system.delete(found, False)
    if not system.rename(beside, found):
        raise OSError(f"could not put {path} in place")


def remove(spark: SparkSession, path: str) -> None:
    system, found = _at(spark, path)
    system.delete(found, True)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Let Spark list the many folders it is given in a few tasks a core, not one a folder."""
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(setting, before)
