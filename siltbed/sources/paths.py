"""Paths on whatever file system they name: HDFS, an object store or a local disk."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object for ``path`` (HDFS, object store or local)."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, location = file_system(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in fs.globStatus(location) or [])


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = file_system(spark, path)
    return fs.exists(location)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written by the driver without a Spark job."""
    fs, location = file_system(spark, path)
    out = fs.create(location, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, location = file_system(spark, path)
    stream = fs.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
