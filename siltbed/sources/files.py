"""File listings as DataFrames: statistics, presence, and comparison of two folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``: relative name and size. Contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            "path",
            F.col("length").alias("size"),
        )
    )


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Number of files and total bytes below ``path``; a missing path raises."""
    return listing(spark, path).agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("n_bytes"),
    )


def assert_file_present(spark: SparkSession, path: str, name: str) -> None:
    if listing(spark, path).where(F.col("file_name") == name).isEmpty():
        raise AssertionError(f"{name} has not landed in {path}")


def manifest_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare two (name, size) listings; one row per name that is not the same on both sides.

    A name that is present twice with different sizes is reported as ``size_mismatch``.
    """
    left = expected.select("name", F.col("size").alias("expected_size"))
    right = actual.select("name", F.col("size").alias("actual_size"))
    verdict = (
        F.when(F.col("actual_size").isNull(), "missing")
        .when(F.col("expected_size").isNull(), "extra")
        .when(F.col("expected_size") != F.col("actual_size"), "size_mismatch")
    )
    return (
        left.join(right, "name", "full_outer")
        .withColumn("verdict", verdict)
        .where(F.col("verdict").isNotNull())
    )
