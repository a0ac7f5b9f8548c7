"""Databases, table descriptions, cached views, timed counts."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.sources.files import file_stats


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def show_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def describe_table(df: DataFrame) -> DataFrame:
    """Columns and types in table order."""
    return df.sparkSession.createDataFrame(
        [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)],
        "position INT, col_name STRING, data_type STRING",
    )


def table_detail(spark: SparkSession, path: str, partition_columns: list[str] | None = None) -> DataFrame:
    """Location, format, partition columns, file count and size of a table directory."""
    return file_stats(spark, path).select(
        F.lit(path).alias("location"),
        F.lit("parquet").alias("format"),
        F.lit(",".join(partition_columns or [])).alias("partition_columns"),
        "n_files",
        "n_bytes",
    )


def cache_as(
    df: DataFrame, name: str, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> DataFrame:
    """(Re)cache ``df`` under a view name; an older view of that name is released first."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and spark.catalog.isCached(name):
        spark.catalog.uncacheTable(name)
    df.createOrReplaceTempView(name)
    spark.catalog.cacheTable(name, level)
    return spark.table(name)


def timed_count(build: Callable[[], DataFrame]) -> tuple[DataFrame, int, float]:
    """Build a DataFrame, count it, and return (DataFrame, rows, milliseconds)."""
    start = time.perf_counter()
    df = build()
    total = df.count()
    return df, total, (time.perf_counter() - start) * 1000.0
