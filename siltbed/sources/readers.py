"""Batch and stream sources."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RAW_SCHEMA = "value STRING"


FILES_PER_BATCH = 10_000  # a first load is then many commits, not one that must all succeed


def text_stream(
    spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """New files of a drop folder, one row per line, column ``value``."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    return reader.option("maxFilesPerTrigger", files_per_batch).text(path)


def text_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).text(path)


def table_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    glob: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """A Parquet table directory as an unbounded table."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def named_stream(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)


def table_batch(spark: SparkSession, path_or_name: str) -> DataFrame:
    """A table by path (anything holding a slash) or by catalog name."""
    if "/" in path_or_name:
        return spark.read.parquet(path_or_name)
    return spark.table(path_or_name)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header; types are inferred, which costs one more pass over the files."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def csv_typed(
    spark: SparkSession, path: str, ddl: str, header: bool = False
) -> DataFrame:
    return spark.read.schema(ddl).option("header", header).csv(path)


def csv_as_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """CSV files exposed under a catalog name; without inference every column is a string."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} USING csv OPTIONS (path '{path}', header 'true')"
    )
    return spark.table(name)


def json_stream(
    spark: SparkSession, path: str, ddl: str, files_per_batch: int = 1
) -> DataFrame:
    return (
        spark.readStream.schema(ddl)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def rows(
    spark: SparkSession, data: Sequence[Any], schema: StructType | str
) -> DataFrame:
    return spark.createDataFrame(data, schema)


def row_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)
