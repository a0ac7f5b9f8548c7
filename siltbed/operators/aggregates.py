"""Aggregates. All are partial before the shuffle, so a hot key costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_all(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def count_by_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def broken_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Broken (negative) readings per key; the count column keeps its default name."""
    return df.where(F.col(value) < 0).groupBy(key).agg(F.count(value))


def key_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean, sample standard deviation and maximum per key."""
    return df.groupBy(key).agg(
        F.mean(value).alias(f"mean_{value}"),
        F.stddev(value).alias(f"std_{value}"),
        F.max(value).alias(f"max_{value}"),
    )


def average_sorted(df: DataFrame, key: str, value: str) -> DataFrame:
    return (
        df.select(key, value).groupBy(key).agg(F.avg(value).alias(f"avg_{value}")).sort(key)
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Number of columns of each type."""
    return (
        df.sparkSession.createDataFrame(df.dtypes, "col_name STRING, data_type STRING")
        .groupBy("data_type")
        .agg(F.count("*").alias("n_columns"))
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column, number of NULLs) of every column, in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("col_name"), F.col(c).alias("n_null")) for c in df.columns]
    )
    return one.select(F.inline(pairs))


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return null_profile(df).where(F.col("n_null") > 0).select("col_name")


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows in each partition of the DataFrame as it stands."""
    return (
        df.select(F.spark_partition_id().alias("partition"))
        .groupBy("partition")
        .agg(F.count("*").alias("n_rows"))
    )


def append_union(a: DataFrame, b: DataFrame, evolve: bool = False) -> DataFrame:
    """Rows of both; with ``evolve`` a column one side lacks is NULL there."""
    return a.unionByName(b, allowMissingColumns=evolve)


def table_diff(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows the two tables do not hold equally often, with ``surplus`` = copies in a minus in b.

    One shuffle for both directions; equal rows fold before it.
    """
    names = list(columns or a.columns)
    marked = a.select(*names, F.lit(1).alias("_s")).unionAll(
        b.select(*names, F.lit(-1).alias("_s"))
    )
    return marked.groupBy(*names).agg(F.sum("_s").alias("surplus")).where("surplus <> 0")
