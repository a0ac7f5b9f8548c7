"""Named queries over the driver tables, each with the SQL text it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(column: str | Column) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def r9(column: str | Column) -> Column:
    """For means: a mean of two-decimal values often ends exactly on a half at six places, where
    the order of summation would decide the last digit."""
    return F.round(F.col(column) if isinstance(column, str) else column, 9)
