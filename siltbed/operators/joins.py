"""Joins: lookup, positional, by id, recent-with-aggregate, full outer compare."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.ordering import row_number_global

def lookup(facts: DataFrame, dim: DataFrame, on: Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """Attach a lookup table. Adaptive execution measures its bytes: below the session's limit it is
    broadcast, above it both sides are shuffled and hot keys are split."""
    return facts.join(dim, on, how)


def positional(
    left: DataFrame,
    left_order: Sequence[str],
    right: DataFrame,
    right_order: Sequence[str],
) -> DataFrame:
    """Pair the n-th row of one table with the n-th row of another."""
    a = row_number_global(left, left_order, "_rn")
    b = row_number_global(right, right_order, "_rn")
    return a.join(b, "_rn").drop("_rn")


def by_id(base: DataFrame, other: DataFrame, key: str = "id") -> DataFrame:
    return base.join(other, key)


def attach_aggregate(
    detail: DataFrame, aggregate: DataFrame, key: str, recent: Column
) -> DataFrame:
    """Recent detail rows with their key's aggregate row."""
    return detail.where(recent).join(aggregate, key)


def outer_compare(
    a: DataFrame, b: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Both tables side by side per key with a verdict: same, changed, only_a or only_b."""
    left = a.select(*key, F.lit(True).alias("_a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    right = b.select(*key, F.lit(True).alias("_b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    same: Column = F.lit(True)
    for c in columns:
        same = same & F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b"))
    verdict = (
        F.when(F.col("_b").isNull(), "only_a")
        .when(F.col("_a").isNull(), "only_b")
        .when(same, "same")
        .otherwise("changed")
    )
    return (
        left.join(right, list(key), "full_outer")
        .withColumn("verdict", verdict)
        .drop("_a", "_b")
    )
