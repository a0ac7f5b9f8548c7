"""Staged against production model on the same rows, and promotion by rule."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.ml.models import eval_regression
from siltbed.ml.registry import Registry


def compare_models(df: DataFrame, models: dict[str, PipelineModel], label: str = "price") -> DataFrame:
    """MSE, MAE and R2 per model name over the same rows."""
    scored = [
        m.transform(df).select(F.lit(name).alias("model"), label, "prediction")
        for name, m in models.items()
    ]
    every = reduce(DataFrame.unionByName, scored)
    return eval_regression(every, label, "prediction", by=["model"])


def promotions(metrics: DataFrame, metric: str = "mse", min_gain: float = 0.0) -> DataFrame:
    """Per model: staged and production error, and whether the staged version should take over.

    ``metrics`` has (model_name, stage, <metric>) rows, one per stage. A model with nothing in
    production is promoted; one with nothing staged is not listed.
    """
    error = lambda stage: F.max(F.when(F.col("stage") == stage, F.col(metric)))
    sides = metrics.groupBy("model_name").agg(
        error("Staging").alias("staged"), error("Production").alias("production")
    )
    better = F.col("production").isNull() | (
        F.col("staged") < F.col("production") * F.lit(1.0 - min_gain)
    )
    return sides.where(F.col("staged").isNotNull()).withColumn("promote", better)


def promote_if_better(
    registry: Registry,
    name: str,
    staged: int,
    production: int | None,
    metrics: DataFrame,
    metric: str = "mse",
    min_gain: float = 0.0,
) -> bool:
    """Move the staged version to production if its error is lower by more than ``min_gain``
    (a share of the production error). The version it replaces is archived.

    ``metrics`` has one row per model, named ``staged`` and ``production``.
    """
    stage = F.when(F.col("model") == "staged", "Staging").when(
        F.col("model") == "production", "Production"
    )
    named = metrics.select(F.lit(name).alias("model_name"), stage.alias("stage"), metric)
    if production is None:
        named = named.where(F.col("stage") == "Staging")
    verdict = promotions(named, metric, min_gain).first()
    better = verdict is not None and verdict["promote"]
    if better:
        registry.transition(name, staged, "Production")
        if production is not None:
            registry.transition(name, production, "Archived")
    return better
