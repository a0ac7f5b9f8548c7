"""Regression models on tables: train, tune, evaluate, store, score."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltbed.functions.columns import ratio
from siltbed.ml.features import split_bucket
from siltbed.operators.schemas import SchemaMismatch
from siltbed.scratch import ensure_checkpoint_dir

def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def train_random_forest(
    df: DataFrame, features: Sequence[str], label: str = "price", seed: int = 42,
    num_trees: int = 20, max_depth: int = 5, **params: object,
) -> PipelineModel:
    """Regression forest with its feature assembly, as one stored pipeline. A depth beyond the
    library's own limit of 30 raises."""
    forest = RandomForestRegressor(
        labelCol=label, seed=seed, numTrees=num_trees,
        maxDepth=max_depth, **params,
    )
    return Pipeline(stages=[assembler(features), forest]).fit(df)


def train_gbt(
    df: DataFrame, features: Sequence[str], label: str = "price", seed: int = 42,
    max_iter: int = 20, step_size: float = 0.1, max_depth: int = 5, **params: object,
) -> PipelineModel:
    ensure_checkpoint_dir(df.sparkSession)
    boosted = GBTRegressor(
        labelCol=label, seed=seed, maxIter=max_iter, stepSize=step_size, maxDepth=max_depth, **params
    )
    return Pipeline(stages=[assembler(features), boosted]).fit(df)


def grid_search(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    num_trees: Sequence[int],
    max_depth: Sequence[int],
    label: str = "price",
    folds: int = 3,
    metric: str = "r2",
    parallelism: int = 4,
    seed: int = 42,
) -> CrossValidatorModel:
    """Cross-validated forest over number of trees times depth.

    Folds come from the row key, so a recomputed partition stays in its fold.
    """
    forest = RandomForestRegressor(labelCol=label, seed=seed)
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(num_trees))
        .addGrid(forest.maxDepth, list(max_depth))
        .build()
    )
    search = CrossValidator(
        estimator=Pipeline(stages=[assembler(features), forest]),
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=label, metricName=metric),
        numFolds=folds, parallelism=parallelism, seed=seed, foldCol="_fold",
    )
    return search.fit(df.withColumn("_fold", split_bucket(keys, seed, folds)))


def grid_scores(spark: SparkSession, found: CrossValidatorModel, metric: str = "r2") -> DataFrame:
    """One row per parameter set with its mean metric over the folds."""
    rows = [
        (json.dumps({p.name: v for p, v in params.items()}, sort_keys=True), float(score))
        for params, score in zip(found.getEstimatorParamMaps(), found.avgMetrics)
    ]
    return spark.createDataFrame(rows, f"params STRING, {metric} DOUBLE")


def eval_regression(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """MSE, MAE and R2 in one pass; R2 compares the MSE with the label's own variance."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    mse = F.avg((y - p) * (y - p))
    return df.groupBy(*by).agg(
        mse.alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (F.lit(1.0) - F.try_divide(mse, F.var_pop(y))).alias("r2"),
    )


def residuals(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.select(
        F.col(prediction).alias("predicted"), (F.col(label) - F.col(prediction)).alias("residual")
    )


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance), most important first. As many rows as features."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(
        F.desc("importance"), "feature"
    )


# --- storing and scoring ---------------------------------------------------------------------


def save_model(model: PipelineModel, path: str, inputs: StructType) -> None:
    """Model files and the input schema scoring has to bring."""
    model.write().overwrite().save(f"{path}/model")
    save_signature(SparkSession.getActiveSession(), path, inputs)


def save_signature(spark: SparkSession, path: str, inputs: StructType) -> None:
    """The columns a stored model takes, beside it."""
    row = spark.createDataFrame([(inputs.json(),)], "schema STRING")
    row.write.mode("overwrite").json(f"{path}/inputs")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def load_inputs(spark: SparkSession, path: str) -> StructType:
    row = spark.read.schema("schema STRING").json(f"{path}/inputs").first()
    return StructType.fromJson(json.loads(row["schema"]))


def check_inputs(df: DataFrame, inputs: StructType) -> None:
    """Raise, naming the columns, if ``df`` lacks a model input or has it with another type."""
    have = dict(df.dtypes)
    lacking = [f.name for f in inputs if f.name not in have]
    wrong = [
        f"{f.name} ({have[f.name]} for {f.dataType.simpleString()})"
        for f in inputs
        if f.name in have and have[f.name] != f.dataType.simpleString()
    ]
    if lacking or wrong:
        parts = [f"missing: {', '.join(lacking)}"] * bool(lacking)
        parts += [f"other type: {', '.join(wrong)}"] * bool(wrong)
        raise SchemaMismatch("model inputs " + "; ".join(parts))


def score_batch(df: DataFrame, path: str) -> DataFrame:
    """Rows with the prediction of the model stored at ``path``."""
    check_inputs(df, load_inputs(df.sparkSession, path))
    return load_model(path).transform(df).drop("features")


def score_custom(
    df: DataFrame,
    predict: Callable[[pd.DataFrame], pd.Series],
    inputs: Sequence[str],
    name: str = "prediction",
) -> DataFrame:
    """Any Python predictor, fed one Arrow batch at a time on the executors."""
    full = StructType.fromJson(df.schema.jsonValue()).add(name, "double")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{name: predict(batch[list(inputs)]).astype("float64")})

    return df.mapInPandas(run, full)


def score_pre_post(
    df: DataFrame,
    path: str,
    before: Callable[[DataFrame], DataFrame],
    after: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Raw rows in: preprocess, score, postprocess."""
    return after(score_batch(before(df), path))


def price_per_person(prediction: str = "prediction", guests: str = "accommodates") -> Column:
    return ratio(prediction, guests)


def log_params(model: PipelineModel, names: Sequence[str]) -> Mapping[str, str]:
    """Chosen parameters of the last stage as text, for the run log."""
    last = model.stages[-1]
    return {n: str(last.getOrDefault(n)) for n in names}
