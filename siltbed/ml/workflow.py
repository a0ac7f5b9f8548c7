"""Read, train, predict as three parametrised steps, each giving a small status record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from siltbed.ml import features, models, runlog


def read_step(source: DataFrame, output: str) -> dict:
    """Store the data set the later steps work on."""
    source.write.mode("overwrite").parquet(output)
    return {"status": "OK", "data_input_path": output}


def train_step(
    spark: SparkSession, data: str, output: str, runs: str, inputs: Sequence[str],
    keys: Sequence[str], label: str = "price", experiment: str = "workflow", **params: int,
) -> dict:
    """Train on the train split, log test metrics, store the model."""
    df = spark.read.parquet(data)
    train, test = features.split_train_test(df, keys)
    model = models.train_random_forest(train, inputs, label, **params)
    scored = model.transform(test)
    metrics = models.eval_regression(scored, label, "prediction").first().asDict()
    models.save_model(model, output, df.select(*inputs).schema)
    run_id = runlog.log_run(
        spark, runs, experiment, "train_step", params, metrics,
        tags=runlog.data_tags(train, "train"), artifact_path=output,
    )
    return {"status": "OK", "model_output_path": output, "run_id": run_id, **metrics}


def predict_step(spark: SparkSession, data: str, model: str, output: str) -> dict:
    """Score a stored data set with a stored model."""
    models.score_batch(spark.read.parquet(data), model).write.mode("overwrite").parquet(output)
    return {"status": "OK", "predictions_path": output}


def run_workflow(
    spark: SparkSession, source: DataFrame, home: str, inputs: Sequence[str],
    keys: Sequence[str], label: str = "price", **params: int,
) -> list[dict]:
    """The three steps in order; a step that raises ends the run."""
    read = read_step(source, f"{home}/data")
    train = train_step(
        spark, read["data_input_path"], f"{home}/model", f"{home}/runs", inputs, keys, label, **params
    )
    predict = predict_step(
        spark, read["data_input_path"], train["model_output_path"], f"{home}/predictions"
    )
    return [read, train, predict]
