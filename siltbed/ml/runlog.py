"""Run log: one row per training run in an append-only Parquet table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "run_id STRING, experiment_id STRING, run_name STRING, start_time TIMESTAMP, "
    "params MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>, tags MAP<STRING,STRING>, "
    "artifact_path STRING, data_version BIGINT"
)


def log_run(
    spark: SparkSession,
    path: str,
    experiment_id: str,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    tags: Mapping[str, object] | None = None,
    artifact_path: str | None = None,
    data_version: int | None = None,
    start_time: datetime | None = None,
) -> str:
    """Append one run and return its id."""
    run_id = uuid.uuid4().hex
    row = (
        run_id, experiment_id, run_name, start_time or datetime.now(timezone.utc),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
        {k: str(v) for k, v in (tags or {}).items()},
        artifact_path, data_version,
    )
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return run_id


def data_tags(df: DataFrame, role: str) -> dict[str, str]:
    """What a run should record about a data set: rows and schema."""
    return {f"{role}_rows": str(df.count()), f"{role}_schema": df.schema.simpleString()}


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def experiments(runs: DataFrame) -> DataFrame:
    return runs.groupBy("experiment_id").agg(
        F.count("*").alias("n_runs"), F.max("start_time").alias("last_start")
    )


def search_runs(runs: DataFrame, experiment_id: object, max_results: int | None = None) -> DataFrame:
    """Runs of an experiment, newest first."""
    found = runs.where(F.col("experiment_id") == F.lit(experiment_id)).orderBy(
        F.desc("start_time"), F.desc("run_id")
    )
    return found if max_results is None else found.limit(max_results)


def run_metrics(runs: DataFrame) -> DataFrame:
    """(run_id, metric, value) rows."""
    return runs.select("run_id", F.explode("metrics").alias("metric", "value"))


def best_run(runs: DataFrame, metric: str, by: tuple[str, ...] = (), smallest: bool = True) -> DataFrame:
    """The run with the best value of a metric; equal values go to the smaller run id."""
    value = F.col("metrics")[metric]
    signed = value if smallest else -value
    known = runs.where(value.isNotNull())
    return known.groupBy(*by).agg(
        F.min_by("run_id", F.struct(signed, "run_id")).alias("run_id"),
        (F.min(value) if smallest else F.max(value)).alias(metric),
    )
