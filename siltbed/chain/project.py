"""The token project from bronze transfers to a recommendation, as one job that may be run again.

Five steps: ingest, explore, train, monitor, recommend. A rerun ingests only what is new, trains on
the table as it then is, and replaces the production model only if the new one is better.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltbed.chain import eda, etl, recommend
from siltbed.ml import models as models_io
from siltbed.ml import monitor, runlog
from siltbed.ml.registry import Registry
from siltbed.operators import versions
from siltbed.scratch import free_shuffles, passing
from siltbed.sources.paths import exists

MODEL = "token-recommender"
HELD_OUT_SHARE = 5  # every fifth wallet-token pair, by hash, is kept from training


@dataclass(frozen=True)
class Project:
    """Folders of one project."""

    home: str

    @property
    def transfers(self) -> str:
        return f"{self.home}/silver_transfers"

    @property
    def runs(self) -> str:
        return f"{self.home}/runs"

    @property
    def registry(self) -> str:
        return f"{self.home}/registry"

    def new_models(self) -> str:
        """A folder for the models of one training: their shared ids and one folder each."""
        return f"{self.home}/models/{uuid.uuid4().hex[:12]}"


def ingest(spark: SparkSession, project: Project, bronze: str, schema: StructType | str) -> DataFrame:
    etl.ingest_transfers(spark, bronze, schema, project.transfers, f"{project.home}/checkpoint")
    return versions.read_as_of(spark, project.transfers)


def explore(transfers: DataFrame) -> dict[str, DataFrame]:
    """The questions that need transfers only, each as a lazy DataFrame."""
    return {
        "first_transfer": eda.first_transfer(transfers),
        "new_address_fraction": eda.new_address_fraction(transfers),
        "max_transfers": eda.max_transfers_in_transaction(transfers),
        "transfers_per_day": eda.per_day(transfers, "date"),
    }


def _held_out() -> Column:
    return F.pmod(F.xxhash64("wallet", "token"), F.lit(HELD_OUT_SHARE)) == 0


def stored_ids(spark: SparkSession, model_path: str) -> DataFrame:
    """The ids a model was trained with lie beside it."""
    return spark.read.parquet(f"{model_path.rsplit('/', 1)[0]}/ids")


def stored_names(spark: SparkSession, model_path: str) -> dict[str, DataFrame] | None:
    """Each wallet and token with its id, beside the ids; None for models that were stored without them."""
    paths = {c: f"{model_path.rsplit('/', 1)[0]}/{c}_ids" for c in ("wallet", "token")}
    return {c: spark.read.parquet(p) for c, p in paths.items()} if all(exists(spark, p) for p in paths.values()) else None


def miss_rate(spark: SparkSession, path: str, pairs: DataFrame | recommend.HeldOut) -> float:
    """One less the recall of held-out pairs among a stored model's best of all tokens, by its own ids."""
    with passing(spark):
        held = pairs
        if not isinstance(held, recommend.HeldOut):
            held = recommend.by_ids(stored_ids(spark, path), pairs, stored_names(spark, path))
        return 1.0 - recommend.recall(ALSModel.load(path), held).first()["recall"]


def train(
    spark: SparkSession,
    project: Project,
    pairs: DataFrame,
    grid: Sequence[Mapping[str, float]],
    seed: int = 42,
) -> int:
    """Fit every parameter set, log each as a run, register the best as a staged version."""
    data_version = versions.latest_version(spark, project.transfers)
    registry = Registry(spark, project.registry)
    train_rows = pairs.where(~_held_out()).select("wallet", "token", "n_transfers")
    test_rows = pairs.where(_held_out())
    models = project.new_models()
    with passing(spark):
        for c, numbered in recommend.integer_ids(train_rows).items():
            numbered.write.parquet(f"{models}/{c}_ids")
    names = stored_names(spark, f"{models}/als")
    recommend.with_integer_ids(train_rows, names=names).write.parquet(f"{models}/ids")
    free_shuffles(spark)
    ids = spark.read.parquet(f"{models}/ids")
    tags = runlog.data_tags(ids, "train") | runlog.data_tags(test_rows, "test")

    tried = []
    with passing(spark):
        held = recommend.by_ids(ids, test_rows, names)
        for number, params in enumerate(grid):
            path = f"{models}/als-{number}"
            recommend.fit_als(ids, seed=seed, **params).save(path)
            free_shuffles(spark)
            models_io.save_signature(spark, path, ids.select("wallet_id", "token_id", "n_transfers").schema)
            error = miss_rate(spark, path, held)
            run = runlog.log_run(
                spark, project.runs, MODEL, f"als-{number}", params, {"miss_rate": error}, tags, path, data_version
            )
            tried.append((error, run))
    version = registry.register(MODEL, min(tried)[1])
    registry.transition(MODEL, version, "Staging")
    return version


def watch(spark: SparkSession, project: Project, pairs: DataFrame, staged: int, min_gain: float = 0.0) -> bool:
    """Staged against production on the same held-out pairs; the better one serves."""
    registry, runs = Registry(spark, project.registry), runlog.read_runs(spark, project.runs)
    production = registry.in_stage(MODEL, "Production")
    held_out = pairs.where(_held_out())
    sides = {"staged": staged, "production": production}
    rows = [
        (side, miss_rate(spark, registry.resolve(f"models:/{MODEL}/{v}", runs), held_out))
        for side, v in sides.items()
        if v is not None
    ]
    metrics = spark.createDataFrame(rows, "model STRING, miss_rate DOUBLE")
    return monitor.promote_if_better(registry, MODEL, staged, production, metrics, "miss_rate", min_gain)


def recommend_tokens(
    spark: SparkSession, project: Project, wallet: object, pairs: DataFrame, k: int = 10
) -> DataFrame:
    """The production model's tokens for a wallet, with links; none that it holds by ``pairs``."""
    runs = runlog.read_runs(spark, project.runs)
    path = Registry(spark, project.registry).resolve(f"models:/{MODEL}/Production", runs)
    model = ALSModel.load(path)
    best = recommend.recommend_als(model, stored_ids(spark, path), wallet, k, pairs, stored_names(spark, path))
    link = F.concat(F.lit(recommend.TOKEN_PAGE), F.col("token").cast("string"))
    return best.withColumn("link", link)


def run_project(
    spark: SparkSession,
    home: str,
    bronze: str,
    schema: StructType | str,
    wallet: object,
    start: date | str | None = None,
    grid: Sequence[Mapping[str, float]] = ({"rank": 8},),
    k: int = 10,
) -> DataFrame:
    """All five steps; returns the recommendation for ``wallet``. The answers of the explore step are
    tables below ``explore``."""
    project = Project(home)
    transfers = ingest(spark, project, bronze, schema)
    free_shuffles(spark)
    for question, answer in explore(transfers).items():
        answer.write.mode("overwrite").parquet(f"{home}/explore/{question}")
    free_shuffles(spark)
    pairs_path = f"{home}/pairs"
    recommend.interactions(transfers, start).write.mode("overwrite").parquet(pairs_path)
    free_shuffles(spark)
    pairs = spark.read.parquet(pairs_path)
    staged = train(spark, project, pairs, grid)
    watch(spark, project, pairs, staged)
    return recommend_tokens(spark, project, wallet, pairs, k)
