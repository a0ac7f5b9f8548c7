"""Model registry as a table of events; the present state is the newest event of each kind."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.sources.paths import exists

EVENT_SCHEMA = (
    "model_name STRING, version INT, event STRING, stage STRING, description STRING, "
    "run_id STRING, event_time TIMESTAMP, seq BIGINT"
)
STAGES = ("None", "Staging", "Production", "Archived")


class Registry:
    """Models, their versions and stages at one path. One writer at a time.

    Events are few (one per registration or transition), so a change reads the table first.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def events(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], EVENT_SCHEMA)
        return self.spark.read.schema(EVENT_SCHEMA).parquet(self.path)

    def _add(
        self, name: str, version: int | None, event: str, stage: str | None = None,
        description: str | None = None, run_id: str | None = None,
    ) -> None:
        seq = (self.events().agg(F.max("seq")).first()[0] or 0) + 1
        row = (name, version, event, stage, description, run_id, datetime.now(timezone.utc), seq)
        rows = self.spark.createDataFrame([row], EVENT_SCHEMA).coalesce(1)
        rows.write.mode("append").parquet(self.path)

    def versions(self, name: str | None = None) -> DataFrame:
        """Living versions with stage, description and the run they came from."""
        living = current_state(self.events())
        return living if name is None else living.where(F.col("model_name") == name)

    def _version(self, name: str, version: int):
        row = self.versions(name).where(F.col("version") == version).first()
        if row is None:
            raise ValueError(f"model {name} has no version {version}")
        return row

    def register(self, name: str, run_id: str) -> int:
        """New version = highest ever given to that name plus one. Deleted numbers stay used."""
        row = next_versions(self.events()).where(F.col("model_name") == name).first()
        version = row["next_version"] if row else 1
        self._add(name, version, "register", stage="None", run_id=run_id)
        return version

    def describe_model(self, name: str, text: str) -> None:
        self._add(name, None, "describe", description=text)

    def describe_version(self, name: str, version: int, text: str) -> None:
        self._version(name, version)
        self._add(name, version, "describe", description=text)

    def description(self, name: str) -> str | None:
        """Newest model-level description."""
        row = model_descriptions(self.events()).where(F.col("model_name") == name).first()
        return row["description"] if row else None

    def transition(self, name: str, version: int, stage: str) -> None:
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage}; one of {', '.join(STAGES)}")
        self._version(name, version)
        self._add(name, version, "transition", stage=stage)

    def latest(self, name: str) -> int | None:
        """Newest living version of a model; None without one."""
        row = latest_versions(self.events()).where(F.col("model_name") == name).first()
        return row["version"] if row else None

    def in_stage(self, name: str, stage: str) -> int | None:
        """Newest version of a model in a stage."""
        found = self.versions(name).where(F.col("stage") == stage)
        return found.agg(F.max("version")).first()[0]

    def delete_version(self, name: str, version: int) -> None:
        """Only an archived version may be deleted."""
        stage = self._version(name, version)["stage"]
        if stage != "Archived":
            raise ValueError(f"{name} version {version} is in stage {stage}; archive it first")
        self._add(name, version, "delete")

    def delete_model(self, name: str) -> None:
        """Only a model without staged or serving versions may be deleted."""
        busy = self.versions(name).where(F.col("stage").isin("Staging", "Production"))
        if not busy.isEmpty():
            raise ValueError(f"{name} has versions in Staging or Production; archive them first")
        self._add(name, None, "delete")

    def resolve(self, uri: str, runs: DataFrame) -> str:
        """``runs:/run/path`` or ``models:/name/version-or-stage`` to the artifact path."""
        scheme, _, rest = uri.partition(":/")
        first, _, second = rest.partition("/")
        if scheme == "runs":
            run_id, suffix = first, f"/{second}" if second else ""
        elif scheme == "models":
            version = int(second) if second.isdigit() else self.in_stage(first, second)
            if version is None:
                raise ValueError(f"{uri}: no version in that stage")
            run_id, suffix = self._version(first, version)["run_id"], ""
        else:
            raise ValueError(f"{uri}: expected runs:/ or models:/")
        row = runs.where(F.col("run_id") == run_id).select("artifact_path").first()
        if row is None:
            raise ValueError(f"{uri}: run {run_id} is not in the run log")
        return row["artifact_path"] + suffix


def current_state(events: DataFrame) -> DataFrame:
    """(model_name, version, stage, description, run_id) of versions that are not deleted."""
    gone = (
        events.where((F.col("event") == "delete") & F.col("version").isNull())
        .groupBy("model_name")
        .agg(F.max("seq").alias("_gone"))
    )
    # max_by skips rows whose order is NULL, so each fact takes the newest event that states it.
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq")))
    folded = (
        events.where(F.col("version").isNotNull())
        .groupBy("model_name", "version")
        .agg(
            newest("stage").alias("stage"),
            newest("description").alias("description"),
            newest("run_id").alias("run_id"),
            F.max("seq").alias("_seq"),
            F.bool_or(F.col("event") == "delete").alias("_deleted"),
        )
    )
    living = folded.join(gone, "model_name", "left").where(
        ~F.col("_deleted") & (F.col("_gone").isNull() | (F.col("_seq") > F.col("_gone")))
    )
    return living.select("model_name", "version", "stage", "description", "run_id")


def next_versions(events: DataFrame) -> DataFrame:
    """The version number a new registration of each model would get."""
    return events.groupBy("model_name").agg(
        (F.coalesce(F.max("version"), F.lit(0)) + 1).cast("int").alias("next_version")
    )


def latest_versions(events: DataFrame) -> DataFrame:
    """(model_name, version): the newest version of each model that is not deleted."""
    return current_state(events).groupBy("model_name").agg(F.max("version").alias("version"))


def model_descriptions(events: DataFrame) -> DataFrame:
    """Newest model-level description of each model."""
    told = events.where((F.col("event") == "describe") & F.col("version").isNull())
    return told.groupBy("model_name").agg(F.max_by("description", "seq").alias("description"))


def version_paths(events: DataFrame, runs: DataFrame) -> DataFrame:
    """(model_name, version, stage, artifact_path) of all living versions, by way of their runs."""
    living = current_state(events).select("model_name", "version", "stage", "run_id")
    return living.join(runs.select("run_id", "artifact_path"), "run_id").drop("run_id")
