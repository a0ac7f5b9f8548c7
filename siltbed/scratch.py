"""Shared scratch space: where intermediate tables, stream checkpoints and test copies go.

On a cluster the folder is the one named by ``spark.checkpoint.dir``; only a local session that
names none gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from siltbed.sources.paths import file_system

_SETTING = "spark.checkpoint.dir"
_local_base: dict[str, str] = {}
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError(f"{_SETTING} must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = tempfile.mkdtemp(prefix="siltbed-")
    return _local_base[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a table in shared scratch and return the written rows.

    Used where a value must not change if a lost executor makes Spark recompute it (row ids that
    depend on partition layout), and to cut lineage.
    """
    path = fresh_dir(df.sparkSession, label)
    if (mine := _passing.get()) is not None:
        mine.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the files of a shuffle once the driver's JVM has collected all that refers to it; a job
    of many steps asks for that after each, so that its disk holds the shuffles of one step at a time."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is materialized within is deleted at the end: for steps whose result is taken before."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            fs, location = file_system(spark, path)
            fs.delete(location, True)
        free_shuffles(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative algorithms cut their lineage here; a folder that is already set is kept."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
