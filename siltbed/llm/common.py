"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.scratch import fresh_dir

def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package from where it lies. On a cluster it is
    installed, or given by ``--py-files``, as any package that functions come from."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, home) if x)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id`` as long and ``text`` with null read as empty, whatever else the table holds."""
    importable(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *keep,
    )


def stored(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there: later steps neither compute it
    again nor depend on the executors that made it."""
    path = fresh_dir(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id's decimal text, modulo ``m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(m)


def held(doc_id: Column, m: int, rest: int) -> Column:
    return crc_mod(doc_id, m) == F.lit(rest)


def batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
