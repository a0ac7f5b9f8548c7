"""From raw documents to packed sequences: five stages, each one an operator of ``siltbed.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next stage's documents. All but the last return the columns of ``documents``: toxic documents go,
one document of each group of near-duplicates stays, documents that hold a benchmark item go, personal
data is replaced in the text, and what is left is packed into windows.

Defined cases, as the operators' modules say: a null text counts as empty, is neither toxic nor a copy nor a
leak, and is packed as the end id alone; of rows with one id and text one stays, of rows with one id each
text is a document; a null id stays null and never names a group; long texts are read whole; other columns
pass through all stages but the last; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import decontaminate, neardup, packing, pii, toxicity
from siltbed.llm.common import documents, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.learn(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("pii", hide_personal_data),
    ("packing", pack),
]

#: Learned models, sketches and tokenizers have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
