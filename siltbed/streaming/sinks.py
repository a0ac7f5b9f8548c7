"""Stream sinks. Every table is written batch by batch, never by the streaming file sink: that
sink's own file list would hide rows which a batch merge adds to the same folder later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from siltbed.operators import versions
from siltbed.sources import writers

_QUERY_ID = "sql.streaming.queryId"  # set by Spark on the thread that runs a batch


def append_writer(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    name: str,
    partition_by: Sequence[str] = (),
    schema: StructType | str | None = None,
    evolve: bool = False,
    cluster: bool = True,
    marks: Sequence[str] = (),
) -> DataStreamWriter:
    """Named, checkpointed append stream into a commit table; call ``.start()`` on the result.

    Each micro-batch is one commit tagged with the stream's name, its checkpoint's id and the batch
    number, so a batch that is retried after a failure is written once, and a stream begun anew
    with a fresh checkpoint is a source of its own. Without ``evolve`` a batch whose columns do not
    fit the table fails the stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checkpoint_id = batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
        source = f"{name}.{checkpoint_id}" if checkpoint_id else name
        versions.commit(
            batch, table, source, batch_id,
            partition_by=partition_by, schema=schema, evolve=evolve, cluster=cluster, marks=marks,
        )

    return (
        stream.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def complete_writer(
    stream: DataFrame, path: str, checkpoint: str, name: str
) -> DataStreamWriter:
    """Aggregate stream whose whole result replaces the table on every batch: a batch becomes visible at
    once and whole, or not at all (``writers.publish``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writers.publish(batch, path)

    return (
        stream.writeStream.queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def preview(stream: DataFrame, name: str, mode: str = "append", rows: int | None = None) -> DataStreamWriter:
    """Live in-memory view of a stream under ``name``.

    Without ``rows`` the view holds every row the stream gives out: for complete results, which are small, or
    small streams. With ``rows`` it holds a sample of so many: each row draws a hash of its values and batch,
    and the rows with the least hashes of all batches stay. Each batch sends at most ``rows`` of its rows to
    the driver, which never holds more than twice that many.
    """
    if rows is None:
        return stream.writeStream.format("memory").queryName(name).outputMode(mode)
    held: list[tuple] = []
    fields, session = stream.schema, stream.sparkSession  # a batch has a session of its own

    def keep(batch: DataFrame, batch_id: int) -> None:
        nonlocal held
        drawn = F.xxhash64(F.to_json(F.struct("*")), F.lit(batch_id), F.monotonically_increasing_id())
        least = batch.select(drawn.alias("_h"), F.struct("*").alias("_row")).orderBy("_h").limit(rows).collect()
        if mode == "complete":
            held = []
        held = sorted(held + [(r["_h"], tuple(r["_row"])) for r in least], key=lambda r: r[0])[:rows]
        session.createDataFrame([r for _, r in held], fields).createOrReplaceTempView(name)

    return stream.writeStream.queryName(name).outputMode(mode).foreachBatch(keep)
