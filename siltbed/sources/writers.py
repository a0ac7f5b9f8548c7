"""Batch sinks, catalog registration, clustered layout."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.sources.paths import exists, file_system


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, location = file_system(spark, source)
    if not fs.rename(location, file_system(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at ``path`` by ``df``, which may read that table, and return it.

    All rows are written beside the table first; it then changes by renames of whole folders. Up to the
    first of them a failure leaves the table as it was. If the driver dies between the two, the table lies
    at ``path.previous``, where ``published`` finds it, until the next ``publish`` is through.
    """
    spark, previous = df.sparkSession, f"{path}.previous"
    staging = f"{path}.staging/{uuid.uuid4().hex[:12]}"
    fs, staged = file_system(spark, f"{path}.staging")
    try:
        df.write.partitionBy(*partition_by).parquet(staging)
        if exists(spark, path):
            fs.delete(file_system(spark, previous)[1], True)
            _move(spark, path, previous)
        try:
            fs.mkdirs(file_system(spark, path)[1].getParent())
            _move(spark, staging, path)
        except Exception:
            if exists(spark, previous) and not exists(spark, path):
                _move(spark, previous, path)
            raise
        fs.delete(file_system(spark, previous)[1], True)
    finally:
        fs.delete(staged, True)
    return spark.read.parquet(path)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` as last published, also where a lost driver left it between two renames."""
    return spark.read.parquet(path if exists(spark, path) else f"{path}.previous")


def overwrite_path(
    df: DataFrame, path: str, partition_by: Sequence[str] = ()
) -> None:
    publish(df, path, partition_by)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Overwrite a catalog table, managed or at ``path``, and return it."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def write_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    """One string column as text lines."""
    df.write.mode(mode).text(path)


def register(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Expose a Parquet directory under a catalog name, replacing an older entry.

    The directory stays where it is: dropping the entry later does not delete it.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def z_value(columns: Sequence[str], ranges: Sequence[tuple[float, float]], bits: int = 8) -> Column:
    """Interleaved bits of several numeric columns, each first put into ``2**bits`` equal buckets.

    Rows close in every column get close z values, so range-partitioned files carry narrow
    min/max statistics for all of them.
    """
    buckets = 1 << bits
    z = F.lit(0).cast("bigint")
    width = len(columns)
    for pos, (name, (low, high)) in enumerate(zip(columns, ranges)):
        step = (float(high) - float(low)) / buckets or 1.0
        raw = F.floor((F.col(name).cast("double") - F.lit(float(low))) / F.lit(step))
        cell = F.least(F.greatest(raw, F.lit(0)), F.lit(buckets - 1)).cast("bigint")
        for bit in range(bits):
            one = F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint"))
            z = z.bitwiseOR(F.shiftleft(one, bit * width + pos))
    return z


def column_ranges(df: DataFrame, columns: Sequence[str]) -> list[tuple[float, float]]:
    """Min and max of each column: one aggregate row."""
    aggs = []
    for c in columns:
        number = F.col(c).cast("double")
        aggs += [F.min(number), F.max(number)]
    row = df.agg(*aggs).first()
    return [(row[2 * i] or 0.0, row[2 * i + 1] or 0.0) for i in range(len(columns))]


def clustered(
    df: DataFrame, columns: Sequence[str], bits: int = 8, name: str = "z"
) -> DataFrame:
    """Rows range-partitioned and sorted by the z value of ``columns``.

    The clustering columns follow z in the sort key so that one crowded z cell is still split
    over several range partitions.
    """
    z = z_value(columns, column_ranges(df, columns), bits)
    return (
        df.withColumn(name, z)
        .repartitionByRange(name, *columns)
        .sortWithinPartitions(name, *columns)
    )


def rank_borders(df: DataFrame, columns: Sequence[str], bits: int = 8) -> list[list[float]]:
    """Values that cut each column into ``2**bits`` parts of about equal rows, from mergeable quantile
    sketches taken in one pass. A value that very many rows share cuts once."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 50 << bits) for c in columns]).first()
    return [sorted({float(x) for x in found or []}) for found in row]


def rank_cell(column: str, borders: Sequence[float]) -> Column:
    """The number of ``borders`` at or below the column's value, by halving; NULL counts as the least."""
    value = f"cast(`{column}` as double)"

    def half(low: int, high: int) -> str:
        if low == high:
            return f"{low}L"
        mid = (low + high) // 2
        return f"if({value} >= {borders[mid]!r}D, {half(mid + 1, high)}, {half(low, mid)})"

    return F.expr(f"if({value} is null, 0L, {half(0, len(borders))})")


def z_of_ranks(columns: Sequence[str], borders: Sequence[Sequence[float]], bits: int = 8) -> Column:
    """Interleaved bits of the columns' rank cells: one outlier moves no border."""
    z = F.lit(0).cast("bigint")
    for pos, (name, own) in enumerate(zip(columns, borders)):
        cell = rank_cell(name, own)
        for bit in range(bits):
            one = F.shiftright(cell, bit).bitwiseAND(F.lit(1).cast("bigint"))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(columns) + pos))
    return z


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    partition_by: Sequence[str] = (),
    bits: int = 6,
    files: int | None = None,
) -> None:
    """Partitioned and multi-column-clustered table, cells by rank; the helper z column is not stored.
    ``files`` is the number of sorted ranges, by default that of shuffle partitions."""
    ranged = df.withColumn("_z", z_of_ranks(columns, rank_borders(df, columns, bits), bits))
    keys = [*partition_by, "_z", *columns]
    ranged = ranged.repartitionByRange(files, *keys) if files else ranged.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).drop("_z").write.mode("overwrite").partitionBy(*partition_by).parquet(path)
