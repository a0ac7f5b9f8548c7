"""Tables made of numbered commits on plain Parquet directories.

Layout: ``table/commit_v=3/_op=append/_source=late/_batch_id=0/[partitions]/part-*.parquet``.
An ``append`` commit adds rows. An ``update`` commit holds the new state of the rows it changed.
Every fact about a commit is a directory name, so as-of reads, history and "was this batch
already written" prune by directory and read no data they do not need.

Each commit also holds the table's schema (``_schema``, a line of JSON that readers of data skip), since
types cannot be told from folder names: a partition named 007 may be text. It may hold ``_marks``, the
64-bit hashes of its rows, by which a merge finds the commits that may know a row without reading them.

One writer per table at a time. A commit is written to a staging folder beside the table and moved
into it in one rename, so a lost driver leaves no half commit behind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from siltbed.operators.schemas import SchemaMismatch, enforce, evolved, from_ddl
from siltbed.sources.paths import exists, file_system, glob, read_text, write_text
from siltbed.sources.readers import table_stream

COMMIT_COLUMNS = ["commit_v", "_op", "_source", "_batch_id"]
_COMMIT_FIELDS = [
    StructField("commit_v", IntegerType()),
    StructField("_op", StringType()),
    StructField("_source", StringType()),
    StructField("_batch_id", LongType()),
]


def _version_of(path: str) -> int:
    return int(path.rsplit("commit_v=", 1)[1].split("/", 1)[0])


def commit_dirs(spark: SparkSession, table: str) -> list[str]:
    """Commit folders, oldest first. One listing of the table's top folder."""
    return sorted(glob(spark, f"{table}/commit_v=*"), key=_version_of)


def latest_version(spark: SparkSession, table: str) -> int:
    """Number of the newest commit, -1 for a table without any."""
    dirs = commit_dirs(spark, table)
    return _version_of(dirs[-1]) if dirs else -1


def create_table(spark: SparkSession, table: str) -> str:
    """Make the empty table folder, so that a stream may be started on it."""
    fs, location = file_system(spark, table)
    fs.mkdirs(location)
    return table


def table_schema(spark: SparkSession, table: str) -> StructType | None:
    """Data columns of the newest commit (which always carries the full schema), as stored with it;
    partition columns come last."""
    dirs = commit_dirs(spark, table)
    if not dirs:
        return None
    return StructType.fromJson(json.loads(read_text(spark, f"{dirs[-1]}/_schema")))


def last_batch(spark: SparkSession, table: str, source: str) -> int | None:
    """Newest batch number of a source: one look at the folder names of its commits."""
    found = glob(spark, f"{table}/commit_v=*/_op=*/_source={source}/_batch_id=*")
    return max((int(f.rstrip("/").rsplit("_batch_id=", 1)[1]) for f in found), default=None)


def changed_partitions(
    spark: SparkSession, table: str, column: str, after: int = -1, upto: int | None = None, op: str = "*"
) -> list[str | None]:
    """Values of a partition column that commits after ``after`` and up to ``upto`` hold rows of, as text;
    None for NULL. Folder names are the manifest: no file is opened."""
    found = set()
    for path in glob(spark, f"{table}/commit_v=*/_op={op}/_source=*/_batch_id=*/{column}=*"):
        if after < _version_of(path) and (upto is None or _version_of(path) <= upto):
            value = unquote(path.rstrip("/").rsplit(f"/{column}=", 1)[1])
            found.add(None if value == "__HIVE_DEFAULT_PARTITION__" else value)
    return sorted(found, key=lambda v: (v is not None, v))


def in_partitions(column: str, values: Iterable[str | None]) -> Column:
    """True for the rows in these partitions, never NULL; Spark prunes folders by it."""
    values = list(values)
    named = F.coalesce(F.col(column).cast("string").isin([v for v in values if v is not None]), F.lit(False))
    return named | F.col(column).isNull() if None in values else named


def _nullable(fields: Sequence[StructField]) -> StructType:
    """As read back from files, where every column may be NULL."""
    return StructType([StructField(f.name, f.dataType, True) for f in fields])


def commit(
    df: DataFrame,
    table: str,
    source: str,
    batch_id: int,
    op: str = "append",
    partition_by: Sequence[str] = (),
    schema: StructType | str | None = None,
    evolve: bool = False,
    skip_empty: bool = False,
    cluster: bool = True,
    marks: Sequence[str] = (),
) -> int | None:
    """Write ``df`` as the next commit and return its number.

    Returns None without writing if the source's batch is already in the table, which makes a
    retried stream batch harmless; the batch numbers of one source must grow. The columns must fit ``schema`` (or the table's newest
    commit); with ``evolve`` new columns are accepted and become part of the table.

    ``cluster`` brings the rows of one table partition together before the write, so that files
    do not number tasks times partitions. It is a rebalance, which adaptive execution splits
    again where one partition is large. Switch it off where a batch has few partition values.
    ``marks`` names columns whose hash is stored with the commit (see ``holders``).
    """
    spark = df.sparkSession
    written = last_batch(spark, table, source)
    if written is not None and batch_id <= written:
        return None
    known = table_schema(spark, table) or schema
    if known is not None:
        df = enforce(df, evolved(known, df.schema) if evolve else known)

    version = latest_version(spark, table) + 1
    home = f"commit_v={version}/_op={op}/_source={source}/_batch_id={batch_id}"
    staging = f"{table}.staging/{uuid.uuid4().hex[:12]}"
    rows = df.hint("rebalance", *partition_by) if partition_by and cluster else df
    rows.write.partitionBy(*partition_by).parquet(f"{staging}/{home}")
    fields = sorted(df.schema, key=lambda f: f.name in partition_by)
    write_text(spark, f"{staging}/commit_v={version}/_schema", _nullable(fields).json())
    fs, staged = file_system(spark, staging)
    try:
        written_rows = spark.read.schema(df.schema).parquet(f"{staging}/{home}")
        if skip_empty and written_rows.isEmpty():
            return None
        if marks:
            hashes = written_rows.select(F.xxhash64(*marks).alias("h"))
            hashes.sortWithinPartitions("h").write.parquet(f"{staging}/commit_v={version}/_marks")
        fs.mkdirs(file_system(spark, table)[1])
        moved = fs.rename(
            file_system(spark, f"{staging}/commit_v={version}")[1],
            file_system(spark, f"{table}/commit_v={version}")[1],
        )
        if not moved:
            raise OSError(f"commit {version} of {table} could not be moved into place")
    finally:
        fs.delete(staged, True)
    return version


def stream_appends(spark: SparkSession, table: str, schema: StructType | str) -> DataFrame:
    """The table's appended rows as a stream; merged-in rows arrive with their commit.

    Update commits are left out: to an append-only stream they would look like further rows.
    """
    data = from_ddl(schema)
    full = StructType([*data.fields, *_COMMIT_FIELDS])
    rows = table_stream(spark, create_table(spark, table), full)
    return rows.where(F.col("_op") == "append").select(*data.names)


def read_commits(
    spark: SparkSession, table: str, as_of: int | None = None, schema: StructType | None = None
) -> DataFrame:
    """All rows of all commits up to ``as_of`` with their commit columns."""
    data = schema or table_schema(spark, table)
    if data is None:
        raise ValueError(f"{table} has no commits")
    full = StructType([*data.fields, *_COMMIT_FIELDS])
    df = spark.read.schema(full).parquet(table).select(*data.names, *COMMIT_COLUMNS)
    return df if as_of is None else df.where(F.col("commit_v") <= as_of)


def holders(spark: SparkSession, table: str, rows: DataFrame, marks: Sequence[str]) -> list[int]:
    """Numbers of the commits that may hold one of ``rows``, judged by ``marks``: those with an equal
    64-bit hash, and all that were written without marks. Reads 8 bytes for each stored row."""
    dirs = commit_dirs(spark, table)
    marked = [d for d in dirs if exists(spark, f"{d}/_marks")]
    unknown = [_version_of(d) for d in dirs if d not in set(marked)]
    if not marked:
        return unknown
    wanted = rows.select(F.xxhash64(*marks).alias("h")).distinct()
    stored = spark.read.schema("h BIGINT").parquet(*(f"{d}/_marks" for d in marked))
    number = F.regexp_extract("_metadata.file_path", r"commit_v=(\d+)/_marks", 1).cast("int")
    found = stored.select("h", number.alias("v")).join(wanted, "h").select("v").distinct()
    return sorted([*unknown, *(r["v"] for r in found.collect())])


def current_rows(commits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The visible rows: for each key, its newest update and whatever was appended after it.

    Only update commits are aggregated. A table without any is read as it is, and the update
    side stays as small as the updates. A NULL key is never updated, so those rows all show.
    """
    updated = (
        commits.where(F.col("_op") == "update")
        .groupBy(*keys)
        .agg(F.max("commit_v").alias("_u"))
    )
    joined = commits.join(updated, list(keys), "left")
    shown = (
        F.col("_u").isNull()
        | (F.col("commit_v") > F.col("_u"))
        | ((F.col("commit_v") == F.col("_u")) & (F.col("_op") == "update"))
    )
    data = [c for c in commits.columns if c not in COMMIT_COLUMNS]
    return joined.where(shown).select(*data)


def read_as_of(
    spark: SparkSession,
    table: str,
    version: int | None = None,
    keys: Sequence[str] = (),
    within: str | None = None,
    only: Iterable[str | None] | None = None,
) -> DataFrame:
    """Table contents as of a commit (default: now). Tables with updates need their key.

    ``within`` names a partition column that all rows of one key share (the day of an event time in the
    key). Then only the partitions that an update commit holds rows of are joined with their updates, and
    all others are plain scans. ``only`` restricts the read to some of its values, given as text."""
    if version is not None and version > latest_version(spark, table):
        raise ValueError(f"{table} has no commit {version}")
    commits = read_commits(spark, table, version)
    if only is not None:
        commits = commits.where(in_partitions(within, only))
    plain = commits.drop(*COMMIT_COLUMNS)
    if not keys:
        return plain
    if within is None:
        updates = glob(spark, f"{table}/commit_v=*/_op=update")
        updated = any(version is None or _version_of(u) <= version for u in updates)
        return current_rows(commits, keys) if updated else plain
    touched = changed_partitions(spark, table, within, upto=version, op="update")
    if only is not None:
        touched = [v for v in touched if v in set(only)]
    if not touched:
        return plain
    changed = in_partitions(within, touched)
    return current_rows(commits.where(changed), keys).unionByName(commits.where(~changed).drop(*COMMIT_COLUMNS))


def history(commits: DataFrame, version: str | Column, *extra: Column) -> DataFrame:
    """One row per commit of any commit-tagged DataFrame: version, rows, further aggregates."""
    tag = F.col(version) if isinstance(version, str) else version
    return commits.groupBy(tag.cast("bigint").alias("version")).agg(
        F.count("*").alias("n_rows"), *extra
    )


def table_history(spark: SparkSession, table: str) -> DataFrame:
    """Version, operation, source, batch, rows and time of each commit, newest first."""
    written = F.min("_metadata.file_modification_time").alias("committed_at")
    return (
        spark.read.schema(StructType([*table_schema(spark, table).fields, *_COMMIT_FIELDS]))
        .parquet(table)
        .groupBy(*COMMIT_COLUMNS)
        .agg(F.count("*").alias("n_rows"), written)
        .withColumnsRenamed(
            {"commit_v": "version", "_op": "operation", "_source": "source", "_batch_id": "batch_id"}
        )
        .orderBy(F.desc("version"))
    )


__all__ = [
    "COMMIT_COLUMNS",
    "SchemaMismatch",
    "changed_partitions",
    "commit",
    "commit_dirs",
    "create_table",
    "current_rows",
    "history",
    "holders",
    "in_partitions",
    "last_batch",
    "latest_version",
    "read_as_of",
    "read_commits",
    "stream_appends",
    "table_history",
    "table_schema",
]
