"""Token-ID files: ids ranked by frequency, variable-length bytes with the lengths in bytes of their own.

The most frequent id of the corpus is written as 0, the next as 1, and so on, so that most numbers need
one byte. Each number takes one to four data bytes; the lengths of four numbers make one control byte.
Control and data bytes are kept apart, so a reader finds all lengths by one table lookup and all numbers
by array arithmetic, without a loop over ids.

``write_tokens`` makes a folder with ``ranks`` (the id of each rank) and ``blocks`` (Parquet rows of
whole documents, in ascending doc_id order over parts, blocks and rows); ``read_tokens`` reads it back.

Defined cases: a null text counts as empty and holds the end id alone; a null doc_id comes first; rows
with one doc_id stay apart, ordered by their ids; an empty table gives an empty folder and no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import documents, stored, text_of
from siltbed.llm.tokens import encode_documents, id_dtype
from siltbed.scratch import fresh_dir

#: A block is closed once it holds so many ids; a document is never split.
BLOCK_IDS = 1 << 18

_BLOCKS = "part int, block int, first_start long, doc_ids array<long>, n_tokens array<long>, control binary, data binary"
_LENGTHS = np.array([[1 + (c >> s & 3) for s in (0, 2, 4, 6)] for c in range(256)], dtype=np.uint8)


def pack_numbers(numbers: np.ndarray, counts: list[int] | None = None) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers. With ``counts``, these are runs of so many numbers
    one after the other, each as if packed alone."""
    n = np.ascontiguousarray(numbers, dtype="<u4")
    counts = np.array([len(n)] if counts is None else counts, dtype=np.int64)
    more = n > 0xFF
    lengths = 1 + more.astype(np.uint8) + (n > 0xFFFF) + (n > 0xFFFFFF)
    if len(n) and int(n.max()) <= 0xFFFF:  # the first byte of each and the second of some
        kept = np.ones(2 * len(n), dtype=bool)
        kept[1::2] = more
        data = n.astype("<u2").view(np.uint8)[np.flatnonzero(kept)]
    else:
        data = n.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    fours = -(-counts // 4)
    padded = np.zeros(int(fours.sum()) * 4, dtype=np.uint8)
    padded[_places(counts, fours)] = lengths - 1
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def _places(counts: np.ndarray, fours: np.ndarray) -> np.ndarray:
    """Where the numbers of each run stand when every run begins at a multiple of four."""
    before = np.cumsum(fours * 4 - counts) - (fours * 4 - counts)
    return np.arange(int(counts.sum())) + np.repeat(before, counts)


def unpack_numbers(control: np.ndarray, data: np.ndarray, counts: int | list[int]) -> np.ndarray:
    """All numbers of one run of so many, or of several packed one after the other."""
    counts = np.array([counts] if isinstance(counts, int) else counts, dtype=np.int64)
    lengths = _LENGTHS[control].ravel()[_places(counts, -(-counts // 4))].astype(np.int64)
    at = np.cumsum(lengths) - lengths
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        if not len(more):
            break
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def id_counts(tokens: DataFrame, dtype: str) -> DataFrame:
    """(id, n) over all documents: one count per task and id before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                blob = b"".join(b.column(0).slice(at, 512).to_pylist())
                n = np.bincount(np.frombuffer(blob, dtype=dtype))
                if len(n) > len(total):
                    n[: len(total)] += total
                    total = n
                else:
                    total[: len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write them below ``path``."""
    spark, dtype = docs.sparkSession, id_dtype(tokenizer)
    tokens = stored(encode_documents(text_of(docs), tokenizer), "ids")
    # One row per id of the tokenizer at most, however large the corpus.
    ranked = [r.id for r in id_counts(tokens, dtype).orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame(list(enumerate(ranked)), "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(ranked, default=0) + 1, dtype=np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start, held = TaskContext.get().partitionId(), 0, 0, []

        def close() -> pa.RecordBatch:
            lengths = [len(x) for _, x in held]
            # Each document's control bytes begin anew, so that it can be read alone.
            control, data = pack_numbers(rank_of[np.concatenate([x for _, x in held])], lengths)
            row = [[part], [block], [start], [[d for d, _ in held]], [lengths], [control], [data]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = [c.split()[0] for c in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

        size = 0
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((doc_id, np.frombuffer(ids, dtype=dtype)))
                size += len(held[-1][1])
                if size >= BLOCK_IDS:
                    yield close()
                    block, start, size = block + 1, start + size, 0
                    held.clear()
        if held:
            yield close()

    mark = F.crc32("ids")
    ordered = tokens.select("doc_id", "ids").repartitionByRange(F.col("doc_id").asc_nulls_first(), mark)
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), mark, "ids")
    ordered.mapInArrow(blocks, _BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")


def _starts(blocks: DataFrame) -> dict[int, int]:
    """Ids before each part: one number per written part."""
    sizes = blocks.select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    rows = sizes.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    ends = np.cumsum([r.n for r in rows], dtype=np.int64)
    return {r.part: int(e) - r.n for r, e in zip(rows, ends)}


def read_tokens(spark: SparkSession, path: str, finish: Callable[[np.ndarray], object] | None = None, kind: str = "array<long>") -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files. ``finish`` turns a document's ids into the last
    column, of SQL type ``kind``; by default it holds the ids."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    ranked = [r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]
    id_of, base = np.array(ranked or [0], dtype=np.uint32), _starts(blocks)
    finish = finish or (lambda ids: ids.astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                control, data = (np.frombuffer(row[c], dtype=np.uint8) for c in ("control", "data"))
                start, at, out = base[row["part"]] + row["first_start"], 0, [[], [], []]
                whole = id_of[unpack_numbers(control, data, row["n_tokens"])]
                for n in row["n_tokens"]:
                    for column, value in zip(out, (start, n, finish(whole[at : at + n]))):
                        column.append(value)
                    start, at = start + n, at + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2])],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(run, f"doc_id long, start long, n_tokens long, ids {kind}")


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    write_tokens(documents(spark, sf_dir), path)
    return read_tokens(spark, path, ids_crc32, "long").withColumnRenamed("ids", "ids_crc32")
