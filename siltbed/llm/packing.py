"""Packing by lexical retrieval: each window is filled with the documents most like the one it begins with.

Documents are dealt into index shards by a sketch of their rarer token ids, so that like documents meet.
A shard holds a bounded number of documents and an inverted index of their ids with BM25 weights, whose
document frequencies, count and mean length come from the whole corpus. Each document in turn seeds a
window of 1,024 ids. Its most telling ids query the index for unused neighbours; in the order of their
scores those that fit go in whole, and the best of the others is cut to fill what is left. The rest of a
cut document seeds the next window, so only the last window of a task stays short. That one is cut into
powers of two, which need no padding.

Defined cases: a null text counts as empty and holds the end id alone; a null or repeated doc_id is
packed like any other; a document longer than a window fills windows of its own and its rest is packed;
an empty table gives no rows; other columns are ignored. Every id lies in exactly one piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import documents, stored, text_of
from siltbed.llm.tokens import encode_documents, id_dtype

WINDOW = 1024
#: A shard is closed at so many documents or ids: the memory of one task, whatever the input.
SHARD_DOCS, SHARD_IDS = 2048, 2_000_000
#: Ids of a seed that query the index, neighbours asked for, and BM25's two constants.
QUERY_IDS, NEIGHBOURS, K1, B = 24, 16, 1.2, 0.75
#: Ids in more than this share of all documents say little; shards are not dealt by them.
COMMON = 0.05

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids of a document in ascending order, and how often each comes."""
    ids = np.sort(ids)
    new = np.ones(len(ids) + 1, dtype=bool)
    np.not_equal(ids[1:], ids[:-1], out=new[1:-1])
    first = np.flatnonzero(new)
    return ids[first[:-1]], first[1:] - first[:-1]


def id_document_counts(tokens: DataFrame, dtype: str) -> tuple[np.ndarray, int, float]:
    """Documents that hold each id, number of documents, mean length. The counts have one entry per id
    of the tokenizer; id -1 carries the two totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(1 << 16, dtype=np.int64), 0, 0
        for b in batches:
            for blob in b.column(0).to_pylist():
                ids, _ = distinct(np.frombuffer(blob, dtype=dtype))
                if len(ids) and ids[-1] >= len(df):
                    df = np.pad(df, (0, int(ids[-1]) + 1 - len(df)))
                df[ids] += 1
                docs, length = docs + 1, length + len(blob) // np.dtype(dtype).itemsize
        ids = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *ids], pa.int64()), pa.array([docs, *df[ids]], pa.int64()), pa.array([length, *np.zeros(len(ids), int)], pa.int64())],
            names=["id", "n", "length"],
        )

    sums = tokens.select("ids").mapInArrow(run, "id long, n long, length long").groupBy("id").agg(F.sum("n").alias("n"), F.sum("length").alias("length"))
    rows = sums.collect()
    df = np.zeros(max((r.id for r in rows), default=0) + 2, dtype=np.int64)
    docs, length = 0, 0
    for r in rows:
        if r.id < 0:
            docs, length = r.n, r.length
        else:
            df[r.id] = r.n
    return df, docs, length / max(docs, 1)


class Shard:
    """An inverted index over some documents and the windows made from them."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        self.docs, self.idf = docs, idf
        self.left = np.ones(len(docs), dtype=bool)
        self.next_unused = 0
        terms, weights, owner, self.queries = [], [], [], []
        for d, ids in enumerate(docs):
            t, tf = distinct(ids)
            w = (idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean))).astype(np.float32)
            terms.append(t)
            weights.append(w)
            owner.append(np.full(len(t), d, dtype=np.int32))
            self.queries.append(t[np.argpartition(-w, QUERY_IDS)[:QUERY_IDS]] if len(t) > QUERY_IDS else t)
        term, order = np.concatenate(terms), None
        order = np.argsort(term, kind="stable")
        self.owner, self.weight = np.concatenate(owner)[order], np.concatenate(weights)[order]
        self.ends = np.searchsorted(term[order], np.arange(len(idf) + 1)).tolist()

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents that share an id of the seed's query, the best score first."""
        spans = [(self.ends[t], self.ends[t + 1]) for t in self.queries[seed].tolist()]
        owner = np.concatenate([self.owner[a:b] for a, b in spans])
        weight = np.concatenate([self.weight[a:b] for a, b in spans])
        score = np.bincount(owner, weight, minlength=len(self.docs))
        score[~self.left] = 0
        top = np.argpartition(-score, NEIGHBOURS)[:NEIGHBOURS] if len(score) > NEIGHBOURS else np.arange(len(score))
        top = top[score[top] > 0]
        return top[np.lexsort((top, -score[top]))]

    def any_unused(self) -> int | None:
        while self.next_unused < len(self.docs) and not self.left[self.next_unused]:
            self.next_unused += 1
        return self.next_unused if self.next_unused < len(self.docs) else None

    def pieces(self) -> Iterator[tuple[int, int, int]]:
        """(document, from, to) in the order in which they fill windows one after the other. The first
        piece begins at a window's edge."""
        space, carried = WINDOW, None
        while True:
            seed, at = carried if carried else (self.any_unused(), 0)
            carried = None
            if seed is None:
                return
            self.left[seed] = False
            size = len(self.docs[seed])
            while size - at >= space:
                yield seed, at, at + space
                at, space = at + space, WINDOW
            if at < size:
                yield seed, at, size
                space -= size - at
            if space == WINDOW:
                continue
            ranked = self.neighbours(seed)
            for n in ranked:
                if len(self.docs[n]) <= space:
                    yield int(n), 0, len(self.docs[n])
                    self.left[n] = False
                    space -= len(self.docs[n])
                    if not space:
                        break
            if not space:
                space = WINDOW
                continue
            rest = next((int(n) for n in ranked if self.left[n]), None)
            rest = self.any_unused() if rest is None else rest
            if rest is None:
                return
            self.left[rest] = False
            take = min(space, len(self.docs[rest]))
            yield rest, 0, take
            space -= take
            if take < len(self.docs[rest]):
                carried, space = (rest, take), WINDOW
            elif not space:
                space = WINDOW
            else:  # a short document: go on with it as the seed of what is left
                carried = (rest, take)


def _powers(size: int) -> list[int]:
    return [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece, as ``PIECES``; the ids of a sequence are its pieces in the order of offset."""
    dtype = id_dtype(tokenizer)
    tokens = stored(encode_documents(text_of(docs), tokenizer), "ids")
    df, n_docs, mean = id_document_counts(tokens, dtype)
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5)).astype(np.float32)
    rare = df <= max(COMMON * n_docs, 1)
    mixed = (np.arange(len(df), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    mixed = np.where(rare, mixed, np.uint64(1) << np.uint64(30)).astype(np.int64)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [int(mixed[np.frombuffer(x, dtype=dtype)].min()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), b.column(0), b.column(1)], names=["key", "doc_id", "ids"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        sequence, offset, out = 0, 0, []
        tail: list[tuple] = []  # the pieces of a window that is not full yet

        def row(doc_id, ids, a, b) -> None:
            """Lay one piece down, over the edge of a window where need be."""
            nonlocal sequence, offset
            while a < b:
                end = min(b, a + WINDOW - offset)
                tail.append((doc_id, a, end - a, ids, part + sequence, offset))
                offset += end - a
                a = end
                if offset == WINDOW:
                    out.extend(tail)
                    tail.clear()
                    sequence, offset = sequence + 1, 0

        def done() -> pa.RecordBatch:
            crc = [zlib.crc32(i[a : a + n].astype("<u4").tobytes()) for _, a, n, i, _, _ in out]
            columns = [[r[0] for r in out], [r[1] for r in out], [r[2] for r in out], crc, [len(r[3]) for r in out], [r[4] for r in out], [r[5] for r in out]]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in PIECES.split(", ")])

        def shard(held: list) -> pa.RecordBatch:
            for d, a, b in Shard([x for _, x in held], idf, mean).pieces():
                row(*held[d], a, b)
            return done()

        held, size = [], 0
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((doc_id, np.frombuffer(ids, dtype=dtype)))
                size += len(held[-1][1])
                if size >= SHARD_IDS or len(held) >= SHARD_DOCS:
                    yield shard(held)
                    held, size = [], 0
        if held:
            yield shard(held)
        # The last window: pieces of powers of two.
        sizes, rest = _powers(offset), list(tail)
        tail.clear()
        offset, room = 0, 0
        for doc_id, a, n, ids, _, _ in rest:
            while n:
                if not room:
                    room, offset, sequence = sizes.pop(0), 0, sequence + 1
                take = min(n, room)
                out.append((doc_id, a, take, ids, part + sequence, offset))
                a, n, room, offset = a + take, n - take, room - take, offset + take
        yield done()

    keys = tokens.select("doc_id", "ids").mapInArrow(keyed, "key long, doc_id long, ids binary")
    dealt = keys.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id", "ids").select("doc_id", "ids")
    return dealt.mapInArrow(packed, PIECES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
