"""Ranked lexical search over bit-sliced Bloom signatures, exact in its results.

``Index.build`` reads the documents once. It packs them into blocks; a block is a matrix of bits with one
column per document and one row (slice) per position of a Bloom filter. A document enters each of its terms
once for each level it reaches (at least 1, 2, 4, 8, 16 occurrences), at ``HASHES`` positions a level.
Documents of about the same number of entries share a block, so that one height suits them all. Beside the
blocks lies the vocabulary with document frequencies, which a task folds before the shuffle.

``Index.search`` takes items in blocks of at most ``ITEMS``. For a term, the slices of a level are ANDed:
the result overestimates the documents that hold the term so often, so the highest level met bounds tf from
above. The weighted sum of the slices over an item's terms, with each document's own length, is then an
upper bound of its score. The documents with the highest bounds of all blocks are scored exactly, and the
k-th best of these scores is a bar that the k-th best of the corpus cannot lie below. Every document whose
bound reaches the bar, and no other, is read again and scored exactly; ties therefore stay.

The rule: terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
lower-cased. With N documents that hold a term, L terms in all, df documents with the term, n and tf of the
document, w = floor(1000 ln((2N+2)/(2df+1))), m = 75 + (25 n N) div L, and the score is the sum of
w * ((10**9 tf) div (1000 tf + 12 m)) over the item's terms with repeats.

Defined cases: a null or empty text holds no terms, such documents are not counted and never returned, such
items return nothing; rows with one doc_id are documents of their own, and each row of items is an item; a
null doc_id comes after all others among equal scores; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltbed.llm.common import documents, stored, text_of
from siltbed.llm.neardup import mix

#: Hashes of a term and level, bits for an entry of the largest document a block is made for, levels.
HASHES, BITS, LEVELS = 3, 10, 5
#: Documents of a block, and bytes of its matrix before packing.
BLOCK, MATRIX = 2048, 1 << 25
#: Different terms a task counts before it hands them on.
VOCABULARY = 200_000
#: Items searched for at once, characters of these, and terms whose slices are summed at once.
ITEMS, CHARACTERS, TERMS = 1024, 1 << 22, 1024

_SEEDS = mix(np.arange(1, LEVELS * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(LEVELS, HASHES)
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str) -> list[bytes]:
    """The terms in order; bytes of one character beyond ASCII are all above 127 and stay together."""
    return text.encode().translate(_TERM_BYTES).split()


def _hashes(words) -> np.ndarray:
    words = list(words)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _positions(h: np.ndarray, level: int, height: int) -> np.ndarray:
    """One row of ``HASHES`` slice numbers per term hash."""
    return ((mix(h[:, None] + _SEEDS[level]) >> np.uint64(32)) * np.uint64(height) >> np.uint64(32)).astype(np.int64)


_INDEX = "term binary, df long, docs int, tokens long, height int, marks binary, lengths binary, most binary, bits binary"
_NAMES = [c.split()[0] for c in _INDEX.split(", ")]
_TYPES = [pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def _block(held: list[tuple], height: int) -> pa.RecordBatch:
    """A block of documents (mark, terms, most, hashes, counts)."""
    matrix = np.zeros((height, -(-len(held) // 8) * 8), dtype=bool)
    column = np.repeat(np.arange(len(held)), [len(x[3]) for x in held])
    h, tf = np.concatenate([x[3] for x in held]), np.concatenate([x[4] for x in held])
    for level in range(LEVELS):
        enough = tf >= 1 << level
        if enough.any():
            matrix[_positions(h[enough], level, height), column[enough][:, None]] = True
    numbers = [np.array([x[i] for x in held], dtype=t) for i, t in ((0, "<i8"), (1, "<i8"), (2, "<i8"))]
    row = [None, None, len(held), int(numbers[1].sum()), height, *(x.tobytes() for x in numbers), np.packbits(matrix, axis=1).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES)], names=_NAMES)


def _vocabulary(df: Counter) -> pa.RecordBatch:
    columns = [list(df.keys()), list(df.values())] + [[None] * len(df)] * (len(_NAMES) - 2)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df: Counter = Counter()
    waiting: dict[int, list[tuple]] = {}  # by height
    for b in batches:
        for mark, text in zip(b.column(0).to_pylist(), (t.as_py() for t in b.column(1))):
            counted = Counter(terms(text))
            if not counted:
                continue
            df.update(counted.keys())
            tf = np.fromiter(counted.values(), np.int64, len(counted))
            entries = sum(int((tf >= 1 << level).sum()) for level in range(LEVELS))
            height = math.ceil(BITS * 2 ** (math.ceil(2 * math.log2(entries)) / 2))
            held = waiting.setdefault(height, [])
            held.append((mark, int(tf.sum()), int(tf.max()), _hashes(counted), tf))
            if len(held) >= min(BLOCK, max(8, MATRIX // height)):
                yield _block(waiting.pop(height), height)
            if len(df) >= VOCABULARY:
                yield _vocabulary(df)
                df.clear()
    for height, held in waiting.items():
        yield _block(held, height)
    if df:
        yield _vocabulary(df)


# -- bounds ------------------------------------------------------------------------------------------


@dataclass
class _Asked:
    """A block of items as the tasks need it: bounded by ``ITEMS`` and ``CHARACTERS``."""

    wanted: list[dict[bytes, int]]  # of each item: weight times repeats of each term
    n_docs: int
    n_tokens: int

    def chunks(self) -> list[tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]]:
        """Hashes of up to ``TERMS`` terms, and which of them each item weighs how."""
        every = sorted({t for w in self.wanted for t in w})
        place = {t: divmod(i, TERMS) for i, t in enumerate(every)}
        out = [(_hashes(every[i : i + TERMS]), {}) for i in range(0, len(every), TERMS)]
        for no, w in enumerate(self.wanted):
            for t, weight in w.items():
                c, i = place[t]
                out[c][1].setdefault(no, []).append((i, weight))
        return [(h, [(no, *(np.array(x, t) for x, t in zip(zip(*pairs), (np.int64, np.float64)))) for no, pairs in uses.items()]) for h, uses in out]


def _norm(n, n_docs: int, n_tokens: int):
    return 100 - 25 + (25 * n * n_docs) // n_tokens


def bounds(row: dict, asked: _Asked, chunks: list) -> np.ndarray:
    """Upper bounds of the scores, one row per item and one column per document of the block."""
    docs, height = row["docs"], row["height"]
    n, most = (np.frombuffer(row[c], "<i8") for c in ("lengths", "most"))
    m = _norm(n, asked.n_docs, asked.n_tokens)
    tops = [np.minimum(most, (2 << level) - 1 if level < LEVELS - 1 else most) for level in range(LEVELS)]
    worth = [(10**9 * tf) // (1000 * tf + 12 * m) for tf in tops]
    steps = [worth[0], *(b - a for a, b in zip(worth, worth[1:]))]
    bits = np.frombuffer(row["bits"], np.uint8).reshape(height, -1)
    out = np.zeros((len(asked.wanted), docs))  # whole numbers below 2**53
    for h, uses in chunks:
        met, rows = None, np.arange(len(h))
        value = np.zeros((len(h), docs), dtype=np.int32)
        for level in range(LEVELS):
            at = _positions(h[rows], level, height)
            now = np.bitwise_and.reduce([bits[at[:, j]] for j in range(HASHES)])
            met = now if met is None else met & now
            some = met.any(axis=1)
            rows, met = rows[some], met[some]
            if not len(rows):
                break
            value[rows] += np.unpackbits(met, axis=1)[:, :docs] * steps[level].astype(np.int32)
        for no, at, weight in uses:
            out[no] += weight @ value[at]
    return out.astype(np.int64)


def _best_bounds(asked: _Asked, k: int):
    """The ``k`` documents with the highest bounds for each item, of all blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, items = asked.chunks(), len(asked.wanted)
        best, whose = np.zeros((items, 0), np.int64), np.zeros((items, 0), np.int64)
        for b in batches:
            for row in (r for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
                found = bounds(row, asked, chunks)
                marks = np.broadcast_to(np.frombuffer(row["marks"], "<i8"), found.shape)
                best, whose = np.concatenate([best, found], axis=1), np.concatenate([whose, marks], axis=1)
                if best.shape[1] > k:
                    top = np.argpartition(best, -k, axis=1)[:, -k:]
                    best, whose = np.take_along_axis(best, top, 1), np.take_along_axis(whose, top, 1)
        no, at = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays([pa.array(no, pa.int32()), pa.array(whose[no, at]), pa.array(best[no, at])], names=["no", "mark", "bound"])

    return run


def _reaching(asked: _Asked, bars: np.ndarray):
    """Every document whose bound is above 0 and reaches the item's bar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = asked.chunks()
        for b in batches:
            for row in (r for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
                no, at = np.nonzero(bounds(row, asked, chunks) >= np.maximum(bars, 1)[:, None])
                marks = np.frombuffer(row["marks"], "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(no, pa.int32()), pa.array(marks[at])], names=["no", "mark"])

    return run


# -- exact scores ------------------------------------------------------------------------------------


def score(counted: Counter, n: int, wanted: dict[bytes, int], n_docs: int, n_tokens: int) -> int:
    """The score of a document with the counted terms for an item's weighted terms."""
    m = _norm(n, n_docs, n_tokens)
    return sum(w * (10**9 * tf // (1000 * tf + 12 * m)) for t, w in wanted.items() if (tf := counted.get(t)))


def _scored(asked: _Asked):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, mark, text, items in zip(*(map(lambda x: x.as_py(), c) for c in b.columns)):
                words = terms(text)
                counted = Counter(words)
                rows += [(no, doc_id, mark, score(counted, len(words), asked.wanted[no], asked.n_docs, asked.n_tokens)) for no in items]
            columns = zip(*rows) if rows else [()] * 4
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["no", "doc_id", "mark", "score"])

    return run


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item; tasks keep ``k`` before the shuffle."""
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "mark")
    return rows.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


@dataclass
class Index:
    docs: DataFrame  # doc_id, text, mark
    rows: DataFrame  # blocks and vocabulary
    n_docs: int
    n_tokens: int

    @classmethod
    def build(cls, docs: DataFrame) -> Index:
        """Reads all of ``docs`` (doc_id, text) once and writes the index to the shared folder."""
        whole = text_of(docs).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark"))
        rows = stored(whole.select("mark", "text").mapInArrow(_indexed, _INDEX), "signatures")
        sums = rows.where("docs is not null").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).first()
        return cls(whole, rows, sums.docs or 0, sums.tokens or 0)

    def _asked(self, texts: list[str]) -> _Asked:
        counted = [Counter(terms(t)) for t in texts]
        spark = self.docs.sparkSession
        # At most CHARACTERS bytes of terms.
        every = spark.createDataFrame([(bytearray(t),) for t in sorted({t for c in counted for t in c})], "term binary")
        found = self.rows.where("term is not null").select("term", "df").join(F.broadcast(every), "term").groupBy("term").agg(F.sum("df").alias("df"))
        weight = {bytes(r.term): math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * r.df + 1))) for r in found.collect()}
        return _Asked([{t: q * weight[t] for t, q in c.items() if weight.get(t)} for c in counted], self.n_docs, self.n_tokens)

    def _exact(self, pairs: DataFrame, asked: _Asked) -> DataFrame:
        """(no, doc_id, mark, score) of all rows that ``pairs`` (no, mark) names; a foreign row of the same
        64-bit mark is scored by its own text, which does no harm."""
        items = pairs.groupBy("mark").agg(F.collect_set("no").alias("items"))
        rows = self.docs.join(items, "mark").select("doc_id", "mark", "text", "items")
        return rows.mapInArrow(_scored(asked), "no int, doc_id long, mark long, score long")

    def _search(self, texts: list[str], k: int) -> DataFrame:
        asked = self._asked(texts)
        blocks = self.rows.where("docs is not null").drop("term", "df")
        seeds = blocks.mapInArrow(_best_bounds(asked, k), "no int, mark long, bound long")
        order = Window.partitionBy("no").orderBy(F.desc("bound"), "mark")
        seeds = seeds.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        bars = np.zeros(len(texts), dtype=np.int64)
        lowest = _ranked(self._exact(seeds, asked), k).groupBy("no").agg(F.min("score").alias("bar"), F.count("*").alias("n"))
        for r in lowest.where(F.col("n") == k).collect():  # one row per item at most
            bars[r.no] = r.bar
        pairs = blocks.mapInArrow(_reaching(asked, bars), "no int, mark long")
        return _ranked(self._exact(pairs, asked), k).select("no", "rank", "doc_id", "score")

    def search(self, items: DataFrame, k: int = 20) -> DataFrame:
        """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of each row of
        ``items`` (item_id, text)."""
        spark, found = self.docs.sparkSession, None
        held, size = [], 0

        def answers() -> DataFrame:
            ids = spark.createDataFrame([(no, x[0]) for no, x in enumerate(held)], f"no int, item_id {items.schema['item_id'].dataType.simpleString()}")
            best = self._search([x[1] for x in held], k).join(F.broadcast(ids), "no")
            return stored(best.select("item_id", "rank", "doc_id", "score"), "ranked")

        if self.n_docs:
            for row in items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).toLocalIterator():
                held.append((row.item_id, row.text))
                size += len(row.text)
                if len(held) >= ITEMS or size >= CHARACTERS:
                    found = answers() if found is None else found.unionAll(answers())
                    held, size = [], 0
            if held:
                found = answers() if found is None else found.unionAll(answers())
        if found is None:
            found = items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
        return found


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index.build(documents(spark, sf_dir)).search(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), sizes AS (
    SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_tokens FROM words WHERE len(t) > 0
), lengths AS (
    SELECT doc_id, 100 - 25 + (25 * len(t) * n_docs) // n_tokens AS m FROM words, sizes WHERE len(t) > 0
), counts AS (
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM words) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, sizes GROUP BY term
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id)
    GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
"""
