"""Fingerprints by consistent weighted sampling of a document's words.

A document is its words (lower-case A-Z, cut at ASCII white space), each weighted by how often it comes.
For every sample and word, r and c follow the gamma distribution of shape two and b the uniform one, all
three drawn from a hash of the word, so they are the same in every document. With weight w,
t = floor(ln w / r + b), ln y = r (t - b), and ln a = ln c - ln y - r; the sample is the word with the
least a, together with its t. Two documents draw the same sample with a probability equal to their
generalised Jaccard similarity (sum of least weights over sum of greatest), so the share of equal samples
estimates it, with a standard error of at most 0.5 / sqrt(SAMPLES).

A fingerprint is the text of 16-bit codes of all samples; two different samples share a code with
probability 2**-16. Equal texts have equal fingerprints.

Defined cases: a null text counts as empty; an empty text, or one of white space, has the fingerprint ""
and is like another such text (1.0) and unlike any other (0.0); rows come in descending doc_id, null ids
last, rows with one id by a hash of their text; the first row follows the last; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import documents, importable, text_of
from siltbed.llm.neardup import mix

SAMPLES = 128
#: Rows of drawn samples (1 KB each) that a worker keeps for good, and as many for a while.
KEPT = 60_000
_SEEDS = mix(np.arange(1, 3 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)).reshape(3, SAMPLES)


def _mixed(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """``mix`` in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= np.right_shift(x, np.uint64(shift), out=spare)
        x *= np.uint64(factor)
    x ^= np.right_shift(x, np.uint64(31), out=spare)
    return x


def _uniform(bits: np.ndarray, half: int) -> np.ndarray:
    """Numbers strictly between 0 and 1 from the lowest 24 bits of each low (0) or high (1) half."""
    x = (bits.view("<u4")[..., half::2] & np.uint32(0xFFFFFF)).view("<i4").astype(np.float32)
    x += np.float32(0.5)
    x *= np.float32(2.0**-24)
    return x


def _log_of_product(bits: np.ndarray) -> np.ndarray:
    x = _uniform(bits, 0)
    x *= _uniform(bits, 1)
    return np.log(x, out=x)


def draws(words: list[bytes], weights: np.ndarray) -> np.ndarray:
    """One row per word: for each sample ln a as an ordered number in the high half and the code of
    (word, t) in the low half, so that the least number of a column is the sample."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.dtype("<u8"), len(words))[:, None]
    m, spare = np.empty((2, len(words), SAMPLES), dtype="<u8")
    r = _log_of_product(_mixed(np.add(h, _SEEDS[0], out=m), spare))
    np.negative(r, out=r)
    ln_a = _log_of_product(_mixed(np.add(h, _SEEDS[1], out=m), spare))
    np.negative(ln_a, out=ln_a)
    np.log(ln_a, out=ln_a)
    b = _uniform(_mixed(np.add(h, _SEEDS[2], out=m), spare), 0)
    t = np.floor(b)  # with weight 1, whose logarithm is 0
    more = np.flatnonzero(weights != 1)
    t[more] = np.floor(np.log(weights[more].astype(np.float32))[:, None] / r[more] + b[more])
    ln_a -= np.multiply(r, np.subtract(t, b, out=b), out=b)
    ln_a -= r
    bits = ln_a.view("<u4")
    bits ^= (ln_a.view("<i4") >> 31).view("<u4") | np.uint32(1 << 31)
    out = bits.astype(np.uint64)
    out <<= np.uint64(32)
    # Where t is 0 in every sample, all have one code.
    moved = np.flatnonzero(t.any(axis=1))
    plain = np.ones(len(words), dtype=bool)
    plain[moved] = False
    out[plain] |= mix(h[plain]) >> np.uint64(32)
    out[moved] |= mix(h[moved] ^ (t[moved].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(32)
    return out


class _Places(dict):
    """The row of each word (met once in a text) or (word, weight); a new one has the next row."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, key) -> int:
        self[key] = at = len(self)
        self.new.append(key)
        return at


class Sampler:
    def __init__(self):
        self.at = _Places()
        #: The words met after the first KEPT, in the order of their rows.
        self.later: list = []
        self.rows = np.zeros((1024, SAMPLES), dtype=np.uint64)
        self.spare = np.empty((256, SAMPLES), dtype=np.uint64)

    def _draw(self, base: int, new: list) -> None:
        while len(self.rows) < base + len(new):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        for i in range(0, len(new), 128):  # small enough for the processor's cache
            part = [k if type(k) is tuple else (k, 1) for k in new[i : i + 128]]
            self.rows[base + i : base + i + len(part)] = draws([w for w, _ in part], np.array([n for _, n in part]))

    def _least(self, rows: np.ndarray) -> np.ndarray:
        least = None
        for i in range(0, len(rows), len(self.spare)):
            part = rows[i : i + len(self.spare)]
            found = np.take(self.rows, part, axis=0, out=self.spare[: len(part)], mode="clip").min(axis=0)
            least = found if least is None else np.minimum(least, found)
        return least

    def codes(self, texts: list[str]) -> list[np.ndarray | None]:
        """The 16-bit sample codes of each text; None without words."""
        at, base = self.at, len(self.at)
        places = []
        for t in texts:
            keys = [w if n == 1 else (w, n) for w, n in Counter(t.encode().lower().split()).items()]
            places.append(np.fromiter(map(at.__getitem__, keys), np.int64, len(keys)))
        self._draw(base, at.new)
        out = [(self._least(rows) & np.uint64(0xFFFF)).astype(">u2") if len(rows) else None for rows in places]
        # The words met first are kept, frequent ones among them; later ones until there are too many.
        self.later += at.new[max(0, KEPT - base) :]
        at.new.clear()
        if len(self.later) > KEPT:
            for k in self.later:
                del at[k]
            self.later.clear()
        return out


_sampler: list[Sampler] = []


def sampler() -> Sampler:
    """One per worker process."""
    if not _sampler:
        _sampler.append(Sampler())
    return _sampler[0]


def spelled(codes: np.ndarray | None) -> str:
    return "" if codes is None else codes.tobytes().hex()


def likeness(x: np.ndarray | None, y: np.ndarray | None) -> float:
    if x is None or y is None:
        return float(x is None and y is None)
    return float((x == y).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint), without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                codes = sampler().codes(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(spelled, codes), pa.string())], names=["doc_id", "fingerprint"])

    importable(docs.sparkSession)
    return text_of(docs).mapInArrow(run, "doc_id long, fingerprint string")


# -- each document beside the next -------------------------------------------------------------------


def _key(doc_id: int | None, h: int) -> tuple:
    return (doc_id is None, -(doc_id or 0), h)


def beside_next(docs: DataFrame) -> DataFrame:
    """(bucket, extra, doc_id, h, text), one bucket a partition, in order; each bucket ends with a copy
    (``extra`` = 1) of the row after its last.

    Bucket borders are keys of rows, taken from a sample of about 40 keys a bucket, as range partitioning
    does; every row goes to its bucket."""
    spark = docs.sparkSession
    rows = text_of(docs).withColumn("h", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = rows.select("doc_id", "h").orderBy(F.col("doc_id").desc_nulls_last(), "h").limit(1).collect()
    first_key = _key(*first[0]) if first else None
    share = min(1.0, 40 * parts / max(docs.count(), 1))
    sample = sorted(_key(r.doc_id, r.h) for r in rows.sample(share, seed=3).select("doc_id", "h").collect())
    step = max(1, len(sample) // parts)
    borders = sorted(set(sample[step::step]) - {first_key})
    inner = set(borders)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [_key(d, h) for d, h in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
            bucket = [bisect_right(borders, k) for k in keys]
            again = [i for i, k in enumerate(keys) if k in inner or k == first_key]
            to = [len(borders) if keys[i] == first_key else bucket[i] - 1 for i in again]
            for part, where, extra in ((b, bucket, 0), (b.take(pa.array(again, pa.int64())), to, 1)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where, pa.int32()), pa.array([extra] * len(where), pa.int32()), *(part.column(i) for i in (0, 2, 1))],
                    names=["bucket", "extra", "doc_id", "h", "text"],
                )

    dealt = rows.mapInArrow(deal, "bucket int, extra int, doc_id long, h long, text string")
    order = ["bucket", "extra", F.col("doc_id").desc_nulls_last(), "h", "text"]
    return dealt.repartitionById(len(borders) + 1, F.col("bucket")).sortWithinPartitions(*order)


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in EDITED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def done(rows: list[tuple], after: str) -> pa.RecordBatch:
        """The rows (doc_id, text), followed by the text ``after``."""
        texts = [t for _, t in rows] + [after]
        edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for t, n in zip(texts, texts[1:])]
        codes = sampler().codes(texts + edited)
        own, new = codes[: len(texts)], codes[len(texts) :]
        out = [
            (d, len(t), hashlib.sha256(e.encode()).hexdigest(), spelled(o), spelled(x), likeness(o, x), likeness(o, n))
            for (d, t), e, o, x, n in zip(rows, edited, own, new, own[1:])
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    waiting: list[tuple] = []
    for b in batches:
        for at in range(0, b.num_rows, 64):
            part = b.slice(at, 64)
            for extra, doc_id, text in zip(*(part.column(i).to_pylist() for i in (1, 2, 4))):
                if extra:
                    if waiting:
                        yield done(waiting, text)
                        waiting = []
                elif len(waiting) >= 64:
                    yield done(waiting, text)
                    waiting = [(doc_id, text)]
                else:
                    waiting.append((doc_id, text))
    assert not waiting, "a bucket without the row after its last"


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return beside_next(documents(spark, sf_dir)).mapInArrow(_edited, EDITED)
