"""Removal of passages that another document already holds, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window over it also starts in a
document with a smaller doc_id. The minimiser of a window is the least hash of its runs of ``GRAM`` words;
equal windows have equal minimisers, and a run of consecutive windows with one minimiser (a super-k-mer,
at most ``RUN`` windows) is one packed string of words, about three times shorter than its windows apart.

1. Every document is cut into its super-k-mers: place, minimiser and a 64-bit name of the packed string.
   Equal strings are folded before the shuffle, to the least and greatest doc_id that hold them.
2. A minimiser with one string is settled by that: its windows stand nowhere else. Of all others, one copy
   of each string travels, packed, to the bucket of its minimiser; the document that holds it is cut again.
3. There the words get numbers, and sorting runs of 3, 9, 27 and then 50 numbers gives equal windows equal
   ranks, without hashes. Each string learns which of its windows a smaller doc_id holds (a 64-bit mask).
4. The masks go back to the places of step 1, and each document drops the words that are covered.

A bucket of more than ``BLOCK`` strings (the edges of a passage that very many documents share) is dealt
into blocks; its windows are then folded block by block and meet by a 128-bit name of the window. Nothing
is left out, and no task holds more than a block's strings at once. Two different strings of one minimiser
share a name with a probability of 2**-64, so n of them hold such a pair with one of n * n / 2**65.

Defined cases: words are cut at ASCII white space, letters stay as they are; a null or empty text has no
words and the hash of the empty text; fewer than 50 words have no window; a null doc_id counts as greater
than all others; rows with one doc_id are documents of their own, none smaller than the other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import documents, stored, text_of
from siltbed.llm.neardup import mix

WINDOW, GRAM = 50, 6
#: Windows of one packed string at most (the bits of a mask), and strings of one block of a bucket.
RUN, BLOCK = 64, 1 << 15
#: Words a worker handles at once, about.
AT_ONCE = 1 << 18

_LAST = (1 << 63) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEED = np.uint64(0x2545F4914F6CDD1D)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


def cut(texts: list[list[bytes]], block: int = RUN) -> tuple[np.ndarray, ...]:
    """The super-k-mers of some documents' words: (document, first window, windows, minimiser, name)."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    total = int(lengths.sum())
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if not len(lengths) or lengths.max() < WINDOW:
        return none
    w = mix(np.fromiter((xxhash.xxh3_64_intdigest(x) for t in texts for x in t), np.uint64, total) ^ _SEED)
    grams = np.zeros(total - GRAM + 1, np.uint64)
    for j in range(GRAM):
        grams = grams * _BASE + w[j : total - GRAM + 1 + j]
    least, reach = mix(grams), 1  # the least of `reach` grams from each place
    width = WINDOW - GRAM + 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: reach - width], least[width - reach :])
    owner = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(total - WINDOW + 1)
    at = at[at + WINDOW <= ends[owner[: len(at)]]]
    least = least[at]
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1])]
    since = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    first = np.flatnonzero(since % block == 0)
    windows = np.diff(np.r_[first, len(at)])
    start, key = at[first], least[first]
    up, down = _powers(_BASE, total), _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), total)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * up[1:])])
    name = mix((sums[start + windows + WINDOW - 1] - sums[start]) * down[start] + windows.astype(np.uint64))
    own = owner[start]
    return own, start - (ends - lengths)[own], windows, key, name


def _parts(b: pa.RecordBatch, texts: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of a batch with the words of its texts, about ``AT_ONCE`` words each."""
    first, words, size = 0, [], 0
    for i, text in enumerate(b.column(texts)):
        words.append((text.as_py() or "").encode().split())
        size += len(words[-1])
        if size >= AT_ONCE or i == b.num_rows - 1:
            yield b.slice(first, i + 1 - first), words
            first, words, size = i + 1, [], 0


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, words in _parts(b, 2):
            own, at, windows, *names = cut(words)
            rows = pa.array(own)
            columns = [part.column(0).take(rows), part.column(1).take(rows), at.astype(np.int32), windows.astype(np.int32), *map(_signed, names)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["ord", "mark", "at", "n", "key", "name"])


_PACKED = "key long, block int, name long, first long, words binary, blocks int"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document (ord, text, wanted) the super-k-mers that are wanted of it, as strings."""
    names = [c.split()[0] for c in _PACKED.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32()]
    for b in batches:
        for part, words in _parts(b, 1):
            wanted = [{(x["key"], x["name"]): (x["block"], x["blocks"]) for x in w} for w in part.column(2).to_pylist()]
            docs, rows = part.column(0).to_pylist(), []
            own, at, windows, key, name = cut(words)
            for o, i, n, k, a in zip(own.tolist(), at.tolist(), windows.tolist(), _signed(key).tolist(), _signed(name).tolist()):
                if (told := wanted[o].pop((k, a), None)) is not None:
                    rows.append((k, told[0], a, docs[o], b" ".join(words[o][i : i + n + WINDOW - 1]), told[1]))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _joined(*runs: np.ndarray) -> np.ndarray:
    """One number for each row of numbers below 2**31, equal only for equal rows."""
    if len(runs) == 3 and max(int(x.max(initial=0)) for x in runs) >> 21:
        return _joined(_joined(*runs[:2]), runs[2])
    bits, row = 21 if len(runs) == 3 else 31, runs[0]
    for x in runs[1:]:
        row = (row << bits) | x
    return np.unique(row, return_inverse=True)[1]


def ranked(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, rank) of every window of some packed strings; equal windows have equal ranks.

    Words are numbered, then runs of 3, 9 and 27 numbers, each by sorting rows of three shorter ones; two
    runs of 27 that overlap make a window."""
    lengths = np.array([len(x) for x in words], dtype=np.int64)
    number: dict[bytes, int] = defaultdict(count().__next__)
    r = np.fromiter((number[x] for s in words for x in s), np.int64, int(lengths.sum()))
    size = 1
    while 3 * size <= WINDOW:
        n = len(r) - 2 * size
        r = _joined(r[:n], r[size : n + size], r[2 * size :])
        size *= 3
    per = lengths - WINDOW + 1
    own = np.repeat(np.arange(len(words)), per)
    offset = np.arange(len(own)) - np.repeat(np.cumsum(per) - per, per)
    at = (np.cumsum(lengths) - lengths)[own] + offset
    return own, offset, _joined(r[at], r[at + WINDOW - size])


_FOUND = "key long, name long, mask long, at int, wa long, wb long, first long"
_FOUND_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def _judged(rows: list[tuple], torn: set[int]) -> pa.RecordBatch:
    """Masks of the windows that a smaller document of these rows (key, block, name, first, words, blocks)
    holds; of minimisers in ``torn``, whose strings lie in several blocks, the windows by name instead."""
    words = [r[4].split(b" ") for r in rows]
    first = np.array([r[3] for r in rows], dtype=np.int64)
    own, offset, rank = ranked(words)
    least = np.full(int(rank.max()) + 1, _LAST, dtype=np.int64)
    np.minimum.at(least, rank, first[own])
    bits = np.where(least[rank] < first[own], np.uint64(1) << offset.astype(np.uint64), np.uint64(0))
    masks = np.bitwise_or.reduceat(bits, np.searchsorted(own, np.arange(len(rows))))
    out = [(r[0], r[2], m, None, None, None, None) for r, m in zip(rows, _signed(masks).tolist()) if m and r[0] not in torn]
    if torn:
        for s, i in zip(own.tolist(), offset.tolist()):
            if (r := rows[s])[0] in torn:
                window = xxhash.xxh3_128_digest(b" ".join(words[s][i : i + WINDOW]))
                out.append((r[0], r[2], None, i, *np.frombuffer(window, "<i8").tolist(), r[3]))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 7, _FOUND_TYPES)], names=[c.split()[0] for c in _FOUND.split(", ")])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole blocks of buckets, in order of (key, block, name); several small ones are sorted at once."""
    rows = (row for b in batches for at in range(0, b.num_rows, 4096) for row in zip(*(c.to_pylist() for c in b.slice(at, 4096).columns)))
    held, size, torn = [], 0, set()
    for _, bucket in groupby(rows, key=lambda r: r[:2]):
        for _, copies in groupby(bucket, key=lambda r: r[2]):
            held.append(next(copies))
            size += len(held[-1][4]) // 7 + 1
        if held[-1][5] > 1:
            torn.add(held[-1][0])
        if size >= AT_ONCE:
            yield _judged(held, torn)
            held, size, torn = [], 0, set()
    if held:
        yield _judged(held, torn)


def _marked(docs: DataFrame) -> DataFrame:
    """(ord, mark, text, doc_id): the place of the doc_id, with null as the greatest, and a name of the row."""
    return text_of(docs).select(F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), F.xxhash64("doc_id", "text").alias("mark"), "text", "doc_id")


def repeats(docs: DataFrame) -> DataFrame:
    """(ord, mark, spans): for each row of ``_marked`` documents that repeats something, the places
    (at, n, bits) of super-k-mers; bit i stands for the window at word at + i."""
    runs = stored(docs.select("ord", "mark", "text").mapInArrow(_runs, "ord long, mark long, at int, n int, key long, name long"), "runs")
    holder = F.min_by("mark", "ord").alias("mark")
    strings = stored(runs.groupBy("key", "name").agg(F.min("ord").alias("first"), F.max("ord").alias("last"), holder), "strings")
    # Where all strings of a minimiser come from one document, none can repeat another's window.
    buckets = strings.groupBy("key").agg(F.count("*").alias("size"), F.min("first").alias("lo"), F.max("last").alias("hi"))
    buckets = stored(buckets.where("size > 1 and lo < hi").select("key", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("blocks")), "buckets")
    block = F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int").alias("block")
    wanted = strings.join(buckets, "key").select(F.col("first").alias("ord"), "mark", F.struct("key", "name", block, "blocks").alias("x"))
    wanted = stored(wanted.groupBy("ord", "mark").agg(F.collect_list("x").alias("wanted")), "wanted")
    packed = docs.join(wanted, ["ord", "mark"]).select("ord", "text", "wanted").mapInArrow(_packed, _PACKED)
    found = packed.repartition("key", "block").sortWithinPartitions("key", "block", "name").mapInArrow(_buckets, _FOUND)
    found = stored(found, "windows")

    windows = found.where("wa is not null")
    holders = windows.groupBy("wa", "wb").agg(F.min("first").alias("least"))
    again = windows.join(holders, ["wa", "wb"]).where("least < first").select("key", "name", F.expr("shiftleft(1L, at)").alias("mask"))
    masks = found.where("mask is not null").select("key", "name", "mask").unionAll(again)
    masks = masks.groupBy("key", "name").agg(F.bit_or("mask").alias("mask"))
    # A later holder of a string repeats all of its windows; every holder those that a mask names.
    told = strings.where("last > first").select("key", "name", "first", F.lit(-1).cast("long").alias("bits"))
    told = told.unionAll(masks.select("key", "name", F.lit(None).cast("long"), "mask"))
    places = runs.join(told, ["key", "name"]).where("first is null or ord > first").select("ord", "mark", "at", "n", "bits")
    return places.groupBy("ord", "mark").agg(F.collect_set(F.struct("at", "n", "bits")).alias("spans"))


def covered(n_words: int, spans: list[dict]) -> np.ndarray:
    """True for the words under the windows of ``spans``."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    for x in spans:
        at = x["at"] + np.flatnonzero((np.uint64(x["bits"] & (1 << 64) - 1) >> np.arange(x["n"], dtype=np.uint64)) & np.uint64(1))
        edges[at] += 1
        edges[at + WINDOW] -= 1
    return np.cumsum(edges[:-1]) > 0


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            sizes, gone, texts = [], [], []
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                words = text.encode().split()
                sizes.append(len(words))
                if spans:
                    cover = covered(len(words), spans).tolist()
                    words = [x for x, c in zip(words, cover) if not c]
                gone.append(sizes[-1] - len(words))
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "n_removed", "text"],
            )


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, text): one row per row of ``docs``; ``text`` is what is left, words
    joined by one space."""
    marked = _marked(docs)
    rows = marked.join(repeats(marked), ["ord", "mark"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, text string")


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: Words of a text, null as empty, and the same document's windows as text with their places.
OP12_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS x FROM places
), again AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS first_doc FROM windows) WHERE first_doc < doc_id
), gone AS (
    SELECT doc_id, list_distinct(flatten(list(range(i, i + 50)))) AS g FROM again GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(coalesce(g, []))::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(g, k)) END, ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""
