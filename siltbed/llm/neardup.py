"""Near-duplicates by fast similarity sketching, banding and exact comparison.

A document is the set of its distinct five-word shingles (64-bit hashes). Its sketch has T coordinates,
filled in rounds: round i throws every shingle into one coordinate by its i-th hash and keeps the smallest
hash where nothing lies yet; after T such rounds, a further round for each coordinate puts all shingles
into it, so none stays empty. Two sketches agree in a share of coordinates close to the sets' Jaccard
similarity. ``BANDS`` bands of ``ROWS`` coordinates make buckets; a pair at similarity 0.75 misses all of
them with probability 2e-5, at 0.8 with 1e-7. Every link is confirmed on the full sets.

Equal sets are one class from the start. Within a bucket no list of all pairs is made: first every class
is compared with the smallest one of its bucket. Where a bucket still holds several components (classes
that share a passage, say, but little else), its classes are dealt into blocks of about ``BLOCK``, and
blocks are held against each other by their sketches; only pairs of different components whose sketches
agree in ``LIKELY`` of their coordinates go on to the exact comparison. At similarity 0.75 that is five
standard deviations below what is expected (one pair in two million). First each class is compared with
the one most like it, which joins nearly all that can be joined; then all likely pairs that are still of
different components are compared, where the blocks meet: their texts come along, and only links leave, so
pairs that share much but too little for a link are never rows. A pair that meets in several buckets is
compared in the first. A pair of one component joins nothing that is not joined already, so the components
are those of all links among the candidates.

Defined cases: words are cut at ASCII white space after lower-casing A-Z; fewer than five words make one
shingle of them all; a null or empty text has no shingles and is linked with nothing; rows with one
doc_id are documents of their own; a null doc_id takes part, but never names a component; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import documents, stored, text_of
from siltbed.llm.components import components

SHINGLE, ROWS, BANDS = 5, 5, 40
T = ROWS * BANDS
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Classes of a block, and the share of equal coordinates from which a pair is compared exactly.
BLOCK, LIKELY = 256, 0.6

_M = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = mix(np.arange(1, 2 * T + 1, dtype=np.uint64) * _M)


def shingles(text: str) -> np.ndarray:
    """The sorted distinct shingles of one text."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(SHINGLE, len(w))
    h = np.full(len(w) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        h = h * _M + w[j : len(w) - k + 1 + j]
    return np.unique(mix(h))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of T coordinates for each set; all sets have elements."""
    n = len(sets)
    out = np.full(n * T, _EMPTY, dtype=np.uint64)
    x = np.concatenate(sets)
    owner = np.repeat(np.arange(n, dtype=np.int64), [len(s) for s in sets])
    low = np.uint64(0xFFFFFFFF)
    open_ = np.ones(n, dtype=bool)
    for i in range(T):
        h = mix(x + _SEEDS[i])
        at = owner * T + ((h >> np.uint64(32)) * np.uint64(T) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(out, at, (np.uint64(i) << np.uint64(32)) | (h & low))
        if i < 8 or i % 4 == 0:
            open_ = (out.reshape(n, T) == _EMPTY).any(axis=1)
            more = open_[owner]
            x, owner = x[more], owner[more]
            if not len(x):
                break
    if len(x):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        rows = out.reshape(n, T)
        for j in range(T):
            least = np.minimum.reduceat(mix(x + _SEEDS[T + j]) & low, starts) | (np.uint64(T + j) << np.uint64(32))
            docs = owner[starts]
            bare = rows[docs, j] == _EMPTY
            rows[docs[bare], j] = least[bare]
    return out.reshape(n, T)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each sketch."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]) * _M
    for r in range(ROWS):
        key = mix(key * _M + parts[:, :, r])
    return key


def _set_key(s: np.ndarray) -> tuple[int, int]:
    """A name for a whole set that does not depend on order: two 64-bit numbers."""
    a = mix(s + _SEEDS[0]).sum(dtype=np.uint64)
    b = mix(s ^ _SEEDS[1]).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            sets = [shingles(t) for t in part.column(1).to_pylist()]
            full = [s for s in sets if len(s)]
            made = sketches(full) if full else np.zeros((0, T), np.uint64)
            keys, short = iter(band_keys(made).view(np.int64)), iter((made & np.uint64(0xFFFF)).astype("<u2"))
            names = [_set_key(s) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([a for a, _ in names], pa.int64()),
                    pa.array([x for _, x in names], pa.int64()),
                    pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    pa.array([next(short).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "mark", "n_shingles", "a", "b", "bands", "sketch"],
            )


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    small, large = sorted((len(x), len(y)))
    if 100 * small < PERCENT * large:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        known: dict[str, np.ndarray] = {}  # neighbouring rows often share a text
        u, v = [], []
        for x, y, s, t in zip(*(c.to_pylist() for c in b.columns)):
            for text in (s, t):
                if text not in known:
                    if len(known) > 64:
                        known.clear()
                    known[text] = shingles(text)
            first = known[s] if s in known else shingles(s)
            if linked(first, known[t]):
                u.append(x)
                v.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def shared(x: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """How many elements of each of ``sets`` are in ``x``; all are sorted and have elements."""
    out = np.empty(len(sets), dtype=np.int64)
    ends = np.cumsum([len(s) for s in sets])
    a = 0
    while a < len(sets):  # about a million elements at a time
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (1 << 20), "right")))
        some = np.concatenate(sets[a:b])
        hit = x[np.minimum(np.searchsorted(x, some), len(x) - 1)] == some
        starts = np.cumsum([0, *(len(s) for s in sets[a : b - 1])])
        out[a:b] = np.add.reduceat(hit.astype(np.int64), starts)
        a = b
    return out


def _met(best: bool):
    """Rows come sorted by (band, i, j), at most two blocks each: with ``best`` the likeliest partner of each
    row among those of other components; without, the links among all likely pairs of different components."""

    def pairs(rows: list[tuple]) -> tuple[list[int], list[int]]:
        block, a, n, root = (np.array([r[k] for r in rows], dtype=np.int64) for k in (3, 4, 5, 6))
        sketch = np.frombuffer(b"".join(r[7] for r in rows), dtype="<u2").reshape(len(rows), T)
        whole = rows[0][1] == rows[0][2]
        if not best:
            bands = np.array([r[8] for r in rows], dtype=np.int64)
            here = (bands == rows[0][0]).argmax(axis=1)
        sets: dict[int, np.ndarray] = {}

        def set_of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(rows[i][9])
            return sets[i]

        u, v = [], []
        for r in range(len(rows)):
            ok = (root != root[r]) & (100 * np.minimum(n, n[r]) >= PERCENT * np.maximum(n, n[r]))
            if not whole:
                ok &= block != block[r]
            if not best:
                ok[: r + 1] = False
            at = np.flatnonzero(ok)
            if len(at):
                share = (sketch[at] == sketch[r]).mean(axis=1)
                at, share = at[share >= LIKELY], share[share >= LIKELY]
                if best and len(at):
                    at = at[[np.lexsort((a[at], -share))[0]]]
                if not best and len(at):
                    at = at[(bands[at] == bands[r]).argmax(axis=1) == here[r]]
                if not best and len(at):
                    both = shared(set_of(r), [set_of(i) for i in at.tolist()])
                    at = at[100 * both >= PERCENT * (n[at] + n[r] - both)]
                u.extend(np.minimum(a[at], a[r]).tolist())
                v.extend(np.maximum(a[at], a[r]).tolist())
        return u, v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            u, v = [], []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and row[:3] != held[0][:3]:
                    for out, found in zip((u, v), pairs(held)):
                        out.extend(found)
                    held = []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
        if held:
            u, v = pairs(held)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _across(members: DataFrame, classes: DataFrame, texts: DataFrame, roots: DataFrame, best: bool) -> DataFrame:
    """Pairs (u, v) within the buckets that hold several components, block against block, as ``_met``."""
    placed = members.join(roots, members["id"] == roots["node"], "left").select("band", "id", "n", F.coalesce("root", "id").alias("root"))
    torn = placed.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("size")).where("x <> y")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    known = classes.select("id", "sketch") if best else classes.select("id", "sketch", "bands").join(texts, "id")
    rest = placed.join(torn.select("band", blocks.alias("blocks")), "band").join(known, "id")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    place = ["band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    rest = rest.select(*place, "block", "id", "n", "root", *known.columns[1:]).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    met = rest.mapInArrow(_met(best), "u long, v long")
    return met.distinct() if best else met


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets are close enough."""
    second = pairs.join(texts.select(F.col("id").alias("v"), F.col("text").alias("t")), "v")
    both = second.join(texts.select(F.col("id").alias("u"), F.col("text").alias("s")), "u")
    return both.select("u", "v", "s", "t").mapInArrow(_confirmed, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, component, mark): one row per row of ``docs``; ``component``
    is the same number for all rows of a component, null without shingles; ``mark`` is a hash of the row's
    id and text."""
    whole = text_of(docs)
    marked = whole.withColumn("mark", F.xxhash64("doc_id", "text"))
    made = stored(marked.mapInArrow(_sketched, "doc_id long, mark long, n_shingles long, a long, b long, bands array<long>, sketch binary"), "sketches")
    sets = made.where("a is not null").groupBy("a", "b").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "mark")).alias("row"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    # The numbers are written with the classes, so they stay what they are.
    classes = stored(sets.withColumn("id", F.monotonically_increasing_id()), "classes")
    dealt = classes.select(F.explode("bands").alias("band"), "id", "n")
    full = dealt.groupBy("band").agg(F.min("id").alias("hub"), F.max("id").alias("other")).where("hub <> other").select("band", "hub")
    members = stored(dealt.join(full, "band"), "members")

    # The texts of all candidates, one per class: that of the one row it is named by, however often it comes.
    wanted = classes.join(members.select("id").distinct(), "id", "left_semi").select("id", "a", "b", F.col("row.doc_id").alias("_doc"), F.col("row.mark").alias("_mark"))
    found = marked.join(wanted, (F.col("mark") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_doc"))).select("id", "a", "b", "text")
    texts = stored(found.transform(_of_its_class).groupBy("id").agg(F.first("text").alias("text")), "texts")

    star = members.where("id <> hub").select(F.col("hub").alias("u"), F.col("id").alias("v")).distinct()
    links = stored(_links(star, texts), "links")
    roots = components(links)

    likeliest = stored(_across(members, classes, texts, roots, True), "across")
    links = stored(links.unionAll(_links(likeliest, texts)), "links")
    roots = components(links)
    links = stored(links.unionAll(_across(members, classes, texts, roots, False)), "links")
    roots = components(links)

    rooted = classes.select("id", "a", "b", "least").join(roots, classes["id"] == roots["node"], "left").select("a", "b", "least", F.coalesce("root", "id").alias("component"))
    named = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = rooted.select("a", "b", "component").join(named, "component")
    out = made.select("doc_id", "mark", "n_shingles", "a", "b").join(by_class, ["a", "b"], "left")
    component_id = F.when(F.col("a").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(component_id).alias("kept"),
        "component",
        "mark",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without near-duplicates: of each component the row
    with the least doc_id stays, and of equal rows one. Rows without words stay as they are."""
    decided = near_duplicates(docs).where("component is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "mark")).alias("first")
    winners = decided.groupBy("component").agg(first).select(F.coalesce("first.doc_id", F.lit(0)).alias("_id"), F.col("first.mark").alias("_mark"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    text, doc_id = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("long")
    rows = docs.select(row, F.coalesce(doc_id, F.lit(0)).alias("_id"), F.xxhash64(doc_id, text).alias("_mark"), text.rlike(r"[^\x20\x09-\x0D]").alias("_words"))
    kept = rows.where("_words").join(winners, ["_id", "_mark"], "left_semi").groupBy("_id", "_mark").agg(F.first("_row").alias("_row"))
    return kept.select("_row").unionAll(rows.where("not _words").select("_row")).select("_row.*")


def _of_its_class(found: DataFrame) -> DataFrame:
    """(id, text) of the rows whose text belongs to the class they were found for: two marks may coincide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = zip(b.column(1).to_pylist(), b.column(2).to_pylist())
            sets = map(shingles, b.column(3).to_pylist())
            ok = [len(s) > 0 and _set_key(s) == name for name, s in zip(names, sets)]
            part = b.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(3)], names=["id", "text"])

    return found.mapInArrow(run, "id long, text string")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("component", "mark")
