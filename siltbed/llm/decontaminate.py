"""Benchmark decontamination: random walks and sampled steps find candidates, exact edit distance decides.

Texts are read with lower case and single spaces. A walk reads a window from its first character on: at each
step it notes the character it stands on and goes on by one or stays, as a random table of (step, character)
says. The same table for all texts makes two walks that an edit has parted meet again, so a small edit distance
of two windows becomes a small Hamming distance of their notes (the CGK embedding; going on is likelier here
than staying, which lets a walk pass a changed letter). The key of a walk is ``SAMPLED`` of its first
``STEPS`` notes, at random steps spread over them: later ones have drifted too far. ``WALKS`` walks give as many tables of keys.

An item of ``LONG`` characters or more is embedded from each of its words on, as are the windows of a
document from each of its words on; within words of more than ``UNBROKEN`` characters (scripts without
spaces), items from each character on and documents from every eighth. A key in common is a vote for an item
and a diagonal (place in the text less place in the item). Two different places that vote for one item near
one diagonal make a candidate. At the limit of 20 % edits, one window and walk survives with a probability of
about an eighth, and an item has a window per word and three walks of each; the README gives the measured
recall. The work for a character hardly depends on the number of items.

Items below ``LONG`` characters hold too few windows. They are found for certain: an edit voids at most ``q``
of the runs of ``q`` characters that a passage shares with its item, so these are counted, by runs of two or
three, in overlapping bands of diagonals, and a band passes if it holds what so many edits must leave.

Every candidate must hold as many of the item's runs as ``MAX_SHARE`` of edits must leave it, and is then held
against the whole item, by characters, with the exact distance of the item to the best place in the band and
``MAX_SHARE`` of the item's size on either side.

A passage is a leak if its distance is at most ``MAX_SHARE`` of the item's characters; an item too short for
any edit must stand there as whole words. The benchmark is read in blocks of at most ``BLOCK_ITEMS`` items,
the bound of what is sent to the tasks; documents are scanned once per block, in place, without a shuffle.
The work for a character of a document grows with the number of short items only.

Defined cases: null texts count as empty and match nothing, nor do items without a word; repeated items
and repeated documents give a row each; a null doc_id is kept as null; ties between places take the
first; an empty table on either side gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import documents, importable, text_of

MAX_SHARE = 0.2
BLOCK_ITEMS = 20_000
#: Items from this size on are looked for by walks.
LONG = 80
#: Walks from each window, steps of a walk, how many of them make its key, and of 256 how many go on.
WALKS, STEPS, SAMPLED, GOES_ON = 3, 24, 7, 192
#: Places that must vote for a candidate, bits of the width of their band of diagonals, and the size of a word
#: from which windows begin inside it too, in documents at every ``STRIDE`` characters.
VOTES, BAND, UNBROKEN, STRIDE = 2, 5, 16, 8
#: Characters of items that are looked for together, characters of text in one step, and hits held at once.
GROUP, STEP, HELD = 1 << 16, 1 << 17, 1 << 21
_HASH_BITS = 20


def folded(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def run_hashes(c: np.ndarray, q: int) -> np.ndarray:
    """One hash for each run of ``q`` characters."""
    n = max(len(c) - q + 1, 0)
    out = c[:n].copy()
    for j in range(1, q):
        out *= np.uint32(2654435761)
        out += c[j : j + n]
    out *= np.uint32(0x9E3779B1)
    out >>= np.uint32(32 - _HASH_BITS)
    return out


class Item:
    """One item, how many edits it may have, and by which runs it is looked for."""

    def __init__(self, n: int, text: str):
        self.n, self.most = n, int(MAX_SHARE * len(text))
        self.text = text if self.most else f" {text} "
        size = len(self.text)
        self.q = 3 if size >= 16 else 2
        self.runs = run_hashes(codes(self.text), self.q)
        self.band, self.least = self.most.bit_length(), size - self.q + 1 - self.q * self.most


class Group:
    """Items of one run length and like sizes, looked for together."""

    def __init__(self, items: list[Item]):
        self.items, self.q = items, items[0].q
        self.longest = max(len(x.text) for x in items)
        #: A passage that begins within ``step`` lies within ``whole``.
        self.step = max(STEP, 2 * self.longest)
        self.whole = self.step + 2 * self.longest
        hashed = [x.runs for x in items]
        bins = [(self.whole + len(x.text) >> x.band) + 2 for x in items]
        self.first_bin = np.cumsum([0, *bins])
        # A hit at place p falls into the band (p + shift) >> bits, numbered through all items.
        shift = [len(x.text) - np.arange(len(g)) + (int(a) << x.band) for x, g, a in zip(items, hashed, self.first_bin)]
        hashed_all = np.concatenate(hashed)
        order = np.argsort(hashed_all, kind="stable")
        kind = np.int32 if (int(self.first_bin[-1]) << items[-1].band) + self.whole < 1 << 31 else np.int64
        self.shift = np.concatenate(shift)[order].astype(kind)
        self.bits = items[0].band
        if any(x.band != self.bits for x in items):
            self.bits = np.concatenate([np.full(len(g), x.band) for x, g in zip(items, hashed)])[order].astype(kind)
        self.count = np.bincount(hashed_all, minlength=1 << _HASH_BITS).astype(np.int32)
        self.at = (np.cumsum(self.count) - self.count).astype(np.int32)
        self.least = np.repeat([x.least for x in items], bins)
        self.least[self.first_bin[1:] - 1] = 1 << 40  # the last band has no right neighbour of its own

    def bands(self, c: np.ndarray) -> Iterator[tuple[Item, int, int]]:
        """(item, least and greatest diagonal) of the stretches of bands that hold enough hits."""
        g = run_hashes(c, self.q)
        n = self.count[g]
        places = np.flatnonzero(n)
        if not len(places):
            return
        n, first = n[places], self.at[g[places]]
        ends = np.cumsum(n, dtype=np.int64)
        hits, done = None, 0
        while done < len(places):
            before = int(ends[done] - n[done])
            stop = max(done + 1, int(np.searchsorted(ends, before + HELD, "right")))
            part, to = n[done:stop], slice(done, stop)
            posting = np.arange(int(ends[stop - 1]) - before, dtype=np.int32)
            posting += np.repeat(first[to] - (ends[to] - part - before).astype(np.int32), part)
            band = self.shift[posting]
            band += np.repeat(places[to].astype(band.dtype), part)
            band >>= self.bits if isinstance(self.bits, int) else self.bits[posting]
            new = np.bincount(band, minlength=self.first_bin[-1])
            hits, done = new if hits is None else hits + new, stop
        hits[:-1] += hits[1:]
        found = np.flatnonzero(hits >= self.least)
        if not len(found):
            return
        owner = np.searchsorted(self.first_bin, found, "right") - 1
        cut = np.flatnonzero((np.diff(found) > 2) | (np.diff(owner) > 0)) + 1
        for a, b in zip(np.r_[0, cut], np.r_[cut, len(found)]):
            x, zero = self.items[owner[a]], self.first_bin[owner[a]]
            low, high = int(found[a] - zero) << x.band, int(found[b - 1] - zero + 2) << x.band
            yield x, low - len(x.text), high - 1 - len(x.text)


_random = np.random.default_rng(8)
_ON = (_random.integers(0, 256, (WALKS, STEPS, 1024)) < GOES_ON).astype(np.int32)
# One random step of each of SAMPLED equal stretches, so that every key spans its window.
_NOTED = ((np.arange(SAMPLED) + _random.random((WALKS, SAMPLED))) * STEPS / SAMPLED).astype(int)


def windows(c: np.ndarray, stride: int) -> np.ndarray:
    """Where windows of a text begin: at each word, and every ``stride`` characters inside long ones."""
    gap = (c == 32) | (c == 10)
    begins = ~gap
    begins[1:] &= gap[:-1]
    begins = np.flatnonzero(begins)
    if not len(begins):
        return begins
    gaps = np.r_[np.flatnonzero(gap), len(c)]
    size = gaps[np.searchsorted(gaps, begins)] - begins
    more = [np.arange(b + stride, b + n, stride) for b, n in zip(begins[size > UNBROKEN].tolist(), size[size > UNBROKEN].tolist())]
    return np.concatenate([begins, *more])


def walk(c: np.ndarray, starts: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of one walk from each start, and where each walk ends."""
    small = np.concatenate([((c ^ (c >> np.uint32(10))) & np.uint32(1023)).astype(np.int32), np.zeros(STEPS + 1, np.int32)])
    at, key = starts.astype(np.int32), np.zeros(len(starts), dtype=np.uint64)
    noted = set(_NOTED[number].tolist())
    for step in range(STEPS):
        met = small[at]
        if step in noted:
            key = key * np.uint64(0x9E3779B97F4A7C15) + met.astype(np.uint64)
        at += _ON[number, step][met]
    key ^= key >> np.uint64(32)
    return key * np.uint64(0xD1342543DE82EF95), at


class Walks:
    """All items of ``LONG`` characters or more, by the keys of their windows."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.longest = max(len(x.text) for x in items)
        self.step = max(STEP, 2 * self.longest)
        self.whole = self.step + 2 * self.longest
        self.bins = (self.whole + self.longest >> BAND) + 3
        whole = "\n".join(x.text for x in items)
        ends = np.cumsum([len(x.text) + 1 for x in items]) - 1
        c = codes(whole)
        starts = windows(c, 1)
        owner = np.searchsorted(ends, starts, "right")
        offset = starts - (ends - [len(x.text) for x in items])[owner]
        self.tables = []
        for number in range(WALKS):
            key, end = walk(c, starts, number)
            inside = end <= ends[owner]
            order = np.argsort(key[inside], kind="stable")
            key = key[inside][order]
            bits = np.uint64(min(26, max(20, len(key).bit_length() + 6)))
            known = np.zeros(1 << int(bits), dtype=bool)  # most windows share no key: a look at one byte
            known[key >> (np.uint64(64) - bits)] = True
            self.tables.append((key, owner[inside][order], offset[inside][order], known, np.uint64(64) - bits))

    def bands(self, c: np.ndarray) -> Iterator[tuple[Item, int, int]]:
        """(item, least and greatest diagonal) of the stretches of bands with enough votes."""
        starts = windows(c, STRIDE)
        votes = []
        for number, (keys, owner, offset, known, shift) in enumerate(self.tables):
            key, _ = walk(c, starts, number)
            likely = np.flatnonzero(known[key >> shift])
            first = np.searchsorted(keys, key[likely])
            n = np.searchsorted(keys, key[likely], "right") - first
            total = int(n.sum())
            if total:
                at = np.arange(total) + np.repeat(first - (np.cumsum(n) - n), n)
                place = np.repeat(starts[likely], n)
                band = (place - offset[at] + self.longest) >> BAND
                votes.append(((owner[at] * self.bins + band) << 24) | place)
        if not votes:
            return
        band, n = np.unique(np.unique(np.concatenate(votes)) >> 24, return_counts=True)
        beside = np.r_[np.where(band[1:] == band[:-1] + 1, n[1:], 0), 0]
        found = band[n + beside >= VOTES]
        if not len(found):
            return
        cut = np.flatnonzero(np.diff(found) > 2) + 1
        for a, b in zip(np.r_[0, cut], np.r_[cut, len(found)]):
            x, low = divmod(int(found[a]), self.bins)
            high = int(found[b - 1]) - x * self.bins + 2
            yield self.items[x], (low << BAND) - self.longest, (high << BAND) - 1 - self.longest


class Index:
    """The items of a block, in groups."""

    def __init__(self, items: list[tuple]):
        texts = [folded(t) for _, t in items]
        self.items = [Item(n, t) for n, t in enumerate(texts) if t]
        long = [x for x in self.items if len(x.text) >= LONG]
        self.groups, held, size = [Walks(long)] if long else [], [], 0
        for x in sorted((x for x in self.items if len(x.text) < LONG), key=lambda x: (x.q, len(x.text))):
            if held and (x.q != held[0].q or size + len(x.text) > GROUP):
                self.groups.append(Group(held))
                held, size = [], 0
            held.append(x)
            size += len(x.text)
        if held:
            self.groups.append(Group(held))

    def leaks(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, distance, first word of the passage) of each leak, the best place of each item."""
        split = [f" {folded(t)} " for t in texts]
        whole = "\n".join(split)
        ends = np.cumsum([len(t) + 1 for t in split])
        c = codes(whole)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        held = np.zeros(1 << _HASH_BITS, dtype=bool)
        for group in self.groups:
            for at in range(0, len(c), group.step):
                for x, low, high in group.bands(c[at : at + group.whole]):
                    size = len(x.text)
                    low, high = max(0, at + low - x.most), min(len(c), at + high + size + x.most)
                    # The hits may be a few runs of the item over and over.
                    near = run_hashes(c[low:high], x.q)
                    held[near] = True
                    enough = np.count_nonzero(held[x.runs]) >= x.least
                    held[near] = False
                    if not enough:
                        continue
                    for d in range(int(np.searchsorted(ends, low, "right")), len(split)):
                        begin = int(ends[d]) - len(split[d]) - 1
                        if begin >= high:
                            break
                        a, b = max(low - begin, 0), min(high - begin, len(split[d]))
                        if b - a < size - x.most or best.get((d, x.n), (1,))[0] == 0:
                            continue
                        place = best_place(x.text, split[d][a:b], x.most)
                        if place is not None and ((d, x.n) not in best or place[0] < best[d, x.n][0]):
                            # One space stands before the first word.
                            first = max(0, a + place[1] - len(x.text.strip()) - (x.text[-1] == " "))
                            best[d, x.n] = (place[0], max(0, split[d][:first].count(" ") - 1))
        for (d, n), (distance, first) in sorted(best.items()):
            yield d, n, distance, first


def best_place(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """The least edit distance of ``pattern`` to any stretch of ``text`` and the end of the first such
    stretch; None above ``most``. Columns of the distance table are kept as bits of whole numbers."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, least, end = full, 0, m, m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        same = (((eq & up) + up) ^ up) | eq | down
        more = down | ~(same | up) & full
        less = up & same
        if more & top:
            score += 1
        elif less & top:
            score -= 1
            if score < least:
                least, end = score, at
                if not least:
                    break
        more, less = more << 1 & full, less << 1 & full
        up = less | ~((eq | down) | more) & full
        down = more & (eq | down)
    return (least, end) if least <= most else None


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The items in blocks of a bounded size, dealt by a hash of all they hold."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = max(1, -(-rows.count() * 2 // BLOCK_ITEMS))
    for i in range(n):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else rows
        items = sorted(((r.item_id, r.text) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield items


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, first_word): a row for each document and item found in it."""
    importable(docs.sparkSession)
    schema = "doc_id long, item_id long, distance long, first_word long"
    found = None
    for items in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items)
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    ids = part.column(0).to_pylist()
                    rows = [(ids[d], items[n][0], e, p) for d, n, e, p in index.leaks(part.column(1).to_pylist())]
                    columns = zip(*rows) if rows else ([], [], [], [])
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["doc_id", "item_id", "distance", "first_word"])

        part = text_of(docs).mapInArrow(run, schema)
        found = part if found is None else found.unionAll(part)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text leaks no item."""
    importable(docs.sparkSession)
    column = docs.columns.index("text")
    for items in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items)
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    part = b.slice(at, 256)
                    bad = {d for d, *_ in index.leaks([t or "" for t in part.column(column).to_pylist()])}
                    yield part.filter(pa.array([d not in bad for d in range(part.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
