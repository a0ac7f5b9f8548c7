"""The prefix trie of conversations, by a broadcast skeleton of splitter paths and sorted shards.

``paths`` gives every conversation one row: its path, 16 bytes of SHA-256 for each turn (role and text), and
the words of each turn. Texts do not travel. A node of the trie is a prefix of paths.

Paths are range-partitioned: a sample gives splitters, rows of (path, conv_id) that part the sorted table
into shards of about equal size; equal paths are parted by conv_id, so that a group of copies spreads over
shards. All prefixes of splitter paths make the skeleton, a trie with at most ``MOST_TURNS`` nodes a
splitter, which every task gets. A node that is no prefix of a splitter has all of its members in one shard:
the shard, read once in order with one open path on a stack, finishes it. For skeleton nodes each shard
gives a partial aggregate; these are added up, and sums over subtrees run once over the skeleton. Ids that
end at a skeleton node come as packed pieces in order, from which one task per node streams the hash.

Defined cases: a null role or text is empty; turns come in order of turn, null first, turns of one number
by their SHA-256; a row without conv_id belongs to no conversation and is left out; a conversation of no
turns is a member of the root only; ``c % 20`` of a negative id is negative or 0, as in SQL; no conversation
gives no rows; other columns are ignored. A conversation's path (20 bytes a turn) has to fit in one row.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import importable, stored

LABEL = 16
#: Sampled rows for each shard, and turns of a splitter at most; a longer splitter parts paths only.
SAMPLED, MOST_TURNS = 20, 256
#: Ids of one packed piece.
PIECE = 1 << 16
#: Rebuilding: a conversation begins with the first turns of the one this multiple before it.
FAMILY, HEADS = 20, 4

_NOTHING = hashlib.sha256(b"").hexdigest()


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, words): one row per conversation of ``turns`` (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    label = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turn = F.struct(F.col("turn"), F.substring(label, 1, 2 * LABEL).alias("label"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    whole = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    whole = whole.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["label"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


def rebuilt(whole: DataFrame) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % 20 in place of its own first h,
    where h is crc32 of its decimal id modulo 4."""
    most = HEADS - 1
    heads = whole.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("head_id"), F.substring("path", 1, LABEL * most).alias("head"), F.slice("words", 1, most).alias("head_words")
    )
    own = whole.withColumns({"head_id": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")})
    return own.join(heads, "head_id", "left").select(
        "conv_id",
        F.expr(f"concat(coalesce(substring(head, 1, {LABEL} * h), X''), substring(path, {LABEL} * h + 1))").alias("path"),
        F.expr("concat(coalesce(slice(head_words, 1, h), array()), slice(words, h + 1, size(words)))").alias("words"),
    )


# -- skeleton ----------------------------------------------------------------------------------------


class Skeleton:
    """The trie of all prefixes of the splitter paths; node 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = sorted(splitters)
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path, _ in self.splitters:
            node = 0
            for at in range(0, len(path), LABEL):
                key = (node, path[at : at + LABEL])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node = self.child[key]

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def nodes(self, path: bytes) -> list[int]:
        """The skeleton nodes along a path, root first."""
        found = [0]
        for at in range(0, len(path), LABEL):
            node = self.child.get((found[-1], path[at : at + LABEL]))
            if node is None:
                break
            found.append(node)
        return found


def skeleton(whole: DataFrame) -> Skeleton:
    """Splitters from a sample of ``SAMPLED`` rows for each shuffle partition."""
    parts = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, SAMPLED * parts / max(whole.count(), 1))
    cut = F.expr(f"substring(path, 1, {LABEL * MOST_TURNS})")
    # A shortened path parts before all of its extensions, whatever their ids.
    conv_id = F.when(F.length("path") <= LABEL * MOST_TURNS, F.col("conv_id")).otherwise(F.lit(-(1 << 63)))
    rows = whole.sample(share, seed=7).select(cut.alias("path"), conv_id.alias("conv_id")).collect()
    sample = sorted((bytes(r.path), r.conv_id) for r in rows)
    step = max(1, -(-len(sample) // parts))
    return Skeleton(sorted({*sample[step::step]}))


# -- shards ------------------------------------------------------------------------------------------

_SHARD = (
    "skel int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, words long, shard int, piece int, ids binary"
)
_NAMES = [c.split()[0] for c in _SHARD.split(", ")]
_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_FIELDS = [_TYPES[c.split()[1]] for c in _SHARD.split(", ")]


def shared_turns(x: bytes, y: bytes) -> int:
    """How many turns two paths begin with alike."""
    low, high = 0, min(len(x), len(y)) // LABEL
    while low < high:
        mid = (low + high + 1) // 2
        at, end = low * LABEL, mid * LABEL
        low, high = (mid, high) if x[at:end] == y[at:end] else (low, mid - 1)
    return low


class _Open:
    """A node on the open path, with what is known of it so far."""

    __slots__ = ("skel", "words", "n", "least", "children", "leaves", "saved", "ends", "kids")

    def __init__(self, skel: int, words: int):
        self.skel, self.words = skel, words
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends = None if skel < 0 else []  # a running hash, or the ids of a piece
        self.kids: list[list] = []  # finished children that wait for this node's least member


def grow(rows: Iterator[tuple[bytes, int, list[int]]], skel: Skeleton, shard: int) -> Iterator[list]:
    """Rows of ``_SHARD`` from a shard's (path, conv_id, words) in order: finished local nodes (``skel`` is
    the skeleton parent, if that is one), partial aggregates of skeleton nodes (``depth`` null) and pieces of
    the ids that end there (``ids`` set)."""
    stack: list[_Open] = []
    before, pieces = b"", 0

    def piece(e: _Open) -> list:
        nonlocal pieces
        ids, e.ends, pieces = np.array(e.ends, "<i8").tobytes(), [], pieces + 1
        return [e.skel, *[None] * 9, shard, pieces, ids]

    def close(turns: int) -> Iterator[list]:
        while len(stack) > turns + 1:
            e, depth = stack.pop(), len(stack)
            up = stack[-1] if stack else None
            if up:
                up.n += e.n
                up.least = e.least if up.least is None else min(up.least, e.least)
            if e.skel >= 0:
                if e.ends:
                    yield piece(e)
                yield [e.skel, e.least, None, None, e.n, e.children, e.leaves, e.saved, None, e.words, None, None, None]
                continue
            leaves, saved = e.leaves or 1, e.saved + (e.n - 1) * e.words
            for kid in e.kids:
                kid[3] = e.least
                yield kid
            own = [None, e.least, depth, None, e.n, e.children, leaves, saved, e.ends.hexdigest() if e.ends else _NOTHING, None, None, None, None]
            up.children, up.leaves, up.saved = up.children + 1, up.leaves + leaves, up.saved + saved
            if up.skel >= 0:
                own[0] = up.skel
                yield own
            else:
                up.kids.append(own)

    for path, conv_id, words in rows:
        if not stack:
            stack.append(_Open(0, 0))
        alike = shared_turns(before, path)
        yield from close(alike)
        known = skel.nodes(path) if len(path) // LABEL > alike else []
        for depth in range(alike + 1, len(path) // LABEL + 1):
            stack.append(_Open(known[depth] if depth < len(known) else -1, words[depth - 1]))
        end = stack[-1]
        end.n += 1
        end.least = conv_id if end.least is None else min(end.least, conv_id)
        if end.skel >= 0:
            end.ends.append(conv_id)
            if len(end.ends) >= PIECE:
                yield piece(end)
        elif end.ends is None:
            end.ends = hashlib.sha256(str(conv_id).encode())
        else:
            end.ends.update(b",%d" % conv_id)
        before = path
    yield from close(-1)


def _grown(skel: Skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for at in range(0, b.num_rows, 1024) for row in zip(*(c.to_pylist() for c in b.slice(at, 1024).columns)))
        out: list[list] = []
        for row in grow(((p, c, w) for _, p, c, w in rows), skel, TaskContext.get().partitionId()):
            out.append(row)
            if len(out) >= 4096 or row[-1] is not None:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _FIELDS)], names=_NAMES)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _FIELDS)], names=_NAMES)

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each skeleton node's ids from its pieces, which come in order."""
    node, digest = None, None
    for b in batches:
        done = []
        for skel, ids in zip(b.column(0).to_pylist(), (x.as_py() for x in b.column(3))):
            numbers = np.frombuffer(ids, "<i8").tolist()
            if skel != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = skel, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(map(str, numbers)).encode())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int32()), pa.array([x for _, x in done], pa.string())], names=["skel", "sha"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([digest.hexdigest()])], names=["skel", "sha"])


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _combined(grown: DataFrame, skel: Skeleton) -> DataFrame:
    """(skel, and the columns of a node): the skeleton's nodes from the partial aggregates of all shards.
    As many rows as the skeleton has nodes."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    partial = grown.where("depth is null and ids is null").groupBy("skel").agg(F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), *sums)
    nodes = {r.skel: r.asDict() for r in partial.collect()}
    pieces = grown.where("ids is not null").select("skel", "shard", "piece", "ids").repartition("skel").sortWithinPartitions("skel", "shard", "piece")
    ends = {r.skel: r.sha for r in pieces.mapInArrow(_ends, "skel int, sha string").collect()}
    for i in sorted(nodes, key=lambda i: -skel.depth[i]):  # children before their parents
        n = nodes[i]
        n["n_leaves"] = n["n_leaves"] if n["n_children"] else 1
        n["saved_tokens"] += (n["n_convs"] - 1) * n["words"]
        if i:
            up = nodes[skel.parent[i]]
            up["n_children"] += 1
            up["n_leaves"] += n["n_leaves"]
            up["saved_tokens"] += n["saved_tokens"]
    rows = [
        (i, n["conv_id"], skel.depth[i], nodes[skel.parent[i]]["conv_id"] if i else None, n["n_convs"], n["n_children"], n["n_leaves"], n["saved_tokens"], ends.get(i, _NOTHING))
        for i, n in nodes.items()
    ]
    kinds = "skel int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    return grown.sparkSession.createDataFrame(rows, kinds)


def nodes(whole: DataFrame) -> DataFrame:
    """One row per node of the trie of ``whole`` (conv_id, path, words); see ``NODES``."""
    importable(whole.sparkSession)
    whole = stored(whole, "paths")
    skel = skeleton(whole)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            to = [skel.shard(p.as_py(), c.as_py()) for p, c in zip(b.column(0), b.column(1))]
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *b.columns], names=["shard", "path", "conv_id", "words"])

    dealt = whole.select("path", "conv_id", "words").mapInArrow(deal, "shard int, path binary, conv_id long, words array<int>")
    sorted_ = dealt.repartitionById(len(skel.splitters) + 1, F.col("shard")).sortWithinPartitions("path", "conv_id")
    grown = stored(sorted_.mapInArrow(_grown(skel), _SHARD), "nodes")
    top = _combined(grown, skel)
    parents = top.select("skel", F.col("conv_id").alias("above"))
    local = grown.where("depth is not null").join(F.broadcast(parents), "skel", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return top.select(NODES).unionAll(local.select(NODES))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(rebuilt(paths(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


OP11_SQL = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS head_id,
           xor(4294967295, list_reduce(
               list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, c: list_reduce(list_concat([xor(crc, c)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                          lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), pieces AS (
    SELECT c.conv_id, 0 AS part, t.k, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.head_id AND t.k <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.k, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.h
), labelled AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS d,
           md5(length(role) || ':' || role || text) AS label, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM pieces
), whole AS (
    SELECT conv_id, coalesce(string_agg(label, '' ORDER BY d), '') AS path FROM convs LEFT JOIN labelled USING (conv_id) GROUP BY conv_id
), prefixes AS (
    SELECT conv_id, path, unnest(range(0, length(path) // 32 + 1)) AS depth FROM whole
), nodes AS (
    SELECT left(path, 32 * depth) AS node, any_value(p.depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(max(l.words), 0) AS words, string_agg(CASE WHEN length(path) = 32 * p.depth THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id) AS ends
    FROM prefixes p LEFT JOIN labelled l ON l.conv_id = p.conv_id AND l.d = p.depth
    GROUP BY left(path, 32 * depth)
), below AS (
    SELECT left(node, 32 * unnest(range(0, depth + 1))) AS top, node, depth, n_convs, words FROM nodes
), children AS (
    SELECT left(node, 32 * (depth - 1)) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), sums AS (
    SELECT top, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
    FROM below LEFT JOIN children c USING (node) GROUP BY top
)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs,
       coalesce(c.n, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(v.ends, '')) AS ends_sha256
FROM nodes v JOIN sums s ON s.top = v.node
LEFT JOIN children c ON c.node = v.node
LEFT JOIN nodes u ON v.depth > 0 AND u.node = left(v.node, 32 * (v.depth - 1))
"""
