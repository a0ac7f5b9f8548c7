import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from siltbed.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def label(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    """The nodes of rows (conv_id, turn, role, text), as the contract words them."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn, label(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2]))] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 4
        whole[c] = tuple(own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        cost = (len(m) - 1) * len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += cost
    ends = defaultdict(list)
    for c, turns in whole.items():
        ends[turns].append(c)
    return sorted(
        (min(m), len(x), min(members[x[:-1]]) if x else None, len(m), children[x], leaves[x], saved[x], hashlib.sha256(",".join(map(str, sorted(ends[x]))).encode()).hexdigest())
        for x, m in members.items()
    )


def ours(df):
    return sorted(tuple(r) for r in trie.nodes(trie.rebuilt(trie.paths(df))).select(trie.NODES).collect())


def corpus(seed=3, n=240):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(-20, n):
        if c % 20 == 0 and c % 3 == 0:
            continue  # a family without its first conversation
        k = int(rng.integers(1, 7))
        shared = c % 3 == 0  # a third begins alike, and many of these are the same throughout
        for t in range(k):
            text = "a common first turn" if shared and t < 2 else f"answer {rng.integers(0, 3)}  and more"
            rows.append((c, None if t == 0 and c % 7 == 0 else t, "user" if t % 2 == 0 else None, text if rng.random() > 0.1 else None))
    rows += [(40, 3, "user", "tied"), (40, 3, "user", "tied too"), (None, 1, "user", "nobody"), (60, 2, None, None)]
    return rows


@pytest.mark.parametrize("parts, piece, most", [("8", 1 << 16, 256), ("40", 2, 256), ("40", 3, 1)])
def test_equals_brute_force(spark, monkeypatch, parts, piece, most):
    """Also with many splitters, small pieces of ids, and splitters that are cut short."""
    monkeypatch.setattr(trie, "PIECE", piece)
    monkeypatch.setattr(trie, "MOST_TURNS", most)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = corpus()
        assert ours(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_path_held_by_most_conversations_spreads_over_shards(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3)] + [(c, 0, "user", f"own {c}") for c in range(400, 450)]
    df = spark.createDataFrame(rows, SCHEMA)
    skel = trie.skeleton(trie.paths(df))
    shards = defaultdict(int)
    for r in trie.paths(df).collect():
        shards[skel.shard(bytes(r.path), r.conv_id)] += 1
    assert max(shards.values()) < 150
    assert ours(df) == brute(rows)


def test_odd_turns_and_other_columns(spark):
    long = "word " * 50_000
    rows = [(1, None, None, None), (1, None, None, None), (1, 2, "", ""), (2, 1, "user", long), (3, 1, "user", long), (None, None, None, None), (21, 0, "user", " \t ")]
    df = spark.createDataFrame([(*r, "x", None, 7) for r in rows], SCHEMA + ", path string, words string, shard int")
    assert ours(df) == brute(rows)


def test_turnless_conversations_belong_to_the_root(spark):
    few = [c for c in range(1, 400) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20][:5]  # lose all they have, and their family has no head
    rows = [(c, 0, "user", "only") for c in few]
    got = ours(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and len(got) == 1 and got[0][3] == 5


def test_a_long_conversation(spark):
    rows = [(c, t, "user", f"t{t}") for c in (0, 1) for t in range(1500 + c)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_table(spark):
    assert ours(spark.createDataFrame([], SCHEMA)) == []


def test_shared_turns():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = rng.integers(0, 2, rng.integers(0, 9)).tolist()
        y = rng.integers(0, 2, rng.integers(0, 9)).tolist()
        path = lambda v: b"".join(bytes([b]) * trie.LABEL for b in v)
        alike = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        assert trie.shared_turns(path(x), path(y)) == alike
