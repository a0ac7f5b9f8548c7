import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltbed.llm import substrings

WORDS = [f"w{i}" for i in range(400)]
SCHEMA = "doc_id long, text string"


def brute(rows):
    """(doc_id, n_words, n_removed, kept) of rows (doc_id, text), sorted."""
    order = [substrings._LAST if d is None else d for d, _ in rows]
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for o, w in zip(order, words):
        for i in range(len(w) - 49):
            x = tuple(w[i : i + 50])
            first[x] = min(first.get(x, o), o)
    out = []
    for (d, _), o, w in zip(rows, order, words):
        gone = {j for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < o for j in range(i, i + 50)}
        out.append((d, len(w), len(gone), " ".join(x.decode() for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def ours(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in substrings.without_repeats(df).collect()), key=str)


def corpus(seed=5, n=120):
    """Texts that share a passage in contexts of their own, copies, near copies, and runs of one word."""
    rng = np.random.default_rng(seed)
    some = lambda k: [str(w) for w in rng.choice(WORDS, k)]
    passage, whole = some(60), some(200)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            words = some(rng.integers(0, 90)) + passage + some(rng.integers(0, 90))
        elif kind == 1:
            words = list(whole)
        elif kind == 2:
            words = list(whole)
            words[int(rng.integers(200))] = "changed"
        elif kind == 3:
            words = ["same"] * int(rng.integers(0, 300))
        elif kind == 4:
            at = int(rng.integers(0, 150))
            words = some(30) + whole[at : at + int(rng.integers(45, 60))] + some(3)
        else:
            words = some(rng.integers(0, 120))
        rows.append((int(rng.integers(0, n)) if i % 10 else None, " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [substrings.BLOCK, 4])
def test_equals_brute_force_with_whole_and_torn_buckets(spark, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK", block)
    rows = corpus()
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_odd_rows_and_other_columns(spark, odd, odd_rows):
    assert ours(odd) == brute([r[:2] for r in odd_rows])


def test_repeated_rows_do_not_multiply(spark):
    text = " ".join(WORDS[:80])
    rows = [(3, text)] * 400 + [(2, text), (None, text), (None, text)]
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(8)) == brute(rows)


def test_empty_table(spark, empty):
    assert substrings.without_repeats(empty).collect() == []


def test_whole_table_against_brute_force(spark, sf, small):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.op12_substrings(spark, sf).collect()}
    expected = {d: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute([*zip(small.doc_id.tolist(), small.text.tolist())])}
    assert got == expected


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b"]), min_size=50, max_size=120), min_size=1, max_size=6))
def test_cuts_hold_every_window_once_and_equal_windows_meet(texts):
    own, at, n, key, _ = substrings.cut(texts)
    places, keys = [], {}
    for o, a, k, m in zip(own.tolist(), at.tolist(), n.tolist(), key.tolist()):
        for i in range(a, a + k):
            places.append((o, i))
            assert keys.setdefault(tuple(texts[o][i : i + 50]), m) == m
    assert sorted(places) == [(o, i) for o, t in enumerate(texts) for i in range(len(t) - 49)]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=50, max_size=113), min_size=1, max_size=6))
def test_ranks_are_equal_for_equal_windows_only(strings):
    own, offset, rank = substrings.ranked(strings)
    window = [tuple(strings[o][i : i + 50]) for o, i in zip(own.tolist(), offset.tolist())]
    assert len({*zip(window, rank.tolist())}) == len({*window}) == len({*rank.tolist()})
