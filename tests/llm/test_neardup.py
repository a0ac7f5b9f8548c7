"""Near-duplicates against all pairs."""

import random

import numpy as np
import pytest
from siltbed.llm import neardup
from siltbed.llm.components import components
from siltbed.llm.queries import QUERIES


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """[(n_shingles, component_id)] in the order of ``rows`` of (doc_id, text)."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            t = sets[j]
            if s and t and 100 * min(len(s), len(t)) >= 75 * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= 75 * (len(s) + len(t) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(len(s), least.get(find(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def compare(got, rows):
    want = sorted((d, *x, d == x[1]) for (d, _), x in zip(rows, brute(rows)) if d is not None)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None) == want


def test_op5(spark, sf, small):
    compare(QUERIES["op5_near_duplicates"](spark, sf).collect(), list(zip(map(int, small.doc_id), small.text)))


def test_odd_rows(spark, odd, odd_rows):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    compare(got, [(d, t) for d, t, *_ in odd_rows])


def test_nothing(empty):
    assert neardup.near_duplicates(empty).count() == 0


def test_chains_and_groups(spark):
    """Chains whose ends are unlike, groups of near copies, passages that many share, short texts."""
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []

    def add(w):
        rows.append((len(rows) * 7 % 10007, " ".join(w)))

    passage = r.choices(vocabulary, k=60)
    for _ in range(60):
        add(r.choices(vocabulary, k=r.randrange(60, 150)) + passage)
    for size in (8, 60, 200):
        w = r.choices(vocabulary, k=size)
        for _ in range(25):  # a chain: each a small step from the one before
            at = r.randrange(len(w))
            w = w[:at] + [r.choice(vocabulary)] + w[at + 1 :]
            add(w)
        for _ in range(25):  # a group around one text
            w2 = list(w)
            for _ in range(r.randrange(1 + size // 40)):
                w2[r.randrange(size)] = r.choice(vocabulary)
            add(w2)
    for k in (1, 2, 3, 4, 5, 6, 7):
        for _ in range(4):
            add(r.choices(vocabulary[:3], k=k))
    r.shuffle(rows)
    compare(neardup.near_duplicates(table(spark, rows)).collect(), rows)


@pytest.mark.parametrize("n", [1, 3, 40, 400, 5000])
def test_sketches_agree_like_the_sets(n):
    r = np.random.default_rng(n)
    pool = r.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
    for share in (0.2, 0.5, 0.9):
        k = round(n * share)
        sets = [np.unique(pool[:n]), np.unique(pool[n - k : 2 * n - k])]
        s = neardup.sketches(sets)
        assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        assert abs((s[0] == s[1]).mean() - true) < 0.2


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1002), (1002, 1001), (5000, 5000)], "u long, v long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 1001: 1000, 1002: 1000}
    assert components(links.limit(0)).count() == 0


def test_copies_without_ids_do_not_multiply(spark, monkeypatch):
    """2,000 near copies with null ids and one row 500 times: one text for each different set."""
    sizes, write = {}, neardup.stored

    def counted(df, label, *more):
        out = write(df, label, *more)
        sizes[label] = sizes.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    words = [f"word{i}" for i in range(60)]
    rows = [(None, " ".join([*words, f"x{i}"])) for i in range(2000)] + [(None, " ".join(words))] * 500
    got = neardup.near_duplicates(table(spark, rows).repartition(8)).collect()
    assert len(got) == 2500 and len({r.component for r in got}) == 1
    assert sizes["texts"] == 2001


def test_shared_counts_elements():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 500, k, dtype=np.uint64)) for k in (1, 3, 40, 400, 9)]
    for x in sets:
        assert neardup.shared(x, sets).tolist() == [len(np.intersect1d(x, y)) for y in sets]


def test_unlinked_pairs_are_no_rows(spark, monkeypatch):
    """300 texts that share 70 % of their shingles pairwise: too little for a link, too much for a sketch to
    tell. No table holds a row for each pair, and the few real links among them are found."""
    sizes, write = {}, neardup.stored

    def counted(df, label, *more):
        out = write(df, label, *more)
        sizes[label] = max(sizes.get(label, 0), out.count())
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    compared, confirm = spark.sparkContext.accumulator(0), neardup._links

    def links(pairs, texts):
        compared.add(pairs.count())
        return confirm(pairs, texts)

    monkeypatch.setattr(neardup, "_links", links)
    monkeypatch.setattr(neardup, "BLOCK", 64)
    common = [f"word{i}" for i in range(104)]
    rows = [(i, " ".join([*common, *(f"x{i}y{j}" for j in range(19 + i % 3))])) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(0, 300, 50)]
    compare(neardup.near_duplicates(table(spark, rows)).collect(), rows)
    assert compared.value < 20 * len(rows) and max(sizes.values()) < 80 * len(rows)
