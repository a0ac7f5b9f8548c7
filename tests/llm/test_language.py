"""Fingerprints and language-model scores."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from siltbed.llm import fingerprints, lm
from siltbed.llm.queries import QUERIES


def weights(text):
    return Counter((text or "").encode().lower().split())


def jaccard(x, y):
    a, b = weights(x), weights(y)
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 1.0


def codes(fingerprint):
    return np.frombuffer(bytes.fromhex(fingerprint), ">u2")


def check_fingerprints(rows, docs):
    """``docs``: (doc_id, text) in the order of the contract."""
    assert len(rows) == len(docs)
    by_key = {}
    for r in rows:
        by_key.setdefault((r.doc_id, r.n_chars, r.edited_sha256), []).append(r)
    own = {}
    errors = []
    for (d, t), (_, n) in zip(docs, docs[1:] + docs[:1]):
        t, n = t or "", n or ""
        edited = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        r = by_key[d, len(t), hashlib.sha256(edited.encode()).hexdigest()][0]
        assert own.setdefault(t, r.fingerprint) == r.fingerprint
        errors += [r.near_edited - jaccard(t, edited), r.near_next - jaccard(t, n)]
        if r.fingerprint and r.edited_fingerprint:
            assert r.near_edited == (codes(r.fingerprint) == codes(r.edited_fingerprint)).mean()
    assert np.abs(errors).max() < 0.25 and np.sqrt(np.mean(np.square(errors))) < 0.05
    return np.mean(errors)


def test_op3(spark, sf, small):
    docs = sorted(zip(map(int, small.doc_id), small.text), reverse=True)
    assert abs(check_fingerprints(QUERIES["op3_fingerprints"](spark, sf).collect(), docs)) < 0.01


def test_fingerprints_of_odd_rows(spark, odd, odd_rows, empty):
    rows = fingerprints.beside_next(odd).mapInArrow(fingerprints._edited, fingerprints.EDITED).collect()
    order = odd.select("doc_id", "text").withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    docs = [(r.doc_id, r.text) for r in order.orderBy(F.col("doc_id").desc_nulls_last(), "h").collect()]
    check_fingerprints(rows, docs)
    plain = {(r.doc_id, r.fingerprint) for r in fingerprints.fingerprints(odd).collect()}
    assert plain == {(r.doc_id, r.fingerprint) for r in rows}
    assert fingerprints.beside_next(empty).mapInArrow(fingerprints._edited, fingerprints.EDITED).count() == 0


@pytest.mark.parametrize("n", [1, 2])
def test_few_documents_follow_each_other(spark, n):
    docs = [(i, f"text {i} of few " * 9) for i in range(n, 0, -1)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check_fingerprints(fingerprints.beside_next(df).mapInArrow(fingerprints._edited, fingerprints.EDITED).collect(), docs)


def test_draws_are_consistent():
    """A greater weight keeps a word's sample or moves it on, and weights count in the likeness."""
    s = fingerprints.Sampler()
    base = [f"w{i}" for i in range(60)]
    x, y = " ".join(base * 3), " ".join(base * 3 + base[:30] * 3)
    a, b = s.codes([x, y])
    assert abs((a == b).mean() - jaccard(x, y)) < 0.12
    kept = fingerprints.KEPT
    try:
        fingerprints.KEPT = 10
        c, d = fingerprints.Sampler().codes([x, y])
    finally:
        fingerprints.KEPT = kept
    assert (a == c).all() and (b == d).all()


def test_words_met_lately_are_drawn_once(monkeypatch):
    """Words beyond the first KEPT stay for a while; what is drawn anew or kept gives the same samples."""
    monkeypatch.setattr(fingerprints, "KEPT", 40)
    drawn, draws = [], fingerprints.draws
    monkeypatch.setattr(fingerprints, "draws", lambda words, n: drawn.extend(words) or draws(words, n))
    s = fingerprints.Sampler()
    first, later = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(20)) + " b1 b1 c"
    s.codes([first])
    x, y = s.codes([later])[0], s.codes([later])[0]
    assert len(drawn) == 50 + 21 and (x == y).all()
    for k in range(9):
        s.codes([" ".join(f"d{k}x{i}" for i in range(30))])
        assert len(s.at) <= 2 * 40
    assert (s.codes([later])[0] == x).all() and (fingerprints.Sampler().codes([later])[0] == x).all()


def test_draws_follow_the_definition():
    """Whatever is worked out once for many samples, each is that of its word, weight and seed."""
    words, weights = [b"w%d" % i for i in range(300)], np.arange(300) % 7 + 1
    got = fingerprints.draws(words, weights)
    low = np.uint64(0xFFFFFF)
    for i in (0, 1, 8, 255, 299):
        h = np.uint64(fingerprints.xxhash.xxh3_64_intdigest(words[i]))
        m = [fingerprints.mix(h + s) for s in fingerprints._SEEDS]
        u = lambda bits: ((bits & low).astype(np.float64) + 0.5) / 2**24
        r, b = -np.log(u(m[0]) * u(m[0] >> np.uint64(32))), u(m[2])
        t = np.floor(np.log(weights[i]) / r + b)
        ln_a = np.log(-np.log(u(m[1]) * u(m[1] >> np.uint64(32)))) - r * (t - b) - r
        high = (got[i] >> np.uint64(32)).astype(np.uint32)
        bits = np.where(high >> np.uint32(31), high ^ np.uint32(1 << 31), ~high)
        assert np.allclose(bits.view(np.float32), ln_a, rtol=1e-3, atol=1e-3)
        code = fingerprints.mix(h ^ (t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(32)
        assert ((got[i] & np.uint64(0xFFFFFFFF)) == code).mean() > 0.99


# -- language model ----------------------------------------------------------------------------------


def base_of(docs):
    """(n_tokens, n_known, N, base) of each document, by the contract's formula."""
    train = Counter()
    for d, t in docs:
        if zlib.crc32(("" if d is None else str(d)).encode()) % 10:
            train.update([*weights(t).elements(), None])
    n, v = sum(train.values()), len(train)
    out = []
    for d, t in docs:
        tokens = [*weights(t).elements(), None]
        out.append((d, len(tokens), sum(train[w] > 0 for w in tokens), n, sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)))
    return out


def check_base(rows, docs):
    got = sorted(((r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows))
    assert got == sorted((d or 0, a, b, c, round(e, 4)) for d, a, b, c, e in base_of(docs))


def test_op1(spark, sf, small):
    rows = QUERIES["op1_lm_scores"](spark, sf).collect()
    check_base(rows, list(zip(map(int, small.doc_id), small.text)))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in rows)


def test_rare_words_are_joined(spark, sf, small, monkeypatch):
    """The same scores whether words are sent to the tasks or joined."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = F.pmod("doc_id", F.lit(7)) == 0
    whole = {r.doc_id: r for r in lm.score(docs, out).collect()}
    monkeypatch.setattr(lm, "FREQUENT", lm.OWN + 40)
    for r in lm.score(docs, out).collect():
        w = whole[r.doc_id]
        assert (r.n_known, r.n_tokens) == (w.n_known, w.n_tokens)
        assert math.isclose(r.base_score, w.base_score, rel_tol=1e-9) and math.isclose(r.score, w.score, rel_tol=1e-6)


def test_lm_of_odd_rows(odd, odd_rows, empty):
    from siltbed.llm.common import crc_mod

    rows = lm.score(odd, crc_mod(F.col("doc_id"), 10) == 0).collect()
    check_base(rows, [(d, t) for d, t, *_ in odd_rows])
    assert lm.score(empty, F.lit(False)).count() == 0
    nothing = lm.score(odd, F.lit(True)).collect()  # no training documents
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in nothing)


def test_probabilities_add_up(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    counts = lm.word_counts(docs.select("text"))
    v = lm.vocabulary(counts)
    p = lm.train(docs.limit(50), v)
    table = lm.log_table(p)
    assert np.allclose((10.0 ** table.astype(np.float64)).sum(axis=1), 1, atol=1e-4)
    # Within a shared class: its words and its unseen ones.
    k = lm.OWN + 5
    inside = [r.c for r in counts.collect() if r.word and v.at.get(bytes(r.word), lm.OWN) >= lm.OWN and lm.shared_class(bytes(r.word)) == k]
    assert sum(inside) == v.total[k]
    assert math.isclose(sum(10 ** (math.log10(c) + v.known_share[k]) for c in inside) + v.unseen[k], 1, rel_tol=1e-9)
    # The network knows more than the classes' shares.
    held = [v.classes(lm.words_of(r.text))[1] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    rows = lm.contexts(held)
    network = table[rows[:, 0] * lm.CLASSES + rows[:, 1], rows[:, 2]].mean()
    assert network > np.log10(lm.noise_of(v))[rows[:, 2]].mean()


def test_every_context_is_learned(spark, sf, monkeypatch):
    """Whatever the buffer, each context of a task's texts goes through the network once."""
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    v = lm.vocabulary(lm.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")))
    every = lm.contexts([v.classes(lm.words_of(t))[1] for t in texts])
    q = lm.noise_of(v)
    learned = []
    monkeypatch.setattr(lm, "BUFFER", 700)
    monkeypatch.setattr(lm, "fit", lambda p, rows, *_: learned.append(rows))
    _, weight = lm.train_on([pa.array(texts[:40]), pa.array(texts[40:])], v, lm.initial(q), q)
    assert weight == len(every) and max(map(len, learned)) <= 700
    assert (np.concatenate(learned) == every).all()


def test_own_classes_grow_with_the_vocabulary():
    words = [(b"w%d" % i, 5000 - i) for i in range(3000)]
    assert lm.own_words(20_000) == lm.OWN and lm.own_words(10**6) == 1000
    v = lm.Vocabulary([(b"", 10), *words], 10**7, 10**6, {})
    _, kind = v.classes([w for w, _ in words[:1000]])
    assert len(set(kind)) == 1001 and v.classes_in_all == lm.CLASSES + 1000 - lm.OWN
    q = lm.noise_of(v)
    p = lm.initial(q)
    lm.fit(p, np.random.default_rng(1).integers(0, len(q), (5000, 3)), q, 0.01, 1, 1)
    every = np.arange(len(q))
    for far, near in ((0, 0), (900, lm.END), (lm.OWN + 3, 1000)):
        logs = lm.Scorer(p).logs(np.full_like(every, far), np.full_like(every, near), every)
        assert abs((10**logs).sum() - 1) < 1e-4


def test_sums_of_rows_met_any_number_of_times():
    r = np.random.default_rng(5)
    for n, classes in ((1, 3), (64, 40_000), (500, 400), (2048, 60)):
        at, values = r.integers(0, classes, n), r.normal(size=(n, 4)).astype(np.float32)
        wanted = np.zeros((classes, 4))
        np.add.at(wanted, at, values)
        assert np.allclose(lm._sums(at, values, classes), wanted, atol=1e-4)


def test_new_pairs_need_little_memory():
    """Divisors are worked out a few pairs at a time, and steps of the optimiser keep their own arrays."""
    import tracemalloc

    from siltbed.llm.learning import Adam

    scorer = lm.Scorer(lm.initial(np.full(2000, 1 / 2000)))
    pair = np.random.default_rng(1).permutation(2000**2)[:4000]
    tracemalloc.start()
    try:
        logs = scorer.logs(pair // 2000, pair % 2000, pair % 2000)
        assert tracemalloc.get_traced_memory()[1] < 4e6
    finally:
        tracemalloc.stop()
    assert np.isfinite(logs).all() and (logs < 0).all()
    adam, p = Adam(0.01), {"w": np.ones((9, 3), np.float32), "b": np.ones((), np.float64)}
    adam.step(p, {k: x * 2 for k, x in p.items()})
    kept = adam.m["w"]
    adam.step(p, {k: x * 2 for k, x in p.items()})
    assert adam.m["w"] is kept and np.allclose(p["w"], 0.98, atol=1e-4) and np.allclose(p["b"], 0.98, atol=1e-4)
