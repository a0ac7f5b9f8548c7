"""Toxicity, quality, personal data, secrets and decontamination."""

import hashlib
import json
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from siltbed.llm import decontaminate, learning, pii, quality, secrets, toxicity
from siltbed.llm.queries import QUERIES

SF2 = "/root/testdata/sf0.01"


# -- scores ------------------------------------------------------------------------------------------


def with_labels(spark, rows, column, mod, rest):
    labels = spark.read.parquet(f"{SF2}/labels.parquet").toPandas().set_index("doc_id")[column]
    got = pd.DataFrame([r.asDict() for r in rows]).set_index("doc_id").join(labels)
    assert (got.held_out == [zlib.crc32(str(i).encode()) % mod == rest for i in got.index]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    return got[got.held_out & got[column].notna()]


def auc(y, s):
    rank = pd.Series(s).rank().to_numpy()
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_op6_on_held_out_labels(spark):
    held = with_labels(spark, QUERIES["op6_toxicity"](spark, SF2).collect(), "toxic", 3, 1)
    # Some labels are noise: a few toxic ones stand on documents without a toxic word.
    assert auc(held.toxic.to_numpy(), held.score.to_numpy()) > 0.8
    assert (held.predicted == held.toxic).mean() > 0.92


def test_op9_on_held_out_labels(spark):
    held = with_labels(spark, QUERIES["op9_quality"](spark, SF2).collect(), "quality", 4, 2)
    assert auc(held.quality.to_numpy(), held.score.to_numpy()) > 0.8
    assert (held.predicted == held.quality).mean() > 0.88


def test_marginals_against_all_paths():
    r = np.random.default_rng(3)
    e, step = r.normal(0, 2, (3, 6)), r.normal(0, 1, (2, 2))
    sizes = np.array([6, 4, 1])
    p = toxicity.marginals(e, step, sizes)
    p2, steps = toxicity._pairs(e, step, sizes)
    expected = np.zeros((2, 2))
    for d, n in enumerate(sizes):
        total, hot, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in range(1 << n):
            z = [path >> i & 1 for i in range(n)]
            w = np.exp(sum(e[d, i] for i in range(n) if z[i]) + sum(step[a, b] for a, b in zip(z, z[1:])))
            total += w
            hot += w * np.array(z)
            for a, b in zip(z, z[1:]):
                pairs[a, b] += w
        assert np.allclose(p[d, :n], hot / total) and np.allclose(p2[d, :n], hot / total)
        expected += pairs / total
    assert np.allclose(steps, expected)


def toxic_corpus():
    r = random.Random(6)
    words = [f"{a}{b}" for a in ("ma", "ro", "ti", "len", "sor") for b in ("na", "dal", "vin", "ke", "tus", "ga")]
    texts, y = [], []
    for i in range(400):
        w = r.choices(words, k=r.randrange(30, 90))
        y.append(int(i % 5 == 0))
        for _ in range(y[-1] * r.randrange(1, 4)):
            w[r.randrange(len(w))] = r.choice(["Rotter", "villain!!", "SCOUNDREL"])
        texts.append(" ".join(w))
    return texts, np.array(y, float)


def test_toxic_spans_and_scores():
    texts, y = toxic_corpus()
    assert {w for w in toxicity.telling_words(texts, y) if w[-1] != "-"} == {"rotter", "villain", "scoundrel"}
    tagger = toxicity.Tagger(toxicity.train(texts, y))
    new = ["mana rodal you rotter, tivin", "mana rodal you are kind", "", "... !!! 12"]
    tags = tagger.tag(new)
    s = tagger.scores(tags)
    assert s[0] > 0.7 and (s[1:] < 0.3).all()
    assert [new[0][a:b] for a, b in toxicity.spans(new[0], tags[0])] == ["rotter,"]
    assert toxicity.spans(new[1], tags[1]) == []
    # Long and short texts go through the chain alike, alone or together.
    long = texts[0] * 50
    assert np.allclose(tagger.tag([long])[0], tagger.tag([*texts[:9], long])[9])


def test_scores_without_labels_of_both_kinds():
    assert toxicity.train([], np.zeros(0)) == 0.5 and quality.train([], np.zeros(0)) == 0.5
    assert toxicity.train(["a b"], np.ones(1)) == 1.0 and quality.train(["a"], np.ones(1)) == 1.0
    assert (quality.score(0.25, ["a", ""]) == 0.25).all()


def test_quality_reads_whole_texts():
    """Every byte is in a chunk, and what lies at the far end of a long text counts."""
    for n in (0, 1, 255, 256, 257, 480, 481, 5000):
        chunks = quality.chunks_of("".join(chr(97 + i % 26) for i in range(n)))
        back = np.concatenate([c[: quality.HOP] for c in chunks[:-1]] + [chunks[-1]])
        assert bytes(back[back < 256].astype(np.uint8)) == "".join(chr(97 + i % 26) for i in range(n)).encode()
    r = random.Random(2)
    good = [" ".join(r.choices(["mana", "rodal", "tivin", "kega"], k=r.randrange(20, 400))) for _ in range(300)]
    y = np.array([float(i % 3 > 0) for i in range(300)])
    texts = [t if k else t + " %%% &&& $$$ %%%" for t, k in zip(good, y)]
    p = quality.train(texts, y)
    s = quality.score(p, texts)
    assert ((s > 0.5) == (y > 0)).mean() > 0.97
    # One by one, or in small steps, the scores are the same.
    assert np.allclose(s[:9], [quality.score(p, [t], step=3)[0] for t in texts[:9]], atol=1e-5)


def test_the_gradient_of_the_quality_network():
    r = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in quality.initial().items()}
    letters = "".join(chr(c) for c in r.integers(97, 123, 700))  # no two chunks alike
    rows, y = [quality.chunks_of(letters), quality.chunks_of("%%% &&& " * 3)], np.array([1.0, 0.0])

    def loss():
        out = 0.0
        for c, t in zip(rows, y):
            h = quality.chunk_features(p, quality.pooled(p, c)[0])
            q = learning.sigmoid(np.r_[h.mean(axis=0), h.max(axis=0)] @ p["out"] + p["out_bias"])[0]
            out -= np.log(q if t else 1 - q) / len(y)
        return out + quality.DECAY / 2 * sum((p[k] ** 2).sum() for k in ("out", "hidden", "filters"))

    g = quality.gradients(p, rows, y)
    for k in g:
        for _ in range(4):
            i = tuple(r.integers(0, n) for n in p[k].shape)
            keep, eps = p[k][i], 1e-5
            p[k][i] = keep + eps
            up = loss()
            p[k][i] = keep - eps
            down = loss()
            p[k][i] = keep
            assert abs((up - down) / (2 * eps) - g[k][i]) < 1e-4, (k, i)


def test_labelled_sample(spark, odd, labels):
    texts, y = learning.labelled_sample(odd, labels, "quality", F.lit(True), 10)
    assert sorted(y) == [0.0, 1.0, 1.0, 1.0] and len(texts) == 4  # ids 6, 1, 5, 7
    texts, y = learning.labelled_sample(odd, labels, "toxic", F.lit(True), 10)
    assert sorted(y) == [0.0, 1.0]  # id 5 is labelled both ways, 7 not at all


@pytest.mark.parametrize("which", ["toxic", "quality"])
def test_scores_of_odd_rows(odd, odd_rows, empty, which):
    texts, y = toxic_corpus()
    model = toxicity.train(texts, y) if which == "toxic" else quality.train(texts[:60], y[:60])
    score = toxicity.score_documents if which == "toxic" else quality.score_documents
    rows = score(odd, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.doc_id, set()).add(round(r.score, 6))
    assert by_text[5] == by_text[6] and by_text[2] == by_text[3]
    assert score(empty, model).count() == 0


def test_reject_keeps_columns(odd, odd_rows, empty):
    texts, y = toxic_corpus()
    model = toxicity.train(texts, y)
    bad = odd.limit(1).withColumn("text", F.lit("mana villain tivin"))
    kept = toxicity.reject(odd.unionAll(bad), model)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    assert toxicity.reject(empty, model).count() == 0
    assert toxicity.reject(odd, 0.5).count() == len(odd_rows)


# -- personal data -----------------------------------------------------------------------------------


def digits(s):
    return re.sub("[^0-9]", "", s)


def check_digit(s):
    return sum((d * 2 - 9 if d > 4 else d * 2) if i % 2 else d for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


PII_RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and check_digit(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]
SECRET_RULES = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m.group(2)) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m.group()) >= 24),
]


def base_of(text, rules):
    found = []
    for rank, (kind, pattern, ok) in enumerate(rules):
        for m in re.finditer(pattern, text):
            if ok(m if rules is SECRET_RULES else m.group()):
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(found)]


def noisy_texts(pieces, n=400, seed=7):
    r = random.Random(seed)
    return ["".join(r.choice(pieces) for _ in range(r.randrange(1, 25))) for _ in range(n)]


PII_PIECES = [" ", " ", ".", "-", "@", "+", "(", ")", "a", "b.c", "é", "\U0001f600", "1", "22", "255", "256", "0001", "4111111111111111", "5500 0000 0000 0004", "+1 (555) 123-4567", "x@y.org", "_", "\n", ".5", "10.0.0.1", "(at)", "%"]


def check_base(rows, texts, rules):
    texts = dict(texts)
    for r in rows:
        want = base_of(texts[r.doc_id], rules)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (texts[r.doc_id][:300], r, want)
        for kind, *_ in rules:
            assert r[f"n_{kind}"] == sum(s.startswith(kind) for s in want)
        spans = r.spans.split(",") if r.spans else []
        assert set(want) <= set(spans)
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts) and all(0 <= a < int(s.split(":")[2]) <= len(texts[r.doc_id]) for a, s in zip(starts, spans))


def counts_of(found):
    counts = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii._written("_base"), 256).alias("base_sha256"), pii._written("_spans").alias("spans")).collect()


def test_base_rules_of_personal_data(spark):
    texts = list(enumerate(noisy_texts(PII_PIECES)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check_base(counts_of(pii.with_spans(df, None)), texts, PII_RULES)


def test_op7(spark, small, sf):
    rows = QUERIES["op7_pii"](spark, sf).collect()
    assert len(rows) == len(small)
    check_base(rows, zip(map(int, small.doc_id), small.text), PII_RULES)


def test_redaction_of_odd_rows(odd, odd_rows, empty):
    out = pii.redact(odd, None)
    assert out.columns == odd.columns and [f.dataType for f in out.schema] == [f.dataType for f in odd.schema]
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].text is None and by_id[3].text == ""
    assert by_id[10].text == "9" * 9000 + " [PHONE] [EMAIL][EMAIL] [IP].[IP] [CARD]" or "[EMAIL]" in by_id[10].text
    assert by_id[10].n_chars == len(by_id[10].text)
    assert by_id[1].text == "A short text about a cat."
    assert pii.redact(empty, None).count() == 0
    assert pii.learn(empty) is None


def test_trees_as_sql_agree_with_the_model(spark):
    """The written-out trees give the model's own margins."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    r = random.Random(3)
    texts = [(i, f"call +1 (555) 123-{r.randrange(1000, 9999)} or {r.randrange(10**9)} and {r.randrange(10**15, 10**16)} x{i}@m.org") for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    learned = pii.learn(df)
    assert learned is not None
    model, bars = learned
    rows = pii.with_proposals(pii.with_base(df)).select(F.explode("_proposed").alias("p"))
    rows = rows.select("p.f.*", pii.margin(model, F.col("p")).alias("margin"))
    both = model.transform(VectorAssembler(inputCols=pii.FEATURES, outputCol="v").transform(rows))
    assert both.where(F.abs(vector_to_array("rawPrediction")[1] - F.col("margin")) > 1e-6).count() == 0
    assert all(s in r.spans for r in counts_of(pii.with_spans(df, learned)) for s in ["email:"])


# -- secrets -----------------------------------------------------------------------------------------


def test_base_rules_of_secrets(spark):
    pieces = ["token", "Secret", "API_KEY", "apikey", "password", " ", "=", ":", '"', "'", "abc", "abcdef0123", "AKIA", "AKIA1234567890ABCD", "0a1b2c3d4e5f60718293a4b5c6", "é", "\U0001f600", "K", "ſecret", "\n", "."]
    texts = list(enumerate(noisy_texts(pieces, 600)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check_base(secrets.find_secrets(df, None).collect(), texts, SECRET_RULES)


def test_op10(spark, sf, small):
    rows = QUERIES["op10_secrets"](spark, sf).collect()
    assert len(rows) == len(small)
    check_base(rows, zip(map(int, small.doc_id), small.text), SECRET_RULES)


def test_the_network_finds_what_no_rule_names():
    r = random.Random(9)
    seqs, y = [], []
    for i in range(600):
        if i % 2:
            key = "".join(r.choice("0123456789abcdef") for _ in range(32))
            text = f'words and token = "{key}" and more'
        else:
            key = f"section{r.randrange(99)}.example.org/page{r.randrange(99)}"
            text = f"words and see {key} for more of it"
        at = text.index(key)
        seqs.append(secrets.symbols(text, at, at + len(key)))
        y.append(float(i % 2))
    y = np.array(y)
    p = secrets.train(seqs[:400], y[:400])
    assert ((secrets.probabilities(p, seqs[400:]) > 0.5) == (y[400:] > 0)).mean() > 0.97
    text = "é header: Bearer 9F8E7D6C5B4A39281706F5E4D3C2B1A0 tail"
    (base, added), = secrets.find([text], (p, 0.0))
    assert base == [] and [text[s:e] for s, e, _ in added] == ["9F8E7D6C5B4A39281706F5E4D3C2B1A0"]


def test_secrets_of_odd_rows(odd, odd_rows, empty):
    rows = secrets.find_secrets(odd, secrets.learn(odd)).collect()
    assert len(rows) == len(odd_rows)
    row = next(r for r in rows if r.doc_id == 11)
    assert (row.n_assign, row.n_access, row.n_hex) == (1, 1, 1)
    assert secrets.find_secrets(empty, secrets.learn(empty)).count() == 0


# -- decontamination ---------------------------------------------------------------------------------


def edit_distance_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_distance_against_the_whole_table():
    r = random.Random(1)
    for _ in range(300):
        p = "".join(r.choice("ab ") for _ in range(r.randrange(1, 90)))
        t = "".join(r.choice("ab ") for _ in range(r.randrange(0, 120)))
        assert decontaminate.best_place(p, t, 1000)[0] == edit_distance_inside(p, t)
    assert decontaminate.best_place("abcdef", "xyz", 2) is None


def test_op8_finds_every_passage(spark, sf, small):
    """Against a search for each whole item, case and white space folded, in every document."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet").toPandas()
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op8_decontamination"](spark, sf).collect()}
    fold = lambda t: " ".join(t.lower().split())
    exact = {(d, i) for d, t in zip(small.doc_id, map(fold, small.text)) for i, x in zip(items.item_id, map(fold, items.text)) if x in t}
    assert exact and exact <= set(got) and all(got[k] == 0 for k in exact)
    texts, wanted = dict(zip(small.doc_id, map(fold, small.text))), dict(zip(items.item_id, map(fold, items.text)))
    for (d, i), distance in got.items():
        assert distance <= decontaminate.MAX_SHARE * len(wanted[i])
        assert edit_distance_inside(wanted[i], texts[d]) <= distance


def test_recall_of_edited_passages(spark):
    """Passages with every twelfth word changed are found; clean documents are left alone."""
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 10))) for _ in range(800)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randrange(18, 60)))) for i in range(60)]
    docs = []
    for i in range(600):
        w = r.choices(vocabulary, k=r.randrange(30, 300))
        if i < 300:
            x = items[i % 60][1].split()
            for _ in range(len(x) // 12):
                k = r.randrange(len(x))
                x[k : k + 1] = r.choice([[], [x[k][:-1] + "z"], [x[k], "extra"], [r.choice(vocabulary)]])
            at = r.randrange(len(w))
            w[at:at] = x
        docs.append((i, r.choice([" ", "  ", "\n"]).join(w).title() if i % 2 else " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(x.doc_id, x.item_id) for x in decontaminate.leaks(df, bench).collect()}
    assert len({(i, i % 60) for i in range(300)} & found) >= 0.95 * 300
    assert all(d < 300 for d, _ in found)
    kept = {x.doc_id for x in decontaminate.decontaminate(df, bench).collect()}
    assert kept == set(range(600)) - {d for d, _ in found}


def test_blocks_of_items_give_the_same(spark, sf, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(decontaminate.leaks(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 20)
    assert len(list(decontaminate._blocks(bench))) > 2
    assert sorted(decontaminate.leaks(docs, bench).collect()) == whole


def test_decontamination_of_odd_rows(spark, odd, odd_rows, empty):
    bench = spark.createDataFrame([(1, "one two"), (1, "one two"), (2, None), (3, ""), (None, "a text without an id")], "item_id long, text string")
    rows = decontaminate.leaks(odd, bench).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in rows) == [(0, 0), (7, 1), (7, 1), (7, 1), (7, 1)]
    kept = decontaminate.decontaminate(odd, bench)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows) - 3
    assert decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(odd, bench.limit(0)).count() == 0
    assert decontaminate.decontaminate(odd, bench.limit(0)).count() == len(odd_rows)


def test_spans_are_written_as_json(spark, sf):
    for r in QUERIES["op6_toxicity"](spark, sf).collect():
        assert all(a < b for a, b in json.loads(r.toxic_spans))


def leaked_of(pairs, words):
    """Which of (item, its edited form) are found, each form between other words; forms beyond the limit are left out."""
    pairs = [(x, y) for x, y in pairs if decontaminate.best_place(x, y, int(decontaminate.MAX_SHARE * len(x))) is not None]
    docs = [" ".join([*words(30), y, *words(30)]) for _, y in pairs]
    found = {(d, n) for d, n, *_ in decontaminate.Index([(i, x) for i, (x, _) in enumerate(pairs)]).leaks(docs)}
    return [(i, i) in found for i in range(len(pairs))]


def test_recall_up_to_the_limit():
    """Typos in every third word, every sixth word replaced, and single letters changed up to the limit."""
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 10))) for _ in range(800)]
    words = lambda n: r.choices(vocabulary, k=n)

    def every(n, change):
        out = []
        for _ in range(150):
            x = words(r.randrange(15, 60))
            out.append((" ".join(x), " ".join(change(w) if i % n == n - 1 else w for i, w in enumerate(x))))
        return out

    def typo(w):
        i = r.randrange(len(w))
        return w[:i] + r.choice("qrstuvwxyz") + w[i + 1 :]

    assert all(leaked_of(every(3, typo), words))
    assert all(leaked_of(every(6, lambda w: r.choice(vocabulary)), words))
    spread = []
    for _ in range(150):
        x = " ".join(words(r.randrange(15, 60)))
        y = list(x)
        for i in r.sample(range(len(y)), int(decontaminate.MAX_SHARE * len(y))):
            y[i] = r.choice("qrstuvwxyz")
        spread.append((x, "".join(y)))
    assert sum(leaked_of(spread, words)) >= 0.98 * len(spread)
    even = []
    for _ in range(150):
        x = " ".join(words(r.randrange(15, 60)))
        even.append((x, "".join(r.choice("qrstuvwxyz") if i % 5 == 4 else c for i, c in enumerate(x))))
    assert sum(leaked_of(even, words)) >= 0.9 * len(even)
    mixed = []
    for _ in range(150):
        x = " ".join(words(r.randrange(15, 60)))
        y = list(x)
        for _ in range(int(0.2 * len(x))):
            at = r.randrange(len(y))
            y[at : at + 1] = r.choice([[], [r.choice("qrstuvwxyz")], [y[at], r.choice("abc ")]])
        mixed.append((x, "".join(y)))
    assert sum(leaked_of(mixed, words)) >= 0.9 * len(mixed)


def test_op8_against_every_pair(spark, sf, small):
    """The registered result: all documents, all items, exact distances over whole texts."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet").toPandas()
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op8_decontamination"](spark, sf).collect()}
    want = {}
    for d, text in zip(small.doc_id, map(decontaminate.folded, small.text)):
        for i, x in zip(items.item_id, map(decontaminate.folded, items.text)):
            place = decontaminate.best_place(x, text, int(decontaminate.MAX_SHARE * len(x)))
            if place is not None:
                want[d, i] = place[0]
    assert got == want


def test_items_without_spaces(spark):
    """Scripts without word gaps: windows begin inside the long words."""
    r = random.Random(14)
    letters = [chr(0x4E00 + i) for i in range(600)]
    pairs = []
    for _ in range(60):
        x = "".join(r.choices(letters, k=r.randrange(90, 200)))
        y = list(x)
        for i in r.sample(range(len(y)), len(y) // 12):
            y[i] = r.choice(letters)
        pairs.append((x, "".join(y)))
    docs = ["".join(r.choices(letters, k=150)) + y + "".join(r.choices(letters, k=151)) for _, y in pairs]
    found = {(d, n) for d, n, *_ in decontaminate.Index([(i, x) for i, (x, _) in enumerate(pairs)]).leaks(docs)}
    assert len(found & {(i, i) for i in range(60)}) >= 57 and all(d == n for d, n in found)


def test_walks_meet_again():
    """Equal windows have equal keys, and one changed letter leaves a good share of keys."""
    r = random.Random(15)
    same, n = 0, 3000
    for _ in range(n):
        x = "".join(r.choice("abcdefghijklmnop ") for _ in range(40))
        at = r.randrange(18)
        y = x[:at] + r.choice("qrstuv") + x[at + 1 :]
        for number in range(decontaminate.WALKS):
            keys = [decontaminate.walk(decontaminate.codes(t), np.zeros(1, int), number)[0][0] for t in (x, x, y)]
            assert keys[0] == keys[1]
            same += keys[0] == keys[2]
    assert 0.25 < same / (n * decontaminate.WALKS) < 0.6


def test_short_items_and_long_insertions():
    """Exact and edited items of 3 to 12 words, and an item with words inserted in its middle."""
    r = random.Random(10)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 10))) for _ in range(800)]
    words = lambda n: r.choices(vocabulary, k=n)
    short = [words(r.randrange(3, 13)) for _ in range(400)]
    assert all(leaked_of([(" ".join(x), " ".join(x)) for x in short], words))
    changed = []
    for x in short:
        y = list(x)
        y[r.randrange(len(y))] = r.choice(vocabulary)
        changed.append((" ".join(x), " ".join(y)))
    assert len(leaked_of(changed, words)) > 100 and all(leaked_of(changed, words))
    long = []
    for _ in range(10):
        x, more = words(300), words(45)
        long.append((" ".join(x), " ".join(x[:150] + more + x[150:])))
    assert len(leaked_of(long, words)) > 3 and all(leaked_of(long, words))


def test_copies_do_not_fill_the_sample_of_findings(spark, monkeypatch):
    """The candidate whose hash comes first stands in two thirds of all documents."""
    r = random.Random(12)
    texts = []
    for i in range(120):
        key = "".join(r.choice("0123456789abcdef") for _ in range(32)) if i % 2 else f"section{r.randrange(10**6)}.example.org/page{i}"
        texts.append(f'words and token = "{key}" and more' if i % 2 else f"words and see {key} for more of it")
    x = [secrets.symbols(t, s, e).astype("<u2").tobytes() for t in texts for s, e, _ in secrets.examine(t)[1]]
    first = spark.createDataFrame(list(zip(texts, x)), "text string, x binary").orderBy(F.xxhash64("x")).first().text
    df = spark.createDataFrame(list(enumerate(texts + [first] * 240)), "doc_id long, text string")
    monkeypatch.setattr(secrets, "SAMPLE", 100)
    seqs, n, confirmed, fit = secrets.findings(df)
    assert len({s.tobytes() for s in seqs}) == len(seqs) == 100 and n.max() > 100
    network, bar = secrets.learn(df)
    scores = secrets.probabilities(network, [s for s, f, k in zip(seqs, fit, confirmed) if k and not f])
    assert (scores >= bar).mean() >= secrets.RECALL


def test_secrets_are_learned_from_all_findings(spark, monkeypatch):
    """The only confirmed keys set aside beyond the sample score as they do: the bar counts them, and the
    network moves with findings that the sample does not hold."""
    r = random.Random(13)
    texts = []
    for i in range(400):
        key = "".join(r.choice("0123456789abcdef") for _ in range(32)) if i % 2 else f"section{r.randrange(10**6)}.example.org/page{i}"
        texts.append((i, f'words and token = "{key}" and more' if i % 2 else f"words and see {key} for more of it"))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    whole = secrets.candidates(df)
    aside = whole.where("not fit and confirmed > 0").collect()
    monkeypatch.setattr(secrets, "SAMPLE", 60)
    monkeypatch.setattr(secrets, "BLOCK", 100)
    network, bar = secrets.learn(df)
    again, same = secrets.learn(df)
    assert bar == same and all((network[k] == again[k]).all() for k in network)
    scores = secrets.probabilities(network, [secrets._sequence(x.x) for x in aside])
    assert len(aside) > 30 and bar == secrets.threshold(scores, np.array([x.confirmed for x in aside], float))
    seqs, n, confirmed, fit = secrets.findings(df)
    first = secrets.train([s for s, f in zip(seqs, fit) if f], (2 * confirmed >= n).astype(float)[fit])
    assert any((first[k] != network[k]).any() for k in network)


def test_threshold_recalls_what_it_says():
    scores, times = np.array([0.9, 0.3, 0.2, 0.1]), np.array([1.0, 1000.0, 1.0, 1.0])
    assert secrets.threshold(scores, times) == 0.1
    assert secrets.threshold(np.linspace(0.1, 0.4, 100), np.ones(100)) == np.linspace(0.1, 0.4, 100)[2]


def test_unconfirmed_personal_data_is_found(spark):
    """One proposal in five is personal data that no base rule confirms."""
    r = random.Random(5)
    n = lambda a, b: r.randrange(a, b)
    texts = []
    for i in range(600):
        call, mail = r.choice(["call", "ring", "see"]), r.choice(["mail", "write", "by"])
        said = f"{call} +1 {n(200, 999)} {n(100, 999)}-{n(1000, 9999)} or {mail} name{i}@host{n(1, 9)}.org and "
        none = f"on 20{n(10, 25)}-0{n(1, 9)}-1{n(0, 9)} at {n(100, 999)}.{n(10000, 99999)} id {n(10**20, 10**21)} user{i}@box{n(1, 9)} "
        texts.append((i, said + none + (f"then {call} ({n(200, 999)}) {n(100, 999)}-{n(1000, 9999)} {mail} name{i} (at) host{n(1, 9)} (dot) org end" if i % 2 else "end")))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for row in pii.redact(df, pii.learn(df)).collect():
        rest = row.text.split(" and ")[1]
        assert rest.startswith("on 20") and "user" in rest
        assert not row.doc_id % 2 or ("[NUMBER]" in rest and "(at)" not in rest), row.text


def test_copies_of_an_id_do_not_reach_the_driver(spark, monkeypatch):
    """An id that holds most rows sends one text, the least."""
    from pyspark.sql.classic.dataframe import DataFrame

    docs = spark.createDataFrame([(1, f"text {i:04}") for i in range(500)] + [(2, "b"), (2, "a"), (3, "c")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    sent, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: sent.append(collect(df)) or sent[-1])
    texts, y = learning.labelled_sample(docs, marks, "toxic", F.lit(True), 100)
    assert (texts, list(y)) == (["text 0000", "a", "c"], [1, 0, 1])
    assert max(map(len, sent)) == 3
