import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.llm import lexical

SCHEMA = "doc_id long, text string"
ITEMS = "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def found(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score), sorted; docs are (doc_id, text)."""
    counted = [(d, c) for d, c in ((d, Counter(found(t))) for d, t in docs) if c]
    n_docs, n_tokens = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counted:
            m = 100 - 25 + (25 * c.total() * n_docs) // n_tokens
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in found(text) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def ours(docs, items, k=20):
    return sorted(map(tuple, lexical.Index.build(docs).search(items, k).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(seed=4, n=600):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)] + ["Über", "naïve", "X1"]
    weight = 1 / np.arange(1, len(words) + 1)
    some = lambda k: " ".join(str(x) for x in rng.choice(words, k, p=weight / weight.sum()))
    docs = [(i if i % 50 else None, some(int(rng.geometric(0.02)))) for i in range(n)]
    docs += [(7000 + i, docs[1][1]) for i in range(40)]  # ties
    items = [(i, some(int(rng.integers(1, 25)))) for i in range(30)] + [(99, docs[1][1])]
    return docs, items


@pytest.mark.parametrize("block, vocabulary, chunk", [(2048, 200_000, 1024), (16, 50, 7)])
def test_equals_brute_force(spark, monkeypatch, block, vocabulary, chunk):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "VOCABULARY", vocabulary)
    monkeypatch.setattr(lexical, "TERMS", chunk)
    monkeypatch.setattr(lexical, "ITEMS", 8 if block == 16 else 1024)
    docs, items = corpus()
    assert ours(spark.createDataFrame(docs, SCHEMA).repartition(6), spark.createDataFrame(items, ITEMS)) == brute(docs, items)


def test_bounds_lie_above_every_score_and_close_to_it(spark):
    docs, items = corpus()
    df = spark.createDataFrame(docs, SCHEMA)
    index = lexical.Index.build(df)
    asked = index._asked([t for _, t in items])
    marks = {r.mark: r.text for r in index.docs.collect()}
    above, scores = [], []
    for row in index.rows.where("docs is not null").collect():
        got = lexical.bounds(row.asDict(), asked, asked.chunks())
        for j, mark in enumerate(np.frombuffer(row.marks, "<i8").tolist()):
            words = lexical.terms(marks[mark])
            for no, wanted in enumerate(asked.wanted):
                scores.append(lexical.score(Counter(words), len(words), wanted, asked.n_docs, asked.n_tokens))
                above.append(int(got[no, j]))
    above, scores = np.array(above), np.array(scores)
    assert (above >= scores).all()
    assert above.sum() < 1.25 * scores.sum()


def test_a_bar_above_every_bound_excludes_all(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    index = lexical.Index.build(docs)
    texts = [r.text for r in items.collect()]
    asked = index._asked(texts)
    bars = np.full(len(texts), 10**18)
    blocks = index.rows.where("docs is not null").drop("term", "df")
    assert blocks.mapInArrow(lexical._reaching(asked, bars), "no int, mark long").count() == 0


def test_odd_rows_other_columns_and_odd_items(spark, odd, odd_rows):
    items = [(1, None), (2, ""), (None, "cat mill"), (3, "THE cat, the\x00CAT!"), (3, "nul it s"), (4, "unknownword"), (5, "two " * 9000)]
    got = ours(odd, spark.createDataFrame([(*r, "x") for r in items], ITEMS + ", score string").withColumn("rank", F.lit(None)))
    assert got == brute([r[:2] for r in odd_rows], items)


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "a cat")], ITEMS)
    assert ours(empty, items) == []
    assert ours(spark.createDataFrame([(1, "a cat")], SCHEMA), items.limit(0)) == []
    assert ours(spark.createDataFrame([(1, None), (2, " ,")], SCHEMA), items) == []


def test_terms_are_those_of_the_pattern():
    for text in ("Äpfel-Öl A1b2 x_y z w ÀÉ İI \x7f\x80 it's", "", "١٢ ABC", "a\u0085b"):
        assert [t.decode() for t in lexical.terms(text)] == found(text)
