"""The pipeline, stage by stage, against what each stage must do to its own input."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from siltbed.llm import neardup, pii
from siltbed.llm.common import importable
from test_filters import PII_RULES, base_of
from test_neardup import brute

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    importable(spark)
    home, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{home}/{name}")
        after = spark.read.parquet(f"{home}/{name}")
        out[name] = (docs.toPandas(), after.toPandas())
        docs = after
    return out


def test_all_stages_but_the_last_return_documents(steps):
    for name, (before, after) in list(steps.items())[:-1]:
        assert list(after.columns) == DOCUMENTS and after.doc_id.is_unique
        if name != "pii":
            same = after.merge(before, on="doc_id")
            assert len(same) == len(after)
            assert all((same[f"{c}_x"] == same[f"{c}_y"]).all() for c in DOCUMENTS[1:])


def test_toxic_documents_go(steps, spark, sf):
    before, after = steps["toxicity"]
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").toxic
    gone = set(before.doc_id) - set(after.doc_id)
    clean = {d for d in before.doc_id if labels.get(d) == 0}
    assert len(gone & clean) <= 0.03 * len(clean)


def test_one_document_of_each_group_stays(steps):
    before, after = steps["near_dedup"]
    rows = list(zip(map(int, before.doc_id), before.text))
    want = {d for (d, _), (n, c) in zip(rows, brute(rows)) if not n or d == c}
    assert set(after.doc_id) == want and len(want) < len(before)


def test_leaking_documents_go(steps, spark, sf):
    before, after = steps["decontamination"]
    fold = lambda t: " ".join(t.lower().split())
    items = [fold(t) for t in spark.read.parquet(f"{sf}/benchmark.parquet").toPandas().text]
    leaking = {d for d, t in zip(before.doc_id, map(fold, before.text)) if any(i in t for i in items)}
    gone = set(before.doc_id) - set(after.doc_id)
    assert leaking <= gone and len(gone) <= len(leaking) + 2


def test_personal_data_is_replaced(steps):
    before, after = steps["pii"]
    assert list(before.doc_id.sort_values()) == list(after.doc_id.sort_values())
    after = after.set_index("doc_id")
    changed = 0
    for d, t in zip(before.doc_id, before.text):
        spans = [s.split(":") for s in base_of(t, PII_RULES)]
        new = after.text[d]
        assert after.n_chars[d] == len(new)
        for kind, a, b in spans:
            assert t[int(a) : int(b)] not in new and f"[{kind.upper()}]" in new
        changed += new != t
    assert changed


def test_windows_hold_what_is_left(steps):
    before, after = steps["packing"]
    assert set(after.doc_id) == set(before.doc_id)
    assert (after.groupby("doc_id").length.sum() == after.groupby("doc_id").doc_tokens.first()).all()


def test_run_gives_the_last_stage(spark, sf, steps):
    key = ["doc_id", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, sf).toPandas()
    assert got.length.sum() == steps["packing"][1].length.sum()
    assert set(got.doc_id) == set(steps["packing"][1].doc_id) and key[0] in got.columns


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_pass_every_stage(spark, odd, empty, odd_rows, sf, stage):
    name, f = stage
    assert f(spark, empty, sf).count() == 0
    out = f(spark, odd, sf)
    if name != "packing":
        assert out.columns == odd.columns
        assert out.count() == (len(odd_rows) - 3 if name == "near_dedup" else len(odd_rows))


def test_one_of_each_keeps_one_of_equal_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "x y z u v w"), (None, "x y z u v w"), (3, None), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_mark", F.lit("own"))
    kept = sorted((r.doc_id or 0, r.text or "") for r in neardup.one_of_each(df).collect())
    assert kept == [(0, "x y z u v w"), (1, "a b c d e f"), (3, ""), (3, ""), (4, "")]


def test_redaction_survives_overlaps(spark):
    df = spark.createDataFrame([(1, "mail 4111 1111 1111 1111@x.org now +1 555 123 4567.")], "doc_id long, text string")
    assert pii.redact(df, None).first().text == "mail [CARD] now [PHONE]."
