import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltbed.operators import merge
from siltbed.sources import readers


def rows(spark, data, ddl="k INT, x STRING"):
    return readers.rows(spark, data, ddl)


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_update_leaves_unmatched_and_null_keys(spark):
    target = rows(spark, [(1, "a"), (2, "b"), (2, "bb"), (None, "n")])
    source = rows(spark, [(2, "B"), (None, "N"), (9, "z")])
    got = values(merge.merge_update(target, source, ["k"], {"x": "x"}))
    assert got == sorted([(1, "a"), (2, "B"), (2, "B"), (None, "n")], key=repr)
    safe = values(merge.merge_update(target, source, ["k"], {"x": "x"}, null_safe=True))
    assert (None, "N") in safe and (None, "n") not in safe


def test_update_can_set_null(spark):
    target = rows(spark, [(1, "a")])
    assert values(merge.merge_update(target, rows(spark, [(1, None)]), ["k"], {"x": "x"})) == [(1, None)]


def test_ambiguous_source_raises_only_if_it_matches(spark):
    target = rows(spark, [(1, "a"), (2, "b")])
    with pytest.raises(PySparkException, match="several source rows match one target row"):
        merge.merge_update(target, rows(spark, [(2, "x"), (2, "y")]), ["k"], {"x": "x"}).collect()
    unmatched = rows(spark, [(9, "x"), (9, "y")])
    assert values(merge.merge_update(target, unmatched, ["k"], {"x": "x"})) == [(1, "a"), (2, "b")]


def test_insert_new_keeps_source_copies_and_null_keys(spark):
    target = rows(spark, [(1, "a"), (None, "n")])
    source = rows(spark, [(1, "no"), (5, "e"), (5, "e"), (None, "n")])
    got = values(merge.merge_insert_new(target, source, ["k"]))
    assert got == sorted([(1, "a"), (None, "n"), (5, "e"), (5, "e"), (None, "n")], key=repr)
    safe = values(merge.merge_insert_new(target, source, ["k"], null_safe=True))
    assert safe.count((None, "n")) == 1


def test_insert_is_idempotent_on_whole_values(spark):
    target = rows(spark, [("a",), ("b",)], "value STRING")
    source = rows(spark, [("b",), ("c",)], "value STRING")
    once = merge.merge_insert_new(target, source, ["value"])
    twice = merge.merge_insert_new(once, source, ["value"])
    assert values(twice) == values(once) == [("a",), ("b",), ("c",)]


def test_general_merge_with_renamed_source_column(spark):
    target = rows(spark, [(1, "a"), (2, "b")])
    source = rows(spark, [(2, "X"), (3, "Y")])
    got = values(merge.merge_into(target, source, ["k"], {"x": "x"}, insert_new=True))
    assert got == [(1, "a"), (2, "X"), (3, "Y")]


def test_hot_key_merges_whole(spark):
    """A third of the target on one key, and many copies of one new key in the source."""
    n = 30_000
    target = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id").cast("int") + 100).alias("k"),
        F.lit("old").alias("x"),
    )
    fixed = rows(spark, [(7, "new")])
    out = merge.merge_update(target, fixed, ["k"], {"x": "x"})
    assert {r["x"]: r["count"] for r in out.groupBy("x").count().collect()} == {"old": n * 2 // 3, "new": n // 3}
    many = spark.range(n).select(F.lit(-1).alias("k"), F.lit("s").alias("x"))
    assert merge.merge_insert_new(target, many, ["k"]).count() == 2 * n
