import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from siltbed.operators import aggregates
from siltbed.sources import catalog, files, readers, writers


def diamonds(spark):
    colors = "DEFGHIJ"
    data = [(0.2 + i / 100, "Good" if i % 2 else "Fair", colors[i % 7], 300 + i) for i in range(200)]
    return readers.rows(spark, data, "carat DOUBLE, cut STRING, color STRING, price INT")


def test_csv_three_ways(spark, home):
    path = f"{home}/diamonds"
    writers.write_csv(diamonds(spark), path)
    inferred = readers.csv_inferred(spark, path)
    assert inferred.dtypes == diamonds(spark).dtypes
    typed = readers.csv_typed(spark, path, "carat DOUBLE, cut STRING, color STRING, price INT", header=True)
    mean = lambda df: [(r[0], round(r[1], 6)) for r in aggregates.average_sorted(df, "color", "price").collect()]
    assert mean(inferred) == mean(typed) == mean(diamonds(spark))
    table = readers.csv_as_table(spark, "diamonds_csv", path)
    assert {t for _, t in table.dtypes} == {"string"}
    got = spark.sql("SELECT color, avg(price) AS price FROM diamonds_csv GROUP BY color ORDER BY color")
    assert [(r[0], round(r[1], 6)) for r in got.collect()] == mean(inferred)
    spark.sql("DROP TABLE diamonds_csv")


def test_register_replaces_and_keeps_files(spark, home):
    writers.overwrite_path(diamonds(spark), f"{home}/a", ["color"])
    writers.overwrite_path(diamonds(spark).limit(5), f"{home}/b")
    assert writers.register(spark, "gems", f"{home}/a").count() == 200
    assert writers.register(spark, "gems", f"{home}/b").count() == 5
    spark.sql("DROP TABLE gems")
    assert readers.table_batch(spark, f"{home}/a").count() == 200


def test_file_stats_and_presence(spark, home):
    for i, text in enumerate(["abc", "de", "f"]):
        sub = f"{home}/in/{'deep/' * i}"
        os.makedirs(sub, exist_ok=True)
        with open(f"{sub}/data_{i}.json", "w") as f:
            f.write(text)
    assert tuple(files.file_stats(spark, f"{home}/in").first()) == (3, 6)
    files.assert_file_present(spark, f"{home}/in", "data_2.json")
    with pytest.raises(AssertionError):
        files.assert_file_present(spark, f"{home}/in", "data_9.json")
    with pytest.raises(AnalysisException):
        files.file_stats(spark, f"{home}/nowhere").first()
    detail = catalog.table_detail(spark, f"{home}/in", ["day"]).first()
    assert (detail["n_files"], detail["partition_columns"]) == (3, "day")


def test_manifest_diff(spark):
    ddl = "name STRING, size BIGINT"
    a = readers.rows(spark, [("same", 1), ("gone", 2), ("grown", 3)], ddl)
    b = readers.rows(spark, [("same", 1), ("new", 2), ("grown", 4)], ddl)
    got = {r["name"]: r["verdict"] for r in files.manifest_diff(a, b).collect()}
    assert got == {"gone": "missing", "new": "extra", "grown": "size_mismatch"}


def test_partition_counts_sum_to_total(spark):
    df = readers.row_ids(spark, 1000).repartition(7)
    assert aggregates.partition_counts(df).agg(F.sum("n_rows")).first()[0] == 1000


def test_database_life_cycle(spark):
    catalog.use_database(spark, "silt_test_db")
    assert spark.catalog.currentDatabase() == "silt_test_db"
    writers.overwrite_table(readers.row_ids(spark, 3), "three")
    listed = catalog.show_tables(spark, "silt_test_db").where("NOT isTemporary")
    assert [r["tableName"] for r in listed.collect()] == ["three"]
    spark.sql("USE default")
    catalog.drop_database(spark, "silt_test_db")
    assert not spark.catalog.databaseExists("silt_test_db")


def test_cache_and_recache(spark):
    first = catalog.cache_as(readers.row_ids(spark, 3), "cached_rows")
    assert first.count() == 3 and spark.catalog.isCached("cached_rows")
    again = catalog.cache_as(readers.row_ids(spark, 5), "cached_rows")
    assert again.count() == 5 and spark.catalog.isCached("cached_rows")
    spark.catalog.uncacheTable("cached_rows")


def test_timed_count(spark):
    df, total, ms = catalog.timed_count(lambda: readers.row_ids(spark, 3))
    assert (df.count(), total) == (3, 3)
    assert 0 < ms < 10_000


def test_clustered_write_conserves_rows(spark, home):
    df = spark.range(5000).select(
        (F.col("id") % 71).alias("a"), (F.col("id") * 7 % 113).cast("double").alias("b"),
        (F.col("id") % 3).cast("int").alias("p"),
    )
    writers.write_clustered(df, f"{home}/z", ["a", "b"], partition_by=["p"])
    back = spark.read.parquet(f"{home}/z")
    assert sorted(back.columns) == ["a", "b", "p"]
    assert aggregates.table_diff(df, back.select("a", "b", "p")).isEmpty()


def test_null_profile(spark):
    df = readers.rows(spark, [(1, None), (None, None)], "a INT, b STRING")
    assert {r[0]: r[1] for r in aggregates.null_profile(df).collect()} == {"a": 1, "b": 2}
    assert aggregates.columns_with_nulls(df.select(F.lit(1).alias("c"))).count() == 0
    assert {r[0]: r[1] for r in aggregates.schema_profile(df).collect()} == {"int": 1, "string": 1}


def test_one_outlier_does_not_spoil_the_layout(spark, home):
    """Files a box filter has to read, by their own min and max, with an extreme outlier in each column."""
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("a"), (F.col("id") * 104_729 % 20_021).cast("double").alias("b"))
    df = df.unionAll(readers.rows(spark, [(1e18, -1e18)], "a DOUBLE, b DOUBLE"))
    writers.write_clustered(df, f"{home}/z", ["a", "b"], files=16)
    ranges = spark.read.parquet(f"{home}/z").groupBy(F.input_file_name().alias("f")).agg(*[f(c).alias(f"{n}_{c}") for c in "ab" for n, f in (("low", F.min), ("high", F.max))]).collect()
    assert len(ranges) == 16
    box = [r for r in ranges if r["low_a"] <= 4000 and r["high_a"] >= 2000 and r["low_b"] <= 4000 and r["high_b"] >= 2000]
    assert len(box) <= 5
    assert spark.read.parquet(f"{home}/z").count() == 20_001


def test_rank_cells(spark):
    df = readers.rows(spark, [(None,), (-5.0,), (1.0,), (1.0,), (1.0,), (9.0,)], "v DOUBLE")
    assert [r[0] for r in df.select(writers.rank_cell("v", [-1.0, 1.0, 8.0])).collect()] == [0, 0, 2, 2, 2, 3]
    borders = writers.rank_borders(spark.range(1000).select(F.col("id").cast("double").alias("v")), ["v"], 3)[0]
    assert len(borders) == 7 and all(abs(b - 125 * (i + 1)) <= 3 for i, b in enumerate(borders))
    assert writers.rank_borders(df.where("v is null"), ["v"]) == [[]]
