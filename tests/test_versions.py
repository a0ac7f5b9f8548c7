import pytest
from pyspark.sql import functions as F

from siltbed.operators import schemas, versions
from siltbed.sources import readers

DDL = "k INT, x STRING"


def rows(spark, *data, ddl=DDL):
    return readers.rows(spark, list(data), ddl)


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_batches_are_written_once_and_numbered(spark, home):
    t = f"{home}/t"
    assert versions.latest_version(spark, t) == -1
    assert versions.commit(rows(spark, (1, "a")), t, "s", 0) == 0
    assert versions.commit(rows(spark, (1, "a")), t, "s", 0) is None
    assert versions.commit(rows(spark, (2, "b")), t, "s", 1) == 1
    assert versions.commit(rows(spark, (3, "c")), t, "other", 0) == 2
    assert versions.commit(rows(spark).where("false"), t, "other", 1, skip_empty=True) is None
    assert values(versions.read_as_of(spark, t)) == [(1, "a"), (2, "b"), (3, "c")]
    assert values(versions.read_as_of(spark, t, 1)) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="no commit 9"):
        versions.read_as_of(spark, t, 9)


def test_partitions_of_digits_stay_text(spark, home):
    t, ddl = f"{home}/t", "kind STRING, x INT"
    versions.commit(rows(spark, ("007", 1), ("1", 2), ddl=ddl), t, "s", 0, partition_by=["kind"])
    versions.commit(rows(spark, ("010", 3), ("x", 4), ddl=ddl), t, "s", 1, partition_by=["kind"])
    assert [(f.name, f.dataType.simpleString()) for f in versions.table_schema(spark, t)] == [("x", "int"), ("kind", "string")]
    assert values(versions.read_as_of(spark, t).select("kind", "x")) == [("007", 1), ("010", 3), ("1", 2), ("x", 4)]


def test_a_first_batch_without_any_partition_value(spark, home):
    t, ddl = f"{home}/t", "x INT, day DATE"
    versions.commit(rows(spark, (None, None), ddl=ddl), t, "s", 0, partition_by=["day"])
    good = rows(spark, (1, "2020-01-01"), ddl="x INT, day STRING").withColumn("day", F.col("day").cast("date"))
    versions.commit(good, t, "s", 1, partition_by=["day"])
    assert sorted(str(r["day"]) for r in versions.read_as_of(spark, t).collect()) == ["2020-01-01", "None"]


def test_sources_are_found_by_folder_names(spark, home):
    t = f"{home}/t"
    for i in range(3):
        versions.commit(rows(spark, (i, "a")), t, "one", i)
    assert versions.last_batch(spark, t, "one") == 2 and versions.last_batch(spark, t, "two") is None


def test_as_of_grows_with_append_commits(spark, home):
    t = f"{home}/t"
    for i in range(12):
        versions.commit(rows(spark, (i, "x"), (i, "y")), t, "s", i)
    counts = [versions.read_as_of(spark, t, v).count() for v in range(12)]
    assert counts == [2 * (v + 1) for v in range(12)]
    history = versions.table_history(spark, t).collect()
    assert [r["version"] for r in history] == list(range(11, -1, -1))
    assert {r["n_rows"] for r in history} == {2}


def test_update_replaces_all_copies_of_a_key_and_later_appends_show(spark, home):
    t = f"{home}/t"
    versions.commit(rows(spark, (1, "a"), (1, "b"), (2, "c"), (None, "n"), (None, "n")), t, "s", 0)
    versions.commit(rows(spark, (1, "A"), (1, "B")), t, "fix", 0, op="update")
    versions.commit(rows(spark, (1, "late"), (3, "d")), t, "s", 1)
    now = versions.read_as_of(spark, t, keys=["k"])
    assert values(now) == sorted(
        [(1, "A"), (1, "B"), (1, "late"), (2, "c"), (3, "d"), (None, "n"), (None, "n")], key=repr
    )
    versions.commit(rows(spark, (1, "Z")), t, "fix", 1, op="update")
    assert values(versions.read_as_of(spark, t, keys=["k"]).where("k = 1")) == [(1, "Z")]
    assert values(versions.read_as_of(spark, t, 0, ["k"]).where("k = 1")) == [(1, "a"), (1, "b")]


def test_enforce_and_evolve(spark, home):
    t = f"{home}/t"
    versions.commit(rows(spark, (1, "a")), t, "s", 0)
    wide = rows(spark, (2, "b", 2.0), ddl="k INT, x STRING, y DOUBLE")
    with pytest.raises(schemas.SchemaMismatch, match="y"):
        versions.commit(wide, t, "s", 1)
    with pytest.raises(schemas.SchemaMismatch, match="k"):
        versions.commit(rows(spark, ("1", "a"), ddl="k STRING, x STRING"), t, "s", 1, evolve=True)
    assert versions.latest_version(spark, t) == 0
    assert versions.commit(wide, t, "s", 1, evolve=True) == 1
    # a narrow batch still fits: what it lacks is NULL
    assert versions.commit(rows(spark, (3,), ddl="k INT"), t, "s", 2) == 2
    assert values(versions.read_as_of(spark, t)) == sorted(
        [(1, "a", None), (2, "b", 2.0), (3, None, None)], key=repr
    )


def test_reading_one_version_prunes_folders(spark, home):
    t = f"{home}/t"
    for i in range(3):
        versions.commit(rows(spark, (i, "x")), t, "s", i)
    df = versions.read_as_of(spark, t, 0)
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(commit_v" in plan
    assert df.count() == 1


def test_schema_assert(spark):
    df = rows(spark, (1, "a"))
    schemas.assert_schema(df, DDL)
    for other in ("x STRING, k INT", "k BIGINT, x STRING", "k INT NOT NULL, x STRING", "k INT"):
        with pytest.raises(schemas.SchemaMismatch):
            schemas.assert_schema(df, other)


def test_commit_of_partitioned_rows(spark, home):
    t = f"{home}/t"
    df = spark.range(1000).select((F.col("id") % 4).cast("int").alias("k"), F.lit("v").alias("x"))
    versions.commit(df, t, "s", 0, partition_by=["k"])
    assert versions.read_as_of(spark, t).columns == ["x", "k"]  # partition columns come last
    assert versions.read_as_of(spark, t).where("k = 2").count() == 250


def scanned_files(df):
    """Files that the scans of an executed DataFrame read."""
    df.collect()
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan)
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numFiles").value()
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def day_table(spark, t, days=6):
    ddl = "k INT, x STRING, day STRING"
    for d in range(days):
        versions.commit(rows(spark, *[(10 * d + i, "old", f"d{d}") for i in range(5)], ddl=ddl), t, "load", d, partition_by=["day"])
    return ddl


def test_a_read_joins_only_the_partitions_an_update_touched(spark, home):
    t = f"{home}/t"
    ddl = day_table(spark, t)
    versions.commit(rows(spark, (20, "new", "d2"), (23, "new", "d2"), ddl=ddl), t, "fix", 0, op="update", partition_by=["day"])
    now = versions.read_as_of(spark, t, keys=["k"], within="day")
    assert values(now) == values(versions.read_as_of(spark, t, keys=["k"]))
    assert versions.changed_partitions(spark, t, "day", op="update") == ["d2"]
    text = now._jdf.queryExecution().toString()
    joined = text[text.index("== Physical Plan"):].split("Initial Plan")[0]
    assert joined.count("FileScan") == 3  # the day's rows, its updates, and all other days
    # five other days once, and the updated day's load and fix, and the fix again for its keys
    assert scanned_files(now) <= 5 + 2 + 2
    assert values(versions.read_as_of(spark, t, 5, ["k"], "day").where("day = 'd2'")) == [(20 + i, "old", "d2") for i in range(5)]


def test_reading_some_partitions_only(spark, home):
    t = f"{home}/t"
    ddl = day_table(spark, t)
    versions.commit(rows(spark, (20, "new", "d2"), (None, "none", None), ddl=ddl), t, "fix", 0, op="update", partition_by=["day"])
    assert versions.changed_partitions(spark, t, "day", after=4) == [None, "d2", "d5"]
    one = versions.read_as_of(spark, t, keys=["k"], within="day", only=["d2", "d3"])
    assert sorted({r["day"] for r in one.collect()}) == ["d2", "d3"] and one.where("x = 'new'").count() == 1
    assert scanned_files(versions.read_as_of(spark, t, keys=["k"], within="day", only=["d3"])) == 1


def test_partition_values_with_signs_are_read_back(spark, home):
    t, ddl = f"{home}/t", "k INT, day STRING"
    odd = ["a/b", "50%", "x=y", "2020-01-01 00:00:00"]
    versions.commit(rows(spark, *enumerate(odd), ddl=ddl), t, "load", 0, partition_by=["day"])
    assert versions.changed_partitions(spark, t, "day") == sorted(odd)


def test_marks_name_the_commits_that_may_hold_a_row(spark, home):
    t = f"{home}/t"
    for batch in range(4):
        versions.commit(rows(spark, (batch, f"x{batch}"), (9, "twice")), t, "s", batch, marks=["x"] if batch != 2 else [])
    asked = lambda *x: versions.holders(spark, t, rows(spark, *[(0, v) for v in x]), ["x"])
    assert asked("x1") == [1, 2] and asked("none", "x0", "x3") == [0, 2, 3] and asked("none") == [2]
    assert asked("twice") == [0, 1, 2, 3]
    assert versions.read_as_of(spark, t).count() == 8  # marks are no data
