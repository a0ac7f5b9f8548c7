import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltbed.operators import checks

TOWNS = [("Ulm", 126), ("Bonn", 331)]
OTHER_TOWNS = [("Ulm", 126), ("Jena", 331)]
BASE = StructType().add("town", "string").add("people", "double")


# Two numbers are close up to and including the tolerance, None only to None, text never.
@pytest.mark.parametrize(
    "a, b, tolerance, expected",
    [
        (7, 7, 0.01, True),
        (20.25, 20.5, 0.25, True),
        (20.5, 20.25, 0.25, True),
        (20.25, 20.75, 0.25, False),
        (-3, 3, 0.5, False),
        (5e9, 5e9 + 1, 1, True),
        ("oak", 3.5, 0.5, False),
        (3.5, "oak", 0.5, False),
        (0, None, 0.5, False),
        (None, 0, 0.5, False),
        (None, None, 0.5, True),
    ],
)
def test_close_values_and_columns(spark, a, b, tolerance, expected):
    assert checks.close(a, b, tolerance) is expected
    text = [None if v is None else str(v) for v in (a, b)]
    df = spark.createDataFrame([text], "a STRING, b STRING")
    assert df.select(checks.close_columns("a", "b", tolerance)).first()[0] is expected


@pytest.mark.parametrize(
    "other, order, nullable, expected",
    [
        ("town STRING, people DOUBLE", True, True, True),
        ("people DOUBLE, town STRING", False, False, True),
        ("people DOUBLE, town STRING", True, False, False),
        ("town STRING, people BIGINT", False, False, False),
        ("town STRING, people DOUBLE NOT NULL", True, False, True),
        ("town STRING, people DOUBLE NOT NULL", True, True, False),
        ("town STRING", True, False, False),
    ],
)
def test_same_schema(spark, other, order, nullable, expected):
    assert checks.same_schema(BASE, StructType.fromDDL(other), order, nullable) is expected


def test_same_schema_of_none():
    assert checks.same_schema(None, None)
    assert not checks.same_schema(None, BASE) and not checks.same_schema(BASE, None)


def test_same_row():
    a, b = Row(town="Ulm", people=126), Row(town="Bonn", people=331)
    assert checks.same_row(a, a) and checks.same_row(None, None)
    assert checks.same_row(a, Row(people=126, town="Ulm"))
    assert not checks.same_row(a, b) and not checks.same_row(a, None) and not checks.same_row(None, a)
    assert not checks.same_row(a, Row(town="Ulm", people=126, river="Danube"))


def test_column_forms(spark):
    df = spark.createDataFrame([("x", "x", 1), ("x", "y", 2), (None, None, 3), ("x", None, 4)], "a STRING, b STRING, n INT")
    rows = df.orderBy("n").select(
        checks.same_row_columns(["a", F.lit(1)], ["b", F.lit(1)]),
        checks.same_row_columns(["a"], ["b", "n"]),
        checks.contains_column(["y", None], "b"),
        checks.contains_column(["x"], "b"),
        checks.contains_column([], "b"),
        checks.equal_columns("a", "b"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (True, False, False, True, False, True),
        (False, False, True, False, False, False),
        (True, False, True, False, False, True),
        (False, False, True, False, False, False),
    ]


def test_same_tables(spark):
    a, b, c = (spark.createDataFrame(d) for d in (TOWNS, OTHER_TOWNS, TOWNS))
    assert checks.same_tables(a, c) and checks.same_tables(a, c, order_by=["_1"])
    assert not checks.same_tables(a, b) and not checks.same_tables(a, a.unionAll(a.limit(1)))
    assert not checks.same_tables(a, None) and checks.same_tables(None, None)


def halves():
    """Two checks of four hold, a point each."""
    s = checks.CheckSuite()
    for name, holds in (("north", True), ("south", False), ("east", False), ("west", True)):
        s.add(name, f"{name} side", lambda holds=holds: holds)
    return s


def test_suite_scores(spark):
    """Percentages are rounded down, and an empty suite scores 0 of 0."""
    a, b = (spark.createDataFrame(d) for d in (TOWNS, OTHER_TOWNS))
    assert tuple(checks.report_score(halves().report(spark)).first()) == (2, 4, 50)

    s = checks.CheckSuite()
    s.add("towns match themselves", None, lambda: checks.same_tables(a, a), points=6)
    s.add("towns match others", None, lambda: checks.same_tables(a, b), points=7)
    s.add("Ulm is listed", None, lambda: checks.contains(["Ulm", "Bonn"], "Ulm"), points=5)
    s.add("rows agree", None, lambda: checks.same_row(a.first(), b.first()), points=3)
    s.add("close", None, lambda: checks.close(0.5, 0.75, 0.125), points=4)
    report = s.report(spark)
    assert tuple(checks.report_score(report).first()) == (14, 25, 56)
    assert tuple(checks.report_score(report.unionAll(halves().report(spark))).first()) == (16, 29, 55)
    assert tuple(checks.report_score(checks.CheckSuite().report(spark)).first()) == (0, 0, 0)


def test_suite_skips_dependants_and_checks_ids():
    s = checks.CheckSuite()
    s.add("a", "raises", lambda: 1 / 0)
    s.add("b", "needs a", lambda: True, depends_on=["a"])
    s.add("c", "needs b", lambda: True, depends_on=["b"])
    s.add("d", "free", lambda: True)
    assert [r["status"] for r in s.results()] == ["failed", "skipped", "skipped", "passed"]
    with pytest.raises(ValueError):
        s.add("d", "again", lambda: True)
    with pytest.raises(ValueError):
        s.add("", "no id", lambda: True)


def test_expectations_in_one_aggregate(spark):
    df = spark.createDataFrame([(1, 2.0), (2, -1.0)], "k INT, v DOUBLE")
    report = checks.expectation_report(
        df,
        [
            checks.Expectation("rows", F.count("*") == 2, 3),
            checks.Expectation("positive", F.count_if(F.col("v") < 0) == 0, 2, ("rows",)),
            checks.Expectation("after", F.max("k") == 2, 1, ("positive",)),
            checks.Expectation("null", F.sum(F.lit(None).cast("int")) > 0),
        ],
    )
    assert {r["id"]: r["status"] for r in report.collect()} == {
        "rows": "passed", "positive": "failed", "after": "skipped", "null": "failed",
    }
    assert tuple(checks.report_score(report).first()) == (3, 7, 42)
    with pytest.raises(ValueError):
        checks.expectation_report(df, [checks.Expectation("x", F.count("*") > 0)] * 2)


def test_answers_log_types_and_plan(spark, home):
    right = spark.range(1).select(F.abs(F.hash(F.lit("heron")))).first()[0]
    assert checks.answer_hash(spark, "heron") == right
    assert checks.answer_matches(spark, "heron", right) and not checks.answer_matches(spark, "stork", right)
    checks.assert_equal_text("12", 12)
    with pytest.raises(AssertionError):
        checks.assert_equal_text("heron", "stork")
    answers = spark.createDataFrame([("heron",), ("stork",), (None,)], "x STRING")
    assert [r[0] for r in answers.select(checks.answers_match("x", F.lit(right))).collect()] == [True, False, False]

    checks.log_result(spark, f"{home}/log", "speed", 3)
    checks.log_results(spark.createDataFrame([("width", 0.25), ("speed", 2.0)], "name STRING, value DOUBLE"), f"{home}/log")
    assert checks.results_map(checks.read_results(spark, f"{home}/log")) == {"speed": 3.0, "width": 0.25}

    df = spark.range(5).withColumn("x", F.lit("t"))
    assert checks.column_has_type(df, "id", "bigint")
    assert not checks.column_has_type(df, "id", "string") and not checks.column_has_type(df, "nope", "string")
    assert "== Optimized Logical Plan ==" in checks.plan_text(df)
