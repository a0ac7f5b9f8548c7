"""Table checks: schemas, rows, tolerances, and suites of expectations with points."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Sequence
from contextlib import redirect_stdout
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from siltbed.functions.columns import col, stable_hash
from siltbed.operators.aggregates import table_diff
from siltbed.operators.ordering import row_number_global

TOLERANCE = 0.01


# --- comparisons -----------------------------------------------------------------------------


def same_schema(
    a: StructType | None, b: StructType | None, column_order: bool = True, nullable: bool = False
) -> bool:
    """Equal schemas; column order and nullability count only if asked for."""
    if a is None or b is None:
        return a is b
    plain = lambda s: [f if nullable else StructField(f.name, f.dataType, True) for f in s]
    left, right = plain(a), plain(b)
    if column_order:
        return left == right
    return sorted(left, key=repr) == sorted(right, key=repr)


def same_tables(
    a: DataFrame | None,
    b: DataFrame | None,
    column_order: bool = True,
    nullable: bool = False,
    order_by: Sequence[str] = (),
) -> bool:
    """Equal schema and equal rows, each as often as on the other side.

    With ``order_by`` rows are also compared place by place in that order.
    """
    if a is None or b is None:
        return a is b
    if not same_schema(a.schema, b.schema, column_order, nullable):
        return False
    if order_by:
        a, b = row_number_global(a, order_by, "_place"), row_number_global(b, order_by, "_place")
    return table_diff(a, b).isEmpty()


def same_row(a: Row | None, b: Row | None) -> bool:
    """Equal fields, whatever their order."""
    if a is None or b is None:
        return a is b
    return a.asDict() == b.asDict()


def same_row_columns(a: Sequence[str | Column], b: Sequence[str | Column]) -> Column:
    """``same_row`` for two lists of columns of one row, matched by place: never NULL."""
    if len(a) != len(b):
        return F.lit(False)
    same: Column = F.lit(True)
    for x, y in zip(a, b):
        same = same & col(x).eqNullSafe(col(y))
    return same


def close(a: object, b: object, tolerance: float = TOLERANCE) -> bool:
    """Numbers that differ by at most ``tolerance``; None equals only None, text is never close."""
    if a is None or b is None:
        return a is b
    try:
        return abs(float(a) - float(b)) <= tolerance
    except (TypeError, ValueError):
        return False


def close_columns(a: str | Column, b: str | Column, tolerance: float = TOLERANCE) -> Column:
    """``close`` as a column expression: never NULL, never an error."""
    x, y = col(a).try_cast("double"), col(b).try_cast("double")
    both_null = col(a).isNull() & col(b).isNull()
    return both_null | F.coalesce(F.abs(x - y) <= F.lit(tolerance), F.lit(False))


def contains(values: Iterable[object], value: object) -> bool:
    return value in values


def contains_column(values: Sequence[object], value: str | Column) -> Column:
    """``contains`` as a column expression: NULL is contained only where it is listed."""
    listed = [v for v in values if v is not None]
    found = F.coalesce(col(value).isin(*listed), F.lit(False)) if listed else F.lit(False)
    return found | col(value).isNull() if len(listed) < len(values) else found


def equal_columns(a: str | Column, b: str | Column) -> Column:
    """Whether two columns agree, NULL agreeing with NULL only: never NULL."""
    return col(a).eqNullSafe(col(b))


def column_has_type(df: DataFrame, column: str, type_name: str) -> bool:
    """The column exists and has the given type (``simpleString`` form, e.g. ``bigint``)."""
    return dict(df.dtypes).get(column) == type_name


def answer_hash(spark: SparkSession, answer: object) -> int:
    return spark.range(1).select(stable_hash(F.lit(str(answer)))).first()[0]


def answer_matches(spark: SparkSession, answer: object, expected_hash: int) -> bool:
    return answer_hash(spark, answer) == expected_hash


def answers_match(answer: str | Column, expected_hash: str | Column) -> Column:
    """``answer_matches`` for a column of answers and a column of stored hashes. No answer matches no hash
    but that of a missing answer."""
    return stable_hash(col(answer).cast("string")).eqNullSafe(col(expected_hash))


def assert_equal_text(expected: object, result: object) -> None:
    if str(expected) != str(result):
        raise AssertionError(f"{result} is not the expected {expected}")


def plan_text(df: DataFrame, mode: str = "extended") -> str:
    """Plan text of a query, for asserting what was pushed down."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


# --- expectations over one table, evaluated in one aggregate -------------------------------------


@dataclass(frozen=True)
class Expectation:
    """A named aggregate that must be true, e.g. ``F.count_if(F.col("x") < 0) == 0``."""

    id: str
    holds: Column
    points: int = 1
    depends_on: tuple[str, ...] = ()


def _check_ids(ids: Sequence[str]) -> None:
    seen: set[str] = set()
    for i in ids:
        if not i:
            raise ValueError("every check needs an id")
        if i in seen:
            raise ValueError(f"check id {i} is used twice")
        seen.add(i)


def expectation_report(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """(id, status, points, max_points) per expectation, from one pass over the table.

    A check is skipped if one it depends on, declared before it, did not pass.
    """
    _check_ids([e.id for e in expectations])
    one = df.agg(
        *[F.coalesce(e.holds, F.lit(False)).alias(f"_{i}") for i, e in enumerate(expectations)]
    )
    passed: dict[str, Column] = {}
    rows = []
    for i, e in enumerate(expectations):
        free = F.lit(True)
        for d in e.depends_on:
            free = free & passed.get(d, F.lit(True))
        ok = free & F.col(f"_{i}")
        passed[e.id] = ok
        status = F.when(~free, "skipped").when(ok, "passed").otherwise("failed")
        rows.append(
            F.struct(
                F.lit(e.id).alias("id"),
                status.alias("status"),
                F.when(ok, e.points).otherwise(0).cast("int").alias("points"),
                F.lit(e.points).cast("int").alias("max_points"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def report_score(report: DataFrame) -> DataFrame:
    """Points, reachable points and whole percent; an empty report scores 0 percent."""
    score, top = F.coalesce(F.sum("points"), F.lit(0)), F.coalesce(F.sum("max_points"), F.lit(0))
    return report.agg(
        score.alias("score"),
        top.alias("max_score"),
        F.floor(F.coalesce(F.try_divide(score * 100, top), F.lit(0))).cast("int").alias("percentage"),
    )


# --- suites of arbitrary checks ----------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    id: str
    description: str | None
    run: Callable[[], object]
    points: int = 1
    depends_on: tuple[str, ...] = ()


@dataclass
class CheckSuite:
    """Named checks across several tables; a check fails if it returns False or raises."""

    checks: list[Check] = field(default_factory=list)

    def add(
        self, id: str, description: str | None, run: Callable[[], object],
        points: int = 1, depends_on: Sequence[str] = (),
    ) -> CheckSuite:
        _check_ids([*(c.id for c in self.checks), id])
        self.checks.append(Check(id, description, run, points, tuple(depends_on)))
        return self

    def results(self) -> list[Row]:
        """One Row(id, status, points, max_points, message) per check, in order."""
        failed: set[str] = set()
        out = []
        for c in self.checks:
            status, message = "passed", ""
            if failed.intersection(c.depends_on):
                status = "skipped"
            else:
                try:
                    if c.run() is False:
                        status, message = "failed", "returned False"
                except Exception as exc:
                    status, message = "failed", repr(exc)
            if status != "passed":
                failed.add(c.id)
            got = c.points if status == "passed" else 0
            out.append(Row(id=c.id, status=status, points=got, max_points=c.points, message=message))
        return out

    def report(self, spark: SparkSession) -> DataFrame:
        ddl = "id STRING, status STRING, points INT, max_points INT, message STRING"
        return spark.createDataFrame(self.results(), ddl)


# --- result log ----------------------------------------------------------------------------------

LOG_SCHEMA = "name STRING, value DOUBLE"


def log_result(spark: SparkSession, path: str, name: str, value: float) -> None:
    row = spark.createDataFrame([(name, float(value))], LOG_SCHEMA).coalesce(1)
    row.write.mode("append").csv(path)


def log_results(results: DataFrame, path: str) -> None:
    """Append a whole table of (name, value) to the log in one job."""
    results.select(F.col("name").cast("string"), F.col("value").cast("double")).write.mode("append").csv(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).csv(path)


def results_map(results: DataFrame) -> dict[str, float]:
    """Name to value; a log holds one small row per check. A repeated name keeps its largest."""
    folded = results.groupBy("name").agg(F.max("value").alias("value"))
    return {r["name"]: r["value"] for r in folded.collect()}
