"""Column rules used across the pipelines. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE_MARKS = "[$,]"  # characters a formatted price carries


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def epoch_to_timestamp(seconds: str | Column) -> Column:
    """Epoch seconds to a timestamp of whole seconds."""
    return F.timestamp_seconds(F.floor(col(seconds)))


def epoch_to_date(seconds: str | Column) -> Column:
    return epoch_to_timestamp(seconds).cast("date")


def price_to_double(text: str | Column) -> Column:
    """``"$1,234.50"`` to 1234.5."""
    return F.regexp_replace(col(text), PRICE_MARKS, "").cast("double")


def price_to_text(number: str | Column) -> Column:
    """1234.5 to ``"$1,234.50"``."""
    return F.concat(F.lit("$"), F.format_number(F.round(col(number), 2), 2))


def binary_flag(name: str | Column, true_value: object = "t") -> Column:
    """1 where the value equals ``true_value``, else 0 (NULL counts as 0)."""
    return F.when(col(name) == F.lit(true_value), 1).otherwise(0)


def ordinal(name: str | Column, ranks: Mapping[str, int]) -> Column:
    """Position of a category; a value outside ``ranks`` becomes NULL."""
    out: Column | None = None
    for level, rank in ranks.items():
        test = col(name) == F.lit(level)
        out = F.when(test, rank) if out is None else out.when(test, rank)
    if out is None:
        raise ValueError("ranks is empty")
    return out.cast("int")


def row_sum(names: Sequence[str]) -> Column:
    """Sum over columns of one row; NULL counts as 0."""
    total: Column = F.lit(0.0)
    for name in names:
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return total


def threshold_label(
    name: str | Column, limit: float, above: str, below: str
) -> Column:
    return F.when(col(name) > F.lit(limit), above).otherwise(below)


def name_sanitize(name: str | Column) -> Column:
    """Lower case; each run of other characters becomes one underscore."""
    return F.regexp_replace(F.lower(col(name)), "[^a-z0-9]+", "_")


def stable_hash(name: str | Column) -> Column:
    """Non-negative integer hash of a value's text form."""
    # Widened first: the absolute value of the smallest INT does not fit an INT.
    return F.abs(F.hash(col(name).cast("string")).cast("bigint"))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that gives NULL, not an error, on a zero denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def midpoint(a: str | Column, b: str | Column) -> Column:
    return (col(a) + col(b)) / F.lit(2)


def add_to_all(df: DataFrame, n: float) -> DataFrame:
    """Every column plus a constant."""
    return df.select([(F.col(c) + F.lit(n)).alias(c) for c in df.columns])


def null_share(name: str, proportion: float, seed: int) -> Column:
    """The column with about ``proportion`` of its values set to NULL."""
    return F.when(F.rand(seed) < F.lit(proportion), None).otherwise(F.col(name))
