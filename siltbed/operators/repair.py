"""Repair of bad readings and the report of missing ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType

from siltbed.functions.columns import midpoint
from siltbed.operators.ordering import neighbours


def interpolate_neighbors(
    readings: DataFrame,
    key: str = "device_id",
    time: str = "eventtime",
    value: str = "heartrate",
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Broken (negative) readings with the mean of the readings before and after them.

    A reading at the end of its key's series has one neighbour only and becomes NULL; a
    neighbour that is itself broken is used as it is.
    """
    sided = neighbours(readings, key, time, value, tie).where(F.col(value) < 0)
    return sided.select(
        *[
            midpoint("prev_amt", "next_amt").alias(c) if c == value else F.col(c)
            for c in readings.columns
        ]
    )


def repaired(
    readings: DataFrame,
    key: str = "device_id",
    time: str = "eventtime",
    value: str = "heartrate",
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """All readings, broken ones replaced: the repair of a table that is not stored yet.

    Same result as merging ``interpolate_neighbors`` back, without the join.
    """
    sided = neighbours(readings, key, time, value, tie)
    fixed = F.when(F.col(value) < 0, midpoint("prev_amt", "next_amt")).otherwise(F.col(value))
    placed = sided.select(*[fixed.alias(c) if c == value else F.col(c) for c in readings.columns])
    unplaced = readings.where(F.col(key).isNull() | F.col(time).isNull())
    return placed.unionAll(unplaced)


#: Slots that one row makes at most, when a gap is filled.
RUN = 4096


def missing_slots(
    df: DataFrame, key: str, slot: Column, start: Column, end: Column, step: str = "1 hour", expected: DataFrame | None = None
) -> DataFrame:
    """(key, slot) pairs between start and end, both included, that have no row.

    ``expected`` lists keys (first column) that are reported even without any row. Each distinct slot looks
    to the next one of its key; a hole between them becomes its slots, a run of at most ``RUN`` at a time, so
    neither a busy key nor a long hole is one array or one task. Steps of months or years, of which a span
    holds few, are counted out; all others are of fixed length.
    """
    slots = _slots(df, key, slot, start, end)
    kind = slots.schema["slot"].dataType
    n, at, place = _grid(df, kind, start, end, step)
    keys = _keys(slots, key, expected)
    boxed = slots.where("slot is not null").select(F.struct(F.col(key)).alias("_key"), at(F.col("slot")).alias("_at")).where("_at is not null")
    sided = neighbours(boxed, "_key", "_at", "_at", prev_name="_p", next_name="_n")
    gap = lambda first, last: F.struct(first.cast("bigint").alias("first"), last.cast("bigint").alias("last"))
    after = gap(F.col("_at") + 1, F.coalesce(F.col("_n"), n) - 1)
    before = F.when(F.col("_p").isNull(), gap(F.lit(0), F.col("_at") - 1))
    gaps = sided.select(F.col(f"_key.{key}").alias(key), F.explode(F.array(before, after)).alias("_gap"))
    present = boxed.select(F.col(f"_key.{key}").alias("_own")).distinct()
    silent = keys.join(present, F.col(key).eqNullSafe(F.col("_own")), "left_anti").select(key, gap(F.lit(0), n - 1).alias("_gap"))
    holes = gaps.unionByName(silent).where("_gap.first <= _gap.last")
    runs = holes.select(key, F.col("_gap.last").alias("_last"), F.explode(F.sequence(F.col("_gap.first"), F.col("_gap.last"), F.lit(RUN).cast("bigint"))).alias("_first"))
    each = runs.select(key, F.explode(F.sequence("_first", F.least(F.col("_last"), F.col("_first") + (RUN - 1)))).alias("_i"))
    return each.select(key, place(F.col("_i")).cast(kind).alias("slot"))


def missing_report(
    df: DataFrame, key: str, slot: Column, start: Column, end: Column, step: str = "1 hour", expected: DataFrame | None = None
) -> DataFrame:
    """Expected, present and missing slots per key; ``expected`` names keys that may have no row at all."""
    slots = _slots(df, key, slot, start, end)
    n, _, _ = _grid(df, slots.schema["slot"].dataType, start, end, step)
    if expected is not None:
        listed = _keys(slots, key, expected).withColumn("slot", F.lit(None).cast(slots.schema["slot"].dataType))
        slots = slots.unionByName(listed)
    actual = slots.groupBy(key).agg(F.count("slot").alias("actual"))
    return actual.select(key, n.alias("expected"), "actual", (n - F.col("actual")).alias("missing"))


def _slots(df: DataFrame, key: str, slot: Column, start: Column, end: Column) -> DataFrame:
    """Distinct (key, slot); a slot outside the span is NULL, so its key is still reported."""
    return df.select(F.col(key), F.when(slot.between(start, end), slot).alias("slot")).distinct()


def _keys(slots: DataFrame, key: str, expected: DataFrame | None) -> DataFrame:
    keys = slots.select(key)
    if expected is not None:
        keys = keys.unionAll(expected.select(F.col(expected.columns[0]).cast(slots.schema[key].dataType).alias(key)))
    return keys.distinct()


def _grid(df: DataFrame, kind: DataType, start: Column, end: Column, step: str) -> tuple[Column, Callable, Callable]:
    """The number of slots, the number of a slot (NULL off the grid), and the slot of a number."""
    spark = df.sparkSession
    if "month" in step or "year" in step:
        every = [r[0] for r in spark.range(1).select(F.explode(F.sequence(start, end, F.expr(f"interval {step}")))).collect()]
        table = F.array(*(F.lit(x) for x in every))
        position = lambda s: F.nullif(F.array_position(table, s.cast(kind)), F.lit(0)) - 1
        return F.lit(len(every)).cast("bigint"), position, lambda i: F.get(table, i.cast("int"))
    one = spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {step}"))).first()[0]
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    zero = micros(start)
    if isinstance(kind, DateType):
        if one % 86_400_000_000:
            raise ValueError("dates need steps of whole days")
        days, ahead = one // 86_400_000_000, lambda c: F.datediff(c, start).cast("bigint")
        count = F.floor(ahead(end) / F.lit(days)).cast("bigint") + 1
        return count, lambda s: F.when(ahead(s) % days == 0, F.floor(ahead(s) / F.lit(days)).cast("bigint")), lambda i: F.date_add(start, (i * days).cast("int"))
    apart = lambda c: micros(c) - zero
    whole = lambda c: ((c - F.pmod(c, F.lit(one).cast("bigint"))) / F.lit(one)).cast("bigint")
    return whole(apart(end)) + 1, lambda s: F.when(apart(s) % one == 0, whole(apart(s))), lambda i: F.timestamp_micros(zero + i * one)
